"""Ranked lexical search with pair-bound MaxScore over a distributed index (operator 12).

**Index.** One pass cuts whole texts into terms and stores, for each document, its length and its
occurrences of the items' terms (no other term can add to a score). A second sums document
frequencies. A third turns runs of documents into blocks of about ``BLOCK_POSTINGS`` postings, each
one row of a written table: posting lists by term (documents ascending, with their impacts), and for
each chosen pair of terms the **list of documents that hold both**, the **largest joint impact**
among them and the ``DEPTH``-th largest. An item's terms are paired in order of weight: rare terms
seldom meet, so a pair is often bounded by its larger half instead of by the sum.

**Search.** Each task goes through its blocks with the ten best of each item so far. A pair adds at
most max(joint maximum, either maximum); units (pairs, a last single term) are ordered by this
bound, and those whose bounds sum to less than the tenth best score are not essential: a document
that they alone hold cannot enter. A unit is asked only for the lists that could lift a document
over the threshold, which for a pair may be the intersection alone. Candidates then meet the other
units from the largest bound down and leave when what they have and what is left stays below the
threshold. A threshold starts from the ``DEPTH``-th largest joint impact, which so many documents
reach. Documents at the threshold itself stay, since a smaller doc_id wins ties. What is left has its
exact score.

Blocks never meet; a task hands on at most ten rows an item, which are merged in two steps. Items are
taken in groups of about ``MOST_TERMS`` (item, term) rows, counted first; only one group's terms are
sent to the tasks at a time.

Terms are compared by 64-bit hashes (two different terms share one with a chance of 2^-64).

Cases: missing and empty texts, and those without a term, are not documents of the ranking and count
in no statistic; an item without terms has no rows; rows of one item_id are one item with the terms
of all; repeated documents are ranked each for itself (equal ones share their score; ranks stay
unique); a missing doc_id comes before all others, a missing item_id is an item; no documents or no
items give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.llm.common import (
    Sums, cut_slices, dropped, for_workers, lowered, numbers, stored, summed, table, whole_texts,
)

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (item, term) rows sent to tasks at a time.
MOST_TERMS = 200_000
#: A block closes at so many postings or documents.
BLOCK_POSTINGS, BLOCK_DOCS = 1 << 20, 1 << 16
#: The joint impact of this rank is stored for each pair; it bounds searches for up to so many.
DEPTH = 10
#: Partial rankings of an item that one merging task takes from one of so many shares.
SHARES = 64

_IN_TERM = np.zeros(256, bool)
_IN_TERM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_NULL = -(1 << 63)

_FORWARD = "doc_id long, n long, terms binary, counts binary"
_BLOCK = (
    "doc_ids binary, starts binary, docs binary, impacts binary, most binary, "
    "pair_starts binary, pair_docs binary, joint binary, deep binary"
)


def term_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document number of every term of consecutive texts."""
    data, n = lowered(data), len(data)
    inside = _IN_TERM[data]
    begins, ends = inside.copy(), inside.copy()
    if n:
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        cut = offsets[:-1][offsets[:-1] < n]
        begins[cut] = inside[cut]
        cut = offsets[1:][offsets[1:] > 0] - 1
        ends[cut] = inside[cut]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    hashes = Sums(data.astype(np.uint64) + np.uint64(1)).span(start, end)
    return hashes, np.searchsorted(offsets, start, "right") - 1


def _hash_of(terms: list[str]) -> np.ndarray:
    raw = [t.encode() for t in terms]
    offsets = np.cumsum([0, *map(len, raw)])
    return term_hashes(np.frombuffer(b"".join(raw), np.uint8), offsets)[0]


@dataclass
class Items:
    """Items as arrays of term numbers; terms are numbered by their hash."""

    ids: list
    terms: list[np.ndarray]
    hashes: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple]) -> Items:
        """From (item, list of different terms)."""
        vocabulary = sorted({t for _, terms in rows for t in terms})
        hashes = _hash_of(vocabulary)
        order = np.argsort(hashes)
        number = dict(zip((vocabulary[k] for k in order), range(len(order))))
        terms = [np.array([number[t] for t in some], np.int64) for _, some in rows]
        return cls([i for i, _ in rows], terms, hashes[order])


@dataclass
class Ranking:
    """Weights of the terms, the corpus's size, and the pairs that an index stores."""

    documents: int
    length: int
    weights: np.ndarray
    #: Pairs of term numbers, and for each item its units: a pair's number or -1 with one term.
    pairs: np.ndarray = field(default_factory=lambda: np.zeros((0, 2), np.int64))
    units: list[list[tuple[int, int]]] = field(default_factory=list)

    @classmethod
    def of(cls, documents: int, length: int, found: np.ndarray, items: Items) -> Ranking:
        weights = [
            math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for n in found.tolist()
        ]
        ranking = cls(documents, length, np.array(weights, np.int64))
        number: dict[tuple[int, int], int] = {}
        for terms in items.terms:
            order = terms[np.lexsort((terms, -ranking.weights[terms]))].tolist()
            pairs = [tuple(sorted(p)) for p in zip(order[::2], order[1::2])]
            units = [(number.setdefault(p, len(number)), -1) for p in pairs]
            ranking.units.append(units + [(-1, t) for t in order[len(pairs) * 2 :]])
        ranking.pairs = np.array(list(number), np.int64).reshape(-1, 2)
        return ranking

    def impacts(self, terms: np.ndarray, counts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """What a term that occurs ``counts`` times adds to a document of this length."""
        if len(lengths) and 90 * int(lengths.max()) * self.documents >= 1 << 63:
            m = np.array([10 + 90 * n * self.documents // self.length for n in lengths.tolist()])
        else:
            m = 10 + 90 * lengths * self.documents // max(self.length, 1)
        return self.weights[terms] * (1_000_000_000 * counts // (1000 * counts + 8 * m))


@dataclass
class Block:
    """Posting lists of a run of documents."""

    doc_ids: np.ndarray
    starts: np.ndarray
    docs: np.ndarray
    impacts: np.ndarray
    most: np.ndarray
    pair_starts: np.ndarray
    pair_docs: np.ndarray
    joint: np.ndarray
    deep: np.ndarray

    _KINDS = ("<i8", "<i8", "<i4", "<i8", "<i8", "<i8", "<i4", "<i8", "<i8")

    @classmethod
    def build(
        cls, ranking: Ranking, doc_ids: np.ndarray, lengths: np.ndarray, docs: np.ndarray,
        terms: np.ndarray, counts: np.ndarray,
    ) -> Block:
        """From postings ordered by document."""
        size = len(ranking.weights)
        order = np.argsort(terms, kind="stable")
        terms, docs, counts = terms[order], docs[order], counts[order]
        impacts = ranking.impacts(terms, counts, lengths[docs])
        starts = np.searchsorted(terms, np.arange(size + 1))
        most = np.zeros(size, np.int64)
        held = starts[1:] > starts[:-1]
        if len(docs):
            most[held] = np.maximum.reduceat(impacts, starts[:-1][held])
        both, joint, deep = [], [], []
        for a, b in ranking.pairs.tolist():
            one, two = slice(starts[a], starts[a + 1]), slice(starts[b], starts[b + 1])
            common, at, other = np.intersect1d(docs[one], docs[two], True, return_indices=True)
            together = impacts[one][at] + impacts[two][other]
            both.append(common)
            joint.append(together.max(initial=0))
            enough = len(together) >= DEPTH
            deep.append(np.partition(together, -DEPTH)[-DEPTH] if enough else 0)
        return cls(
            doc_ids, starts, docs, impacts, most,
            np.cumsum([0, *map(len, both)]),
            np.concatenate(both) if both else np.zeros(0, np.int32),
            np.array(joint, np.int64), np.array(deep, np.int64),
        )

    def row(self) -> list[bytes]:
        return [
            np.asarray(getattr(self, name)).astype(kind).tobytes()
            for name, kind in zip(_NAMES, self._KINDS)
        ]

    @classmethod
    def read(cls, row: list[pa.Scalar]) -> Block:
        return cls(*(np.frombuffer(v.as_buffer(), k) for v, k in zip(row, cls._KINDS)))

    def _list(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        some = slice(self.starts[term], self.starts[term + 1])
        return self.docs[some], self.impacts[some]

    def top(
        self, ranking: Ranking, units: list[tuple[int, int]], k: int, least: int
    ) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents (numbers in the block) that may be among the k best with at least ``least``, their
        scores, and how many were looked at."""
        nothing = np.zeros(0, np.int64)
        bounded, least = [], max(least, 1)
        for pair, term in units:
            if pair < 0:
                bounded.append((int(self.most[term]), pair, (term,)))
                continue
            a, b = ranking.pairs[pair].tolist()
            bound = max(int(self.most[a]), int(self.most[b]), int(self.joint[pair]))
            bounded.append((bound, pair, (a, b)))
            if k <= DEPTH:
                least = max(least, int(self.deep[pair]))
        bounded.sort()
        below = [0]
        for bound, _, _ in bounded:
            below.append(below[-1] + bound)
        if below[-1] < least:
            return nothing, nothing, 0

        # Documents that only units before the first essential one hold stay below ``least``.
        wanted = np.zeros(len(self.doc_ids), bool)
        essential = next(j for j in range(len(bounded)) if below[j + 1] >= least)
        for j in range(essential, len(bounded)):
            _, pair, terms = bounded[j]
            missing = least - below[j]
            alone = [t for t in terms if self.most[t] >= missing]
            for t in alone:
                wanted[self._list(t)[0]] = True
            if pair >= 0 and len(alone) < 2 and self.joint[pair] >= missing:
                wanted[self.pair_docs[self.pair_starts[pair] : self.pair_starts[pair + 1]]] = True
        docs = np.flatnonzero(wanted)
        looked, scores = len(docs), np.zeros(len(docs), np.int64)
        place = np.empty(len(self.doc_ids), np.int64)
        for j in reversed(range(len(bounded))):
            if not len(docs):
                break
            place.fill(-1)
            place[docs] = np.arange(len(docs))
            for t in bounded[j][2]:
                found, impacts = self._list(t)
                if 16 * len(docs) < len(found):
                    at = np.minimum(np.searchsorted(found, docs), len(found) - 1)
                    hit = found[at] == docs
                    scores[hit] += impacts[at[hit]]
                else:
                    at = place[found]
                    scores[at[at >= 0]] += impacts[at >= 0]
            if len(docs) >= k:
                least = max(least, int(np.partition(scores, -k)[-k]))
            stay = scores + below[j] >= least
            docs, scores = docs[stay], scores[stay]
        return docs, scores, looked


_NAMES = [f.split()[0] for f in _BLOCK.split(", ")]


def _forward(docs: DataFrame, hashes: np.ndarray) -> DataFrame:
    """Documents with a term: length, numbers of the items' terms they hold, occurrences."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(hashes)
        for batch in batches:
            rows = len(batch)
            lengths = np.zeros(rows, np.int64)
            keys, counts = [], []
            for low, data, offsets in cut_slices(batch.column("text"), ~_IN_TERM):
                found, doc = term_hashes(data, offsets)
                lengths[low : low + len(offsets) - 1] += np.bincount(doc, minlength=len(offsets) - 1)
                at = np.minimum(np.searchsorted(hashes, found), size - 1)
                hit = hashes[at] == found
                key, count = np.unique((low + doc[hit]) * size + at[hit], return_counts=True)
                keys.append(key)
                counts.append(count)
            # The parts of a long text meet here.
            key, back = np.unique(np.concatenate([*keys, np.zeros(0, np.int64)]), return_inverse=True)
            count = np.zeros(len(key), np.int64)
            np.add.at(count, back, np.concatenate([*counts, np.zeros(0, np.int64)]).astype(np.int64))
            cuts = np.searchsorted(key, np.arange(rows + 1) * size).tolist()
            terms, count = (key % size).astype("<i4"), count.astype("<i8")
            out = pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(lengths),
                    pa.array([terms[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
                    pa.array([count[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
                ],
                ["doc_id", "n", "terms", "counts"],
            )
            yield out.filter(pa.array(lengths > 0))

    return whole_texts(docs).mapInArrow(work, _FORWARD)


def _flat(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Values of all rows of a binary column, and how many each row has."""
    cells = [np.frombuffer(cell.as_buffer(), kind) for cell in column]
    lengths = np.array([len(c) for c in cells], np.int64)
    return (np.concatenate(cells) if cells else np.zeros(0, kind)), lengths


def _frequencies(forward: DataFrame, size: int) -> np.ndarray:
    """Documents of each term, then the number of documents and the terms of all."""

    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        found = np.zeros(-(-(size + 2) // 16) * 16, np.int64)
        for batch in batches:
            terms, _ = _flat(batch.column("terms"), "<i4")
            found[:size] += np.bincount(terms, minlength=size)
            found[size] += len(batch)
            found[size + 1] += int(batch.column("n").to_numpy().sum())
        return found

    padded = -(-(size + 2) // 16) * 16
    return summed(forward.select("n", "terms"), count, padded, np.int64, "sum")


def build_blocks(forward: DataFrame, ranking: Ranking) -> DataFrame:
    """A row for each block of documents; see ``Block``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        docs = postings = 0

        def block() -> pa.RecordBatch:
            ids, lengths, sizes, terms, counts = map(np.concatenate, zip(*held))
            numbered = np.repeat(np.arange(len(ids), dtype=np.int32), sizes)
            row = Block.build(ranking, ids, lengths, numbered, terms, counts).row()
            return pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in row], _NAMES)

        for batch in batches:
            for low in range(0, len(batch), 1024):
                some = batch.slice(low, 1024)
                terms, sizes = _flat(some.column("terms"), "<i4")
                counts, _ = _flat(some.column("counts"), "<i8")
                lengths = some.column("n").to_numpy()
                held.append((numbers(some.column("doc_id")), lengths, sizes, terms, counts))
                docs, postings = docs + len(some), postings + len(terms)
                if docs >= BLOCK_DOCS or postings >= BLOCK_POSTINGS:
                    yield block()
                    held.clear()
                    docs = postings = 0
        if held:
            yield block()

    for_workers(forward.sparkSession)
    return forward.mapInArrow(work, _BLOCK)


def search_blocks(blocks: DataFrame, items: Items, ranking: Ranking, k: int) -> DataFrame:
    """item (number), doc_id, score, share: the k best of each item in each task's blocks."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in items.ids]
        for batch in batches:
            for r in range(len(batch)):
                block = Block.read([batch.column(c)[r] for c in range(len(_NAMES))])
                for i, units in enumerate(ranking.units):
                    scores, ids = best[i]
                    least = int(scores[-1]) if len(scores) >= k else 1
                    docs, found, _ = block.top(ranking, units, k, least)
                    if len(docs):
                        scores = np.concatenate([scores, found])
                        ids = np.concatenate([ids, block.doc_ids[docs]])
                        order = np.lexsort((ids, -scores))[:k]
                        best[i] = scores[order], ids[order]
        sizes = [len(s) for s, _ in best]
        share = TaskContext.get().partitionId() % SHARES
        ids = np.concatenate([np.zeros(0, np.int64), *(i for _, i in best)])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(len(best), dtype=np.int32), sizes)),
                pa.array(ids, mask=ids == _NULL),
                pa.array(np.concatenate([np.zeros(0, np.int64), *(s for s, _ in best)])),
                pa.array(np.full(sum(sizes), share, np.int32)),
            ],
            ["item", "doc_id", "score", "share"],
        )

    for_workers(blocks.sparkSession)
    return blocks.mapInArrow(work, "item int, doc_id long, score long, share int")


def item_terms(items: DataFrame) -> DataFrame:
    """item_id and each different term of its texts."""
    text = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), UPPER, LOWER)
    terms = F.array_distinct(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)))
    return items.select("item_id", F.explode(terms).alias("term")).distinct()


def _best(found: DataFrame, k: int, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(documents: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each item."""
    spark = documents.sparkSession
    for_workers(spark)
    terms = item_terms(items)
    groups = max(1, -(-terms.count() // MOST_TERMS))
    kind = terms.schema["item_id"].dataType.simpleString()
    result = None
    for group in range(groups):
        some = terms.where(F.pmod(F.xxhash64("item_id"), F.lit(groups)) == group)
        # About MOST_TERMS rows, by the count above.
        rows = some.groupBy("item_id").agg(F.collect_list("term").alias("terms")).collect()
        if not rows:
            continue
        chosen = Items.of([(r["item_id"], r["terms"]) for r in rows])
        forward = stored(_forward(documents, chosen.hashes), "terms")
        size = len(chosen.hashes)
        counts = _frequencies(forward, size)
        ranking = Ranking.of(int(counts[size]), int(counts[size + 1]), counts[:size], chosen)
        blocks = stored(build_blocks(forward, ranking), "lexical-index")
        dropped(forward)
        parts = stored(search_blocks(blocks, chosen, ranking, k), "found")
        dropped(blocks)
        best = _best(_best(parts, k, "item", "share").drop("rank"), k, "item")
        names = spark.createDataFrame(list(enumerate(chosen.ids)), f"item int, item_id {kind}")
        found = best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        result = found if result is None else result.unionByName(found)
    if result is None:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return result


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for each benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = rf"""
with docs as (
    select row_number() over () as row, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}') as terms
    from documents
),
sized as (select row, doc_id, len(terms)::bigint as n, terms from docs where len(terms) > 0),
corpus as (select count(*)::bigint as docs, sum(n)::bigint as total from sized),
wanted as (
    select distinct item_id, term from (
        select item_id, unnest(
            regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}')
        ) as term
        from benchmark
    )
),
postings as (
    select row, doc_id, n, term, count(*)::bigint as tf
    from (select row, doc_id, n, unnest(terms) as term from sized)
    where term in (select term from wanted)
    group by all
),
weights as (
    select term, floor(1000 * ln((2 * any_value(docs) + 2)::double / (2 * count(*) + 1)))::bigint as w
    from postings, corpus group by term
),
impacts as (
    select row, doc_id, term,
           w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total))) as impact
    from postings join weights using (term), corpus
),
scores as (
    select item_id, row, doc_id, sum(impact)::bigint as score
    from wanted join impacts using (term) group by all
),
ranked as (
    select item_id, doc_id, score, row_number() over (
        partition by item_id order by score desc, doc_id nulls first) as rank
    from scores where score > 0
)
select item_id, rank::int as rank, doc_id, score from ranked where rank <= 10
"""
