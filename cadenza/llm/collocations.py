"""Phrase collocation mining: phrases counted in HAT-tries, scored and ranked by joins (operator 11).

**Counting.** A task keeps its phrases in a HAT-trie: a shallow trie whose levels are language, first
word, second word ... and whose leaves are hash containers. A container covers a range of ids of one
level (hybrid, as long as it is small) and holds keys ordered by the hash of the phrase, with counts;
new keys wait in a buffer and are merged in when they are many. A container of more than ``BURST``
keys bursts: its range is cut at the median id, or, if it covers one id, it becomes an inner node with
a container of the next level. When a task holds more than ``MOST_KEYS`` keys, its largest subtrees
are spilled whole, as sorted runs cut by prefix partition (a hash of language and first two words).
Spark shuffles the runs by prefix partition, and each partition's runs are merged by themselves.

**Levels.** First single words, then pairs of frequent words, then phrases of three and four words
all of whose pairs are frequent: a phrase cannot be more frequent than its parts, and no part rarer
than the least count is ever needed. The tasks know frequent words and pairs by a bit array, sized by
their number up to ``MOST_BITS``; beyond that it lets more phrases through, never fewer.

**Scoring.** Cuts join the frequency of their two parts, sub-phrases take the largest count of the
longer candidates over them, all in Spark and in decimals. Words are ids (64-bit hashes; two different
words share one with a chance of 2^-64) until the phrases that can be in the result, ties included,
are known; one more pass over the texts spells those.

Cases: missing and empty texts have no words; a missing language is ``und``, together with documents
that say so; repeated rows count again; equal score and count are ordered by phrase; an empty table,
or one without a frequent phrase, gives no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.llm.common import (
    Sums, cut_slices, dropped, for_workers, lowered, mix, stored, summed, table,
)

#: A container bursts above so many keys; a task spills above so many.
BURST, MOST_KEYS = 1 << 16, 1 << 20
#: Prefix partitions: at least so many, and one for so many words of the corpus.
LEAST_PARTS, PART_WORDS = 1 << 10, 1 << 22
#: Bits for each frequent phrase in a filter, and of all at least and at most.
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 1 << 20, 1 << 29
#: Shares of a language that are ranked by themselves first.
SHARES = 64
SLICE = 2 << 20

_BREAK, _BLANK = np.zeros(256, bool), np.zeros(256, bool)
_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
_BLANK[list(b" \t")] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)

_RUNS = "part long, n int, words binary, counts binary"
_PHRASES = "lang long, words array<long>, f long"


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Words of consecutive lower-cased texts: start, end, hash (never 0), text number, and a number
    that grows with every piece."""
    stops = _BREAK[data]
    inside, n = ~(stops | _BLANK[data]), len(data)
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
    doc = np.searchsorted(offsets, start, "right") - 1
    return start, end, np.maximum(hashes, np.uint64(1)), doc, np.cumsum(stops)[start] + doc


def chain(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of all but its last word."""
    return mix(before * _STEP + word)


def key_hash(keys: np.ndarray) -> np.ndarray:
    """Hash of each key: language, words, zeros."""
    found = keys[:, 0]
    for level in range(1, keys.shape[1]):
        word = keys[:, level]
        found = np.where(word > 0, chain(found, word), found)
    return found


def _summed_keys(
    hashes: np.ndarray, keys: np.ndarray, counts: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each key once, ordered by hash."""
    order = np.argsort(hashes, kind="stable")
    hashes = hashes[order]
    first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(hashes) else order
    sums = np.add.reduceat(counts[order], first) if len(first) else counts
    return hashes[first], keys[order[first]], sums


class Container:
    """Keys that share the ids of all levels above and lie in a range of ids of this level."""

    def __init__(self, level: int, width: int):
        self.level = level
        self.hashes = np.zeros(0, np.uint64)
        self.keys = np.zeros((0, width), np.uint64)
        self.counts = np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, hashes: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((hashes, keys, counts))
        self.size += len(hashes)
        if self.size > 2 * len(self.hashes) + 4096:
            self.settle()

    def settle(self) -> None:
        if self.waiting:
            parts = zip((self.hashes, self.keys, self.counts), *self.waiting)
            self.hashes, self.keys, self.counts = _summed_keys(*map(np.concatenate, parts))
            self.waiting = []
            self.size = len(self.hashes)

    def all(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        self.settle()
        return self.hashes, self.keys, self.counts

    def burst(self) -> Node | None:
        """An inner node in place of a container that is too large, or None."""
        self.settle()
        if self.size <= BURST or self.level >= self.keys.shape[1]:
            return None
        ids = np.sort(self.keys[:, self.level])
        middle = ids[len(ids) // 2]
        width = self.keys.shape[1]
        if ids[0] == ids[-1]:
            # Other ids of the range, should they come, keep containers of their own.
            node = Node(self.level, [np.uint64(0), middle, middle + np.uint64(1)])
            one = Node(self.level, [np.uint64(0)], one=True)
            one.children = [Container(self.level + 1, width)]
            node.children = [Container(self.level, width), one, Container(self.level, width)]
        else:
            if middle == ids[0]:
                middle = ids[np.searchsorted(ids, middle, "right")]
            node = Node(self.level, [np.uint64(0), middle])
            node.children = [Container(self.level, width) for _ in "12"]
        node.add(self.hashes, self.keys, self.counts)
        return node


class Node:
    """Children by range of ids of one level; ``one`` child if all keys have the same id there."""

    def __init__(self, level: int, lows: list[np.uint64], one: bool = False):
        self.level, self.lows, self.one = level, np.array(lows, np.uint64), one
        self.children: list[Node | Container] = []

    @property
    def size(self) -> int:
        return sum(c.size for c in self.children)

    def add(self, hashes: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> None:
        child = np.searchsorted(self.lows, keys[:, self.level], "right") - 1
        if self.one:
            child[:] = 0
        order = np.argsort(child, kind="stable")
        cuts = np.searchsorted(child[order], np.arange(len(self.children) + 1))
        for k, low, high in zip(range(len(self.children)), cuts, cuts[1:]):
            if low < high:
                some = order[low:high]
                below = self.children[k]
                below.add(hashes[some], keys[some], counts[some])
                if isinstance(below, Container) and below.size > BURST:
                    self.children[k] = below.burst() or below
        self._lift()

    def _lift(self) -> None:
        """Children that split this level's range again become children of this node."""
        def splits(child: Node | Container) -> bool:
            return isinstance(child, Node) and child.level == self.level and not child.one

        if self.one or not any(map(splits, self.children)):
            return
        lows, children = [], []
        for low, child in zip(self.lows, self.children):
            if splits(child):
                lows += [max(low, child.lows[0]), *child.lows[1:]]
                children += child.children
            else:
                lows.append(low)
                children.append(child)
        self.lows, self.children = np.array(lows, np.uint64), children

    def all(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return tuple(map(np.concatenate, zip(*(c.all() for c in self.children))))


class Trie:
    """Counts of phrases; ``add`` returns subtrees that no longer fit, as (keys, counts)."""

    def __init__(self, width: int):
        self.width = width
        self.root = Node(0, [np.uint64(0)])
        self.root.children = [Container(0, width)]

    def add(self, keys: np.ndarray, counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        self.root.add(*_summed_keys(key_hash(keys), keys, counts))
        if self.root.size > MOST_KEYS:
            yield from self.spill(MOST_KEYS // 2)

    def spill(self, left: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Whole subtrees, largest first, until at most ``left`` keys stay."""
        size = self.root.size
        for k in sorted(range(len(self.root.children)), key=lambda k: -self.root.children[k].size):
            if size <= left:
                return
            size -= self.root.children[k].size
            _, keys, counts = self.root.children[k].all()
            self.root.children[k] = Container(0, self.width)
            if len(keys):
                yield keys, counts


def prefix_part(keys: np.ndarray, parts: int) -> np.ndarray:
    """Prefix partition: by language and the first two words."""
    return (key_hash(keys[:, :3]) >> np.uint64(1)).astype(np.int64) % parts


def _run(keys: np.ndarray, counts: np.ndarray, parts: int) -> pa.RecordBatch:
    """A subtree as a sorted run, a row for each prefix partition."""
    part = prefix_part(keys, parts)
    order = np.lexsort((*keys.T[::-1], part))
    part, keys, counts = part[order], keys[order], counts[order]
    first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
    ends = np.append(first[1:], len(part))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(part[first]),
            pa.array((ends - first).astype(np.int32)),
            pa.array([keys[a:b].tobytes() for a, b in zip(first, ends)], pa.binary()),
            pa.array([counts[a:b].tobytes() for a, b in zip(first, ends)], pa.binary()),
        ],
        ["part", "n", "words", "counts"],
    )


class Bits:
    """A set of hashes: members are always found, others seldom."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.mask = bits, np.uint64(8 * len(bits) - 1)

    @staticmethod
    def places(hashes: np.ndarray, mask: np.uint64) -> tuple[np.ndarray, np.ndarray]:
        return hashes & mask, (hashes >> np.uint64(32)) & mask

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for place in self.places(hashes, self.mask):
            found &= (self.bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1) > 0
        return found

    @classmethod
    def of(cls, phrases: DataFrame, words_only: bool = False) -> Bits:
        """Of the phrases' hashes, or of single ids (``words_only``; column ``id``)."""
        wanted = BITS_EACH * phrases.count()
        size = min(max(LEAST_BITS, 1 << (wanted - 1).bit_length() if wanted else 0), MOST_BITS)
        mask = np.uint64(size - 1)

        def mark(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            bits = np.zeros(size // 8, np.uint8)
            for batch in batches:
                if words_only:
                    hashes = batch.column("id").to_numpy().astype(np.uint64)
                else:
                    lists = batch.column("words")
                    lengths = np.diff(lists.offsets.to_numpy())
                    flat = lists.flatten().to_numpy().astype(np.uint64)
                    lang = batch.column("lang").to_numpy().astype(np.uint64)
                    keys = np.zeros((len(batch), 1 + int(lengths.max(initial=0))), np.uint64)
                    keys[:, 0] = lang
                    row = np.repeat(np.arange(len(batch)), lengths)
                    at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                    keys[row, 1 + at] = flat
                    hashes = key_hash(keys)
                for place in cls.places(hashes, mask):
                    np.bitwise_or.at(
                        bits, place >> np.uint64(3),
                        np.left_shift(np.uint8(1), (place & np.uint64(7)).astype(np.uint8)),
                    )
            return bits

        return cls(summed(phrases, mark, size // 8, np.uint8, "or"))


def _texts(documents: DataFrame) -> DataFrame:
    """lang (hash of its name) and text."""
    for_workers(documents.sparkSession)
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return documents.select(F.xxhash64(lang).alias("lang"), text.alias("text"))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, tuple[np.ndarray, ...]]]:
    """Lower-cased bytes, and for its words: start, end, hash, language, piece."""
    for batch in batches:
        langs = batch.column("lang").to_numpy().astype(np.uint64)
        for low, data, offsets in cut_slices(batch.column("text"), _BREAK, SLICE):
            data = lowered(data)
            start, end, word, doc, piece = word_spans(data, offsets)
            yield data, (start, end, word, langs[low + doc], piece)


def _grams(
    word: np.ndarray, lang: np.ndarray, piece: np.ndarray, lengths: range,
    frequent: Bits | None, pairs: Bits | None,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(keys, counts) of the phrases of these lengths whose parts are known as frequent."""
    width = lengths[-1] + 1
    chained = chain(lang, word)
    fit = frequent.has(chained) if frequent else np.ones(len(word), bool)
    two = None
    for n in range(1, lengths[-1] + 1):
        m = len(word) - n + 1
        if m <= 0:
            return
        if n > 1:
            chained = chain(chained[:m], word[n - 1 :])
            if n == 2:
                fit = fit[:m] & fit[1:] & (piece[:m] == piece[1:])
                if pairs:
                    at = np.flatnonzero(fit)
                    fit[at] = pairs.has(chained[at])
                two = fit
            else:
                fit = fit[:m] & two[n - 2 : n - 2 + m]
        if n in lengths:
            at = np.flatnonzero(fit)
            _, first, counts = np.unique(chained[at], return_index=True, return_counts=True)
            at = at[first]
            keys = np.zeros((len(at), width), np.uint64)
            keys[:, 0] = lang[at]
            for k in range(n):
                keys[:, k + 1] = word[at + k]
            yield keys, counts


def count_phrases(
    texts: DataFrame, lengths: range, least: int, parts: int,
    frequent: Bits | None = None, pairs: Bits | None = None,
) -> DataFrame:
    """lang, words, f of all phrases of these lengths with f of at least ``least``. If single words are
    counted, each language also has rows without words whose f add up to its words."""
    width = lengths[-1] + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(width)
        for _, (_, _, word, lang, piece) in _slices(batches):
            for keys, counts in _grams(word, lang, piece, lengths, frequent, pairs):
                for run in trie.add(keys, counts):
                    yield _run(*run, parts)
        for run in trie.spill(0):
            yield _run(*run, parts)

    def merged(runs: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
        keys = np.frombuffer(b"".join(w for w, _ in runs), np.uint64).reshape(-1, width)
        counts = np.frombuffer(b"".join(c for _, c in runs), np.int64)
        _, keys, counts = _summed_keys(key_hash(keys), keys, counts)
        langs, place = np.unique(keys[:, 0], return_inverse=True)
        totals = np.zeros(len(langs) if lengths[0] == 1 else 0, np.int64)
        if len(totals):
            np.add.at(totals, place, counts)
        keys, counts = keys[counts >= least], counts[counts >= least]
        flat = keys[:, 1:]
        ends = np.cumsum(np.concatenate([[0], (flat > 0).sum(1), np.zeros_like(totals)]))
        words = pa.ListArray.from_arrays(
            pa.array(ends.astype(np.int32)), pa.array(flat[flat > 0].astype(np.int64))
        )
        lang = np.concatenate([keys[:, 0], langs[: len(totals)]]).astype(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(lang), words, pa.array(np.concatenate([counts, totals]))],
            ["lang", "words", "f"],
        )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, runs = None, []
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("part", "words", "counts")))
            for part, words, counts in rows:
                if part != now and runs:
                    yield merged(runs)
                    runs = []
                now = part
                runs.append((words, counts))
        if runs:
            yield merged(runs)

    runs = texts.mapInArrow(count, _RUNS)
    return runs.repartition("part").sortWithinPartitions("part").mapInArrow(merge, _PHRASES)


def frequent_phrases(texts: DataFrame, least: int, longest: int) -> tuple[DataFrame, DataFrame]:
    """lang, words, f of all phrases of 1 to ``longest`` words with f >= ``least``; and lang, n."""
    single = stored(count_phrases(texts, range(1, 2), least, LEAST_PARTS), "words")
    totals = single.where(F.size("words") == 0).groupBy("lang").agg(F.sum("f").alias("n"))
    words = single.where(F.size("words") == 1)
    total = totals.agg(F.sum("n")).first()[0] or 0
    parts = max(LEAST_PARTS, total // PART_WORDS)
    frequent = Bits.of(words)
    pairs = stored(count_phrases(texts, range(2, 3), least, parts, frequent), "pairs")
    found = [words, pairs]
    if longest > 2:
        longer = count_phrases(texts, range(3, longest + 1), least, parts, frequent, Bits.of(pairs))
        found.append(longer)
    return stored(reduce(DataFrame.unionByName, found), "phrases"), stored(totals, "words-of")


def scored(phrases: DataFrame) -> DataFrame:
    """Candidates with their lowest-scoring cut: lang, words, a, l, r, score."""
    candidates = phrases.where(F.size("words") > 1).withColumnRenamed("f", "a")
    cuts = candidates.select(
        "*", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k")
    ).select(
        "*",
        F.slice("words", 1, F.col("k")).alias("first"),
        F.slice("words", F.col("k") + 1, F.size("words")).alias("rest"),
    )
    left = phrases.select("lang", F.col("words").alias("first"), F.col("f").alias("l"))
    right = phrases.select("lang", F.col("words").alias("rest"), F.col("f").alias("r"))
    whole = "decimal(20,0)"
    score = F.expr(
        f"(2000000 * cast(a as {whole})) div (cast(l as {whole}) + cast(r as {whole}))"
    )
    return (
        cuts.join(left, ["lang", "first"])
        .join(right, ["lang", "rest"])
        .groupBy("lang", "words", "a")
        .agg(F.min(F.struct(score.cast("long").alias("score"), "k", "l", "r")).alias("cut"))
        .select("lang", "words", "a", "cut.l", "cut.r", "cut.score")
    )


def without_covered(candidates: DataFrame, phrases: DataFrame) -> DataFrame:
    """Candidates that no longer one holds in at least 80 of 100 of their occurrences."""
    parts = F.expr(
        "flatten(transform(sequence(2, size(words) - 1), n -> "
        "transform(sequence(1, size(words) - n + 1), i -> slice(words, i, n))))"
    )
    covers = (
        phrases.where(F.size("words") > 2)
        .select("lang", F.explode(parts).alias("words"), F.col("f").alias("longer"))
        .groupBy("lang", "words")
        .agg(F.max("longer").alias("longer"))
    )
    whole = "decimal(20,0)"
    covered = F.expr(f"100 * cast(longer as {whole}) >= 80 * cast(a as {whole})")
    kept = F.col("longer").isNull() | ~covered
    return candidates.join(covers, ["lang", "words"], "left").where(kept).drop("longer")


def spelled(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """id and word of the given ids (column ``id``), from the texts."""
    bits = Bits.of(ids, words_only=True)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(0, np.uint64)
        for data, (start, end, word, _, _) in _slices(batches):
            at = np.flatnonzero(bits.has(word))
            new, first = np.unique(word[at], return_index=True)
            fresh = ~np.isin(new, seen, assume_unique=True)
            new, at = new[fresh], at[first[fresh]]
            seen = np.concatenate([seen, new])
            spans = zip(start[at].tolist(), end[at].tolist())
            words = [data[a:b].tobytes().decode() for a, b in spans]
            yield pa.RecordBatch.from_arrays(
                [pa.array(new.astype(np.int64)), pa.array(words, pa.string())], ["id", "word"]
            )

    found = texts.mapInArrow(find, "id long, word string")
    return found.groupBy("id").agg(F.min("word").alias("word")).join(ids, "id")


def _first(found: DataFrame, top: int, *by: str) -> DataFrame:
    """Rows among the first ``top`` by score and count, with all ties of the last."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.desc("a"))
    return found.withColumn("place", F.rank().over(order)).where(F.col("place") <= top).drop("place")


def collocations(
    documents: DataFrame, least: int = 30, longest: int = 4, top: int = 2000
) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    texts = _texts(documents)
    phrases, totals = frequent_phrases(texts, least, longest)
    kept = without_covered(scored(phrases), phrases)
    share = F.pmod(F.xxhash64("words"), F.lit(SHARES))
    some = _first(kept.withColumn("share", share), top, "lang", "share").drop("share")
    best = stored(_first(some, top, "lang"), "collocations")
    ids = stored(best.select(F.explode("words").alias("id")).distinct(), "word-ids")
    spelling = (
        best.select("lang", "words", F.posexplode("words").alias("pos", "id"))
        .join(spelled(texts, ids), "id")
        .groupBy("lang", "words")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "word"))).alias("spelled"))
        .select("lang", "words", F.array_join("spelled.word", " ").alias("phrase"))
    )
    name = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    names = documents.select(name.alias("name")).distinct().select(
        F.xxhash64("name").alias("lang"), "name"
    )
    order = Window.partitionBy("name").orderBy(F.desc("score"), F.desc("a"), "phrase")
    result = (
        best.join(spelling, ["lang", "words"]).join(totals, "lang").join(names, "lang")
        .withColumn("rank", F.row_number().over(order).cast("long"))
        .where(F.col("rank") <= top)
    )
    found = stored(
        result.select(F.col("name").alias("lang"), "rank", "phrase", "a", "l", "r", "n", "score"),
        "ranked",
    )
    dropped(phrases, totals, best, ids)
    return found


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of each language in the documents."""
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = r"""
with pieces as (
    select lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) as piece
    from (
        select coalesce(lang, 'und') as lang, translate(
            coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
        from documents
    )
),
words as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
totals as (select lang, sum(len(w))::bigint as n from words group by lang),
grams as (
    select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase
    from (
        select lang, k, w, unnest(range(1, len(w) - k + 2)) as i
        from words, (select unnest([1, 2, 3, 4]) as k) where len(w) >= k
    )
),
counted as (select lang, k, phrase, count(*)::bigint as f from grams group by all having f >= 30),
candidates as (
    select lang, k, phrase, f as a, string_split(phrase, ' ') as w from counted where k > 1
),
cuts as (
    select c.lang, c.k, c.phrase, c.a, c.cut, x.f as l, y.f as r,
           ((2000000::hugeint * c.a) // (x.f::hugeint + y.f))::bigint as score
    from (select *, unnest(range(1, k)) as cut from candidates) c
    join counted x on x.lang = c.lang and x.phrase = array_to_string(c.w[1:c.cut], ' ')
    join counted y on y.lang = c.lang and y.phrase = array_to_string(c.w[c.cut + 1:c.k], ' ')
),
scored as (
    select * from cuts
    qualify row_number() over (partition by lang, phrase order by score, cut) = 1
),
covers as (
    select lang, phrase, max(a) as longer
    from (
        select lang, a, array_to_string(w[i:i + n - 1], ' ') as phrase
        from (
            select lang, a, w, k, n, unnest(range(1, k - n + 2)) as i
            from (select *, unnest(range(2, k)) as n from candidates where k > 2)
        )
    )
    group by all
),
ranked as (
    select lang, phrase, a, l, r, n, score,
           row_number() over (partition by lang order by score desc, a desc, phrase) as rank
    from scored s join totals using (lang) left join covers v using (lang, phrase)
    where v.longer is null or 100::hugeint * v.longer < 80::hugeint * a
)
select lang, rank, phrase, a, l, r, n, score from ranked where rank <= 2000
"""
