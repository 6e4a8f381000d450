"""Jaccard self-join on five-word shingles with adaptive multi-match prefixes (operator 2).

Two documents link if their shingle sets have a Jaccard similarity of 0.75 or more. With the
shingles of every set in one global order, linked sets x and y share at least k of the first
``|x| - ceil(0.75 |x|) + k`` of x and of the same prefix of y, for any k. The order puts frequent
shingles last, by a fixed-size count sketch over all documents; it need not be exact, as any order
is lossless.

1. Sketch, size, identity (a 64-bit hash) and signature of each set. Equal sets are one node from
   here on. The signature has one bit for each value of a hash, flipped by each shingle: two
   signatures differ in at most as many bits as their sets in shingles, so it rules pairs out and
   never loses one.
2. Each node estimates the candidates its prefix would bring, and lengthens the prefix while that
   is worth it: with k - 1 more shingles it asks for k shared ones. Two nodes use the smaller k.
3. Prefix shingles meet by value, in order, as a stream: a task holds one list. A short list gives
   all its pairs; a long list (salted if the sketch says that it is very long) links every node to
   the first one only, and is kept for step 5.
4. Candidates that the signatures allow are verified on whole sets: first the best one of each
   node, then of each two components, then those that still join two components.
5. In long lists, pairs of nodes that are in different components are candidates too, so no link
   between components is lost; pairs inside a component need no check. Lists are compared in blocks,
   a very long one in several tasks, and only pairs that size, places and signatures allow leave a
   task: first one pair for each node, with the partner that has most partners itself, so that what
   links widely is one component; then all pairs of the components that are left, nearly always from
   the first list they share only. A group of thousands of near copies costs a few checks for each
   member, not all pairs.

Result: one row per document row. Cases: a missing or empty text has an empty set, links with
nothing and is its own component; fewer than five words are one shingle; repeated rows are kept
(equal sets link); a document without id takes the smallest id of its group, if any; an empty table
gives no rows; other columns are ignored. Only the bound of the sketch and of the filter over ids
is fixed; larger inputs make them less selective, never lossy.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.llm.common import (
    SMALL_SLICE_BYTES, Sums, Words, dropped, mix, numbers, stored, summed, table, text_slices, tidy,
    whole_texts,
)
from cadenza.llm.components import components

WIDTH = 5
#: Similarity as a fraction.
PART, WHOLE = 3, 4
SKETCH_BITS = 20
#: Lists up to this length give all their pairs at once.
SHORT = 8
#: Rows of one salted part of a long list, about.
SALTED = 128
#: Matches asked for fit 16 bits.
MOST_MATCHES = (1 << 16) - 1
CHANCE, ROW = 0.05, 4.0
FILTER_BITS = 23
#: Bits of a signature: four for each shingle within these limits; in a list one for each shingle, at
#: most ROW_BITS.
LEAST_BITS, MOST_BITS, ROW_BITS = 1 << 8, 1 << 16, 1 << 13
#: Bytes of signatures compared at once.
AT_ONCE = 4 << 20
#: Rows of one block of a long list, about.
BLOCK = 2048
#: Tokens a row of a long list carries to tell where its pairs met before: four entries fill 64 bits.
MET = 4
_NEVER = (1 << 63) - 1
_NONE = -(1 << 63)


def shingles(words: Words) -> list[np.ndarray]:
    """The set of each document, as sorted hashes."""
    at, hashes = words.windows(WIDTH)
    cuts = np.searchsorted(at, words.first)
    size = np.diff(words.first)
    whole = np.flatnonzero((size > 0) & (size < WIDTH))
    alone = Sums(words.hash).span(words.first[whole], words.first[whole + 1]) if len(whole) else []
    sets = [np.unique(hashes[a:b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
    for k, h in zip(whole.tolist(), alone):
        sets[k] = np.array([h], np.uint64)
    return sets


def node_of(members: np.ndarray) -> int:
    """A set's identity; 0 is the empty set."""
    if not len(members):
        return 0
    h = Sums(members).span(np.array([0]), np.array([len(members)]))
    return int(h.view(np.int64)[0]) or 1


def signature(members: np.ndarray) -> bytes:
    """A bit for each value of a hash, set if an odd number of members has that value."""
    bits = min(max(LEAST_BITS, 1 << (4 * len(members)).bit_length()), MOST_BITS)
    hits = np.bincount((members & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((hits & 1).astype(np.uint8)).tobytes()


def short_width(n: int) -> int:
    """Bytes of a set's signature in a list: with fewer bits than shingles it would rule out little."""
    return min(max(LEAST_BITS, 1 << (n - 1).bit_length()), ROW_BITS) // 8


def folded(signatures: np.ndarray, width: int) -> np.ndarray:
    """Signatures (one a row) as those of fewer bytes."""
    rows, size = signatures.shape
    return np.bitwise_xor.reduce(signatures.reshape(rows, size // width, width), axis=1)


class Signatures:
    """Signatures of several sizes, as one matrix for each width, with the wider ones folded."""

    def __init__(self, raw: list[bytes]):
        self.width = np.array([len(r) for r in raw], np.int64)
        self.row: dict[int, np.ndarray] = {}
        self.of: dict[int, np.ndarray] = {}
        at, wider = np.zeros(0, np.int64), None
        for width in np.unique(self.width)[::-1].tolist():
            own = np.flatnonzero(self.width == width)
            rows = np.frombuffer(b"".join([raw[k] for k in own.tolist()]), np.uint8)
            rows = rows.reshape(len(own), width)
            wider = rows if wider is None else np.vstack([folded(wider, width), rows])
            at = np.append(at, own)
            self.row[width] = np.zeros(len(raw), np.int64)
            self.row[width][at] = np.arange(len(at))
            self.of[width] = wider

    def allow(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether pairs of rows may link; n is the sum of their sizes."""
        keep = np.zeros(len(a), bool)
        width = np.minimum(self.width[a], self.width[b])
        for w in np.unique(width).tolist():
            at, row, bits = np.flatnonzero(width == w), self.row[w], self.of[w].view(np.uint64)
            for part in np.array_split(at, len(at) * w // AT_ONCE + 1):
                apart = np.bitwise_count(bits[row[a[part]]] ^ bits[row[b[part]]]).sum(1, dtype=np.int64)
                # Sets link if 4 both >= 3 (n - both), and differ in n - 2 both shingles.
                keep[part] = (WHOLE + PART) * apart <= (WHOLE - PART) * n[part]
        return keep


def prefix_size(n: int) -> int:
    return n - -(-PART * n // WHOLE) + 1


def _each_set(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    for low, high, data, offsets in text_slices(batch.column("text"), SMALL_SLICE_BYTES):
        yield low, high, shingles(Words.of(data, offsets, lower=True))


def profiles(texts: DataFrame) -> DataFrame:
    """doc_id, n, node, signature (also a shorter one) of each document row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, sets in _each_set(batch):
                signed = [signature(s) for s in sets]
                short = [
                    folded(np.frombuffer(bits, np.uint8)[None], short_width(len(s))).tobytes()
                    for bits, s in zip(signed, sets)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(low, high - low),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([node_of(s) for s in sets], pa.int64()),
                        pa.array(signed, pa.binary()), pa.array(short, pa.binary()),
                    ],
                    ["doc_id", "n", "node", "signed", "short"],
                )

    return texts.mapInArrow(tidy(work), "doc_id long, n long, node long, signed binary, short binary")


def sketch(texts: DataFrame) -> np.ndarray:
    """How many times longer than usual the list of a shingle is, as a power of two (0: usual), by
    the leading bits of its hash."""

    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            for _, _, sets in _each_set(batch):
                hashes = np.concatenate(sets) >> np.uint64(64 - SKETCH_BITS)
                total += np.bincount(hashes.astype(np.int64), minlength=len(total))
        return total

    found = summed(texts.select("text"), count, 1 << SKETCH_BITS, np.int64, "sum")
    usual = found.mean()
    excess = found - usual - 8 * np.sqrt(usual)
    return np.where(excess > SALTED, np.log2(np.maximum(excess, 1) / SALTED) + 1, 0).astype(np.uint8)


def ordered(members: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingles in the global order (rare first) and their levels."""
    levels = level[(members >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
    order = np.argsort(levels, kind="stable")  # members are sorted by hash already
    return members[order], levels[order]


def matches(levels: np.ndarray, n: int) -> int:
    """How many shared prefix shingles to ask for: the number with the least estimated cost. Each
    prefix shingle brings CHANCE partners, more if the sketch says so; one of them is a candidate if
    it comes up once for each match asked for, and costs a check of n shingles. Each row of the
    prefix costs ROW."""
    base = prefix_size(n)
    most = min(MOST_MATCHES, n - base + 1)
    brought = np.cumsum(np.exp2(levels[: base + most - 1].astype(float)) - 1 + CHANCE)[base - 1 :]
    asked = np.arange(1, most + 1)
    return int(np.argmin(n * brought / asked + ROW * asked)) + 1


def prefixes(texts: DataFrame, level: np.ndarray) -> DataFrame:
    """node, n, matches, prefix (hashes in order) of each different set of a task. A set that
    several tasks hold comes from each; its rows stand side by side in the lists and merge there."""
    shared = texts.sparkSession.sparkContext.broadcast(level)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, seen = shared.value, set()
        for batch in batches:
            for _, _, sets in _each_set(batch):
                rows = []
                for members in sets:
                    node = node_of(members)
                    if not len(members) or node in seen:
                        continue
                    seen.add(node)
                    order, levels = ordered(members, level)
                    k = matches(levels, len(members))
                    prefix = order[: prefix_size(len(members)) + k - 1]
                    rows.append((node, len(members), k, prefix.tobytes()))
                if rows:
                    columns = zip(*rows)
                    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(columns, kinds)],
                        ["node", "n", "matches", "prefix"],
                    )

    return texts.select("text").mapInArrow(tidy(work), "node long, n long, matches int, prefix binary")


def _packed(n: np.ndarray, entry: np.ndarray, asked: np.ndarray) -> np.ndarray:
    return n.astype(np.int64) << 32 | entry.astype(np.int64) << 16 | asked.astype(np.int64)


def listed(found: DataFrame, level: np.ndarray) -> DataFrame:
    """token, salt, node, meta (size, the matches from which the token counts, matches asked)."""
    shared = found.sparkSession.sparkContext.broadcast(level)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = shared.value
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                raw = [p.as_py() for p in part.column("prefix")]
                size = np.array([len(p) // 8 for p in raw])
                token = np.frombuffer(b"".join(raw), np.uint64)
                node, n, asked = (
                    np.repeat(part.column(c).to_numpy(zero_copy_only=False), size)
                    for c in ("node", "n", "matches")
                )
                place = np.arange(len(token)) - np.repeat(np.cumsum(size) - size, size)
                base = n - -(-PART * n // WHOLE) + 1
                entry = np.maximum(place - base + 2, 1)
                long = level[(token >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                draw = mix(token ^ mix(node.view(np.uint64)))
                parts = (np.int64(1) << np.minimum(long, 40).astype(np.int64)).view(np.uint64)
                salt = np.where(long > 0, (draw % parts).astype(np.int64) + 1, 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(token.view(np.int64)), pa.array(salt), pa.array(node),
                        pa.array(_packed(n, entry, asked)),
                    ],
                    ["token", "salt", "node", "meta"],
                )

    return found.mapInArrow(tidy(work), "token long, salt long, node long, meta long")


class Lists:
    """Rows sorted by (token, salt, node), cut into lists; gives pairs and the rows of long lists."""

    def __init__(self):
        self.pairs: list[np.ndarray] = []
        self.long: list[np.ndarray] = []

    def _pair(self, x: np.ndarray, y: np.ndarray, star: bool) -> None:
        """Rows of x and y share a token; keep those whose sizes allow a link and whose matches do
        count the token."""
        n, m = x[3] >> 32, y[3] >> 32
        entry = np.maximum(x[3] >> 16 & 0xFFFF, y[3] >> 16 & 0xFFFF)
        asked = np.minimum(x[3] & 0xFFFF, y[3] & 0xFFFF)
        keep = (PART * np.maximum(n, m) <= WHOLE * np.minimum(n, m)) & (entry <= asked)
        a, b = np.minimum(x[2], y[2]), np.maximum(x[2], y[2])
        found = np.stack([a, b, asked, np.full(len(a), int(star))])
        self.pairs.append(found[:, keep])

    def take(self, rows: np.ndarray, last: bool) -> np.ndarray:
        """Handle the complete lists of rows (token, salt, node, meta by row); return the rest. Equal
        rows (a set from several tasks) count once."""
        fresh = np.ones(rows.shape[1], bool)
        fresh[1:] = (rows[:3, 1:] != rows[:3, :-1]).any(0)
        rows = rows[:, fresh]
        total = rows.shape[1]
        if not total:
            return rows
        change = (rows[:2, 1:] != rows[:2, :-1]).any(0)
        first = np.concatenate([[0], np.flatnonzero(change) + 1])
        size = np.diff(np.append(first, total))
        rest = rows[:, total:]
        if not last:
            rest = rows[:, first[-1] :]
            first, size = first[:-1], size[:-1]
        salted = rows[1, first] > 0
        for s in range(2, SHORT + 1):
            at = first[(size == s) & ~salted]
            for i in range(s):
                for j in range(i + 1, s):
                    self._pair(rows[:, at + i], rows[:, at + j], False)
        for at, s in zip(*(v[(size > SHORT) | salted].tolist() for v in (first, size))):
            members = rows[:, at : at + s]
            self.long.append(members)
            if s > 1:
                self._pair(np.repeat(members[:, :1], s - 1, 1), members[:, 1:], True)
        return rest

    def rows(self) -> pa.RecordBatch | None:
        parts = [np.vstack([np.zeros(p.shape[1], np.int64)[None], p]) for p in self.pairs]
        parts += [np.vstack([np.ones(p.shape[1], np.int64)[None], p]) for p in self.long]
        self.pairs, self.long = [], []
        if not parts:
            return None
        return pa.RecordBatch.from_arrays([pa.array(c) for c in np.hstack(parts)], list("kabcd"))


def meet(rows: DataFrame) -> DataFrame:
    """k = 0: pairs (a, b) that share a token, c matches asked, d whether the list was long.
    k = 1: rows of long lists (a token, b salt, c node, d meta)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, rest = Lists(), np.zeros((4, 0), np.int64)
        for batch in batches:
            fresh = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            rest = lists.take(np.hstack([rest, fresh]), False)
            if (out := lists.rows()) is not None:
                yield out
        lists.take(rest, True)
        if (out := lists.rows()) is not None:
            yield out

    return (
        rows.repartition("token", "salt")
        .sortWithinPartitions("token", "salt", "node")
        .mapInArrow(tidy(work), "k long, a long, b long, c long, d long")
    )


class Blocks:
    """Rows of long lists, cut into blocks against blocks; gives pairs of different components."""

    COLUMNS = ("token", "u", "v", "side", "node", "component", "meta")
    #: For each class of tokens the smallest one in whose list the node is, and the matches from which
    #: it counts (16 bits each): two nodes that share one of these that counts for them and is smaller
    #: than the list's token have met there and are not given again.
    MET = (*(f"met{k}" for k in range(MET)), "entries")

    def __init__(self, hubs: bool = False):
        #: One pair for each row only: with the partner that has most partners.
        self.hubs = hubs
        self.found: list[np.ndarray] = []

    def _compare(self, rows: np.ndarray, signed: list[bytes]) -> None:
        token, u, v, side, node, component, meta = rows[: len(self.COLUMNS)]
        met = rows[len(self.COLUMNS) :]
        n, entry, asked = meta >> 32, meta >> 16 & 0xFFFF, meta & 0xFFFF
        same = u[0] == v[0]
        left = np.arange(len(node)) if same else np.flatnonzero(side == 0)
        right = left if same else np.flatnonzero(side == 1)
        signatures, kept = None, []
        for low in range(0, len(left), 256):
            x, y = left[low : low + 256, None], right[None]
            able = component[x] != component[y]
            if same:
                able &= x < y
            able &= PART * np.maximum(n[x], n[y]) <= WHOLE * np.minimum(n[x], n[y])
            able &= np.maximum(entry[x], entry[y]) <= np.minimum(asked[x], asked[y])
            i, j = np.nonzero(able)
            if not len(i):
                continue
            a, b = left[low + i], right[j]
            for k, first in enumerate(met[:-1]):
                since = np.maximum(met[-1][a] >> 16 * k & 0xFFFF, met[-1][b] >> 16 * k & 0xFFFF)
                before = (first[a] == first[b]) & (first[a] < token[0])
                fresh = ~before | (since > np.minimum(asked[a], asked[b]))
                a, b = a[fresh], b[fresh]
            signatures = signatures or Signatures(signed)
            keep = signatures.allow(a, b, n[a] + n[b])
            kept.append(np.stack([a[keep], b[keep]]).astype(np.int32))
        if not kept:
            return
        a, b = np.hstack(kept)
        if self.hubs:
            degree = np.bincount(a, minlength=len(node)) + np.bincount(b, minlength=len(node))
            rank = np.empty(len(node), np.int64)
            rank[np.lexsort((node, degree))] = np.arange(len(node))
            best = np.full(len(node), -1)
            np.maximum.at(best, a, rank[b])
            np.maximum.at(best, b, rank[a])
            a = np.flatnonzero(best >= 0)
            b = np.argsort(rank)[best[a]]
        ends = np.minimum(node[a], node[b]), np.maximum(node[a], node[b])
        self.found.append(np.stack([*ends, np.minimum(asked[a], asked[b])]))

    def take(
        self, rows: np.ndarray, signed: list[bytes], last: bool
    ) -> tuple[np.ndarray, list[bytes]]:
        """Compare the complete blocks; return the rest."""
        if not rows.shape[1]:
            return rows, signed
        change = (rows[:3, 1:] != rows[:3, :-1]).any(0)
        cuts = [0, *(np.flatnonzero(change) + 1).tolist()] + [rows.shape[1]] * last
        for low, high in zip(cuts, cuts[1:]):
            self._compare(rows[:, low:high], signed[low:high])
        return (rows[:, :0], []) if last else (rows[:, cuts[-1] :], signed[cuts[-1] :])

    def pairs(self) -> pa.RecordBatch | None:
        found, self.found = self.found, []
        if not found:
            return None
        return pa.RecordBatch.from_arrays([pa.array(c) for c in np.hstack(found)], ["a", "b", "asked"])


def crossing(
    long: DataFrame, labels: DataFrame, profile: DataFrame, hubs: bool = False
) -> DataFrame:
    """a, b, asked: pairs of different components in the long lists that size, places and signatures
    allow, few of them more than once; with ``hubs``, at most one for each row, and from each list.

    Whether a pair met in an earlier list its rows tell: each carries a few tokens of its node, so in
    the list of the smallest of them that both carry and that counts for both, the pair has come."""
    rows = stored(
        long.join(labels, "node", "left").select(
            "token", "node", "meta", F.coalesce("component", "node").alias("component")
        ),
        "long",
    )
    split = rows.groupBy("token").agg(
        F.min("component").alias("p"), F.max("component").alias("q"),
        F.ceil(F.count("*") / BLOCK).alias("blocks"),
    )
    rows = stored(rows.join(split.where("p <> q").select("token", "blocks"), "token"), "split-lists")
    ends = rows.select("node").distinct()
    signed = profile.join(ends, "node").groupBy("node").agg(F.min("short").alias("short"))
    columns = [*Blocks.COLUMNS, *(() if hubs else Blocks.MET)]
    if not hubs:
        entry = F.shiftright("meta", 16).bitwiseAND(0xFFFF)
        least = [
            F.min(F.when(F.pmod("token", F.lit(MET)) == k, F.struct("token", entry.alias("entry"))))
            for k in range(MET)
        ]
        met = rows.groupBy("node").agg(*(v.alias(f"least{k}") for k, v in enumerate(least)))
        since = [F.coalesce(F.col(f"least{k}.entry"), F.lit(0)) for k in range(MET)]
        packed = reduce(Column.bitwiseOR, (F.shiftleft(v, 16 * k) for k, v in enumerate(since)))
        met = met.select(
            "node", packed.alias("entries"),
            *(F.coalesce(f"least{k}.token", F.lit(_NEVER)).alias(Blocks.MET[k]) for k in range(MET)),
        )
        signed = signed.join(met, "node")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    placed = (
        rows.join(signed, "node")
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")))
        .withColumn("other", other)
        .withColumn("u", F.least("own", "other"))
        .withColumn("v", F.greatest("own", "other"))
        .withColumn("side", (F.col("own") != F.col("u")).cast("long"))
        .select(*columns, "short")
        .repartition("token", "u", "v")
        .sortWithinPartitions("token", "u", "v")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, rest, signed = Blocks(hubs), np.zeros((len(columns), 0), np.int64), []
        for batch in batches:
            fresh = np.stack([
                batch.column(c).to_numpy(zero_copy_only=False) for c in columns
            ])
            signed = signed + batch.column("short").to_pylist()
            rest, signed = blocks.take(np.hstack([rest, fresh]), signed, False)
            if (out := blocks.pairs()) is not None:
                yield out
        blocks.take(rest, signed, True)
        if (out := blocks.pairs()) is not None:
            yield out

    return placed.mapInArrow(tidy(work), "a long, b long, asked long")


def allowed(pairs: DataFrame, profile: DataFrame) -> DataFrame:
    """The pairs (a, b and more) that the signatures of their nodes allow."""
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    signed = profile.join(ends, "node").groupBy("node").agg(
        F.min("n").alias("n"), F.min("signed").alias("signed")
    )
    kept = pairs.schema
    for end in ("a", "b"):
        named = [F.col("node").alias(end), F.col("n").alias(f"__n{end}")]
        pairs = pairs.join(signed.select(*named, F.col("signed").alias(f"__s{end}")), end)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count = batch.num_rows
            both = [r for end in "ab" for r in batch.column(f"__s{end}").to_pylist()]
            n = batch.column("__na").to_numpy() + batch.column("__nb").to_numpy()
            row = np.arange(count)
            keep = Signatures(both).allow(row, row + count, n)
            yield batch.select(kept.names).filter(pa.array(keep))

    return pairs.mapInArrow(tidy(work), kept)


def verified(pairs: DataFrame, texts: DataFrame, profile: DataFrame) -> DataFrame:
    """Pairs (a, b) whose whole sets are similar enough. Only the sets of their ends are made."""
    pairs = stored(pairs.select("a", "b"), "pairs")
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = profile.join(ends, "node").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    sets = members_of(texts, wanted)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[at] == x).sum())
                keep.append(WHOLE * both >= PART * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    named = [sets.select(F.col("node").alias(k), F.col("members").alias(v)) for k, v in ("ax", "by")]
    links = pairs.join(named[0], "a").join(named[1], "b").select("a", "b", "x", "y")
    links = stored(links.mapInArrow(tidy(work), "a long, b long"), "links")
    dropped(pairs)
    return links


def members_of(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, members (sorted hashes) of the documents whose doc_id is in ``wanted``. A fixed-size
    filter over the ids goes to every task; what it lets through by mistake is unused."""

    def mark(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        bits = np.zeros(1 << FILTER_BITS, np.uint8)
        for batch in batches:
            bits[_bit(numbers(batch.column("doc_id")))] = 1
        return np.packbits(bits)

    bits = summed(wanted.select("doc_id"), mark, 1 << (FILTER_BITS - 3), np.uint8, "or")
    shared = texts.sparkSession.sparkContext.broadcast(bits)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(shared.value)
        for batch in batches:
            batch = batch.filter(pa.array(bits[_bit(numbers(batch.column("doc_id")))] > 0))
            for _, _, sets in _each_set(batch):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([node_of(s) for s in sets], pa.int64()),
                        pa.array([s.tobytes() for s in sets], pa.binary()),
                    ],
                    ["node", "members"],
                )

    return texts.mapInArrow(tidy(work), "node long, members binary").dropDuplicates(["node"])


def _bit(ids: np.ndarray) -> np.ndarray:
    return (mix(ids.astype(np.int64).view(np.uint64)) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose ends are in different components (a node without edges is its own)."""
    for end in ("a", "b"):
        of = labels.select(F.col("node").alias(end), F.col("component").alias(f"of_{end}"))
        pairs = pairs.join(of, end, "left")
        pairs = pairs.withColumn(f"own_{end}", F.coalesce(f"of_{end}", end)).drop(f"of_{end}")
    return pairs.where("own_a <> own_b")


def linked(texts: DataFrame, profile: DataFrame) -> DataFrame:
    """node, component of all nodes that link with another one."""
    level = sketch(texts)
    lists = stored(meet(listed(prefixes(texts, level), level)), "lists")
    # What a pair shares in long lists is known in part only: step 5 gives the rest.
    shared = lists.where("k = 0").groupBy("a", "b").agg(
        F.count("*").alias("found"), F.min("c").alias("asked")
    )
    promising = stored(shared.where("found >= asked"), "promising")
    candidates = stored(allowed(promising, profile), "candidates")
    long = lists.where("k = 1").select(
        F.col("a").alias("token"), F.col("c").alias("node"), F.col("d").alias("meta")
    )

    # The most promising partner of each node, then that of each two components, then all that
    # still join two components.
    better = F.struct("found", "a", "b")
    best = candidates.groupBy(F.col("b").alias("of")).agg(F.max(better).alias("p")).select("p.*")
    edges = verified(best, texts, profile)
    labels = components(edges)
    for every in (False, True):
        left = _apart(candidates, labels)
        if not every:
            ends = [F.least("own_a", "own_b"), F.greatest("own_a", "own_b")]
            left = left.groupBy(*ends).agg(F.max(better).alias("p")).select("p.*")
        edges = edges.union(verified(left, texts, profile))
        labels = components(edges)

    hubs = crossing(long, labels, profile, True).groupBy("a", "b").agg(F.count("*").alias("found"))
    hubs = stored(hubs, "hubs")
    ends = hubs.select(F.col("a").alias("of"), better.alias("p")).union(
        hubs.select("b", better)
    )
    best = ends.groupBy("of").agg(F.max("p").alias("p")).select("p.*").distinct()
    edges = edges.union(verified(best, texts, profile))
    labels = components(edges)
    # Checked pairs need no second check; whole signatures rule out more than those of the lists.
    across = crossing(long, labels, profile).select("a", "b").distinct()
    across = stored(across.join(promising.select("a", "b"), ["a", "b"], "left_anti"), "across")
    edges = edges.union(verified(allowed(across, profile), texts, profile))
    dropped(lists, promising, candidates, hubs, across)
    return components(edges)


def grouped(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of each document row; also its set's node, and the smallest
    node of its component (none for an empty set)."""
    texts = whole_texts(documents).withColumn("doc_id", F.coalesce("doc_id", F.lit(_NONE)))
    profile = stored(profiles(texts), "profiles")
    labels = linked(texts, profile)
    known = F.when(F.col("doc_id") != _NONE, F.col("doc_id"))
    placed = profile.where("n > 0").join(labels, "node", "left").select(
        "doc_id", "n", "node", F.coalesce("component", "node").alias("component")
    )
    least = placed.groupBy("component").agg(F.min(known).alias("component_id"))
    full = placed.join(least, "component").select(
        "doc_id", "n", "node", "component", "component_id"
    )
    empty = profile.where("n = 0").select(
        "doc_id", "n", "node", F.lit(None).cast("long"), known.alias("component_id")
    )
    return full.union(empty).select(
        known.alias("doc_id"), F.col("n").alias("n_shingles"), "component_id", "node", "component"
    )


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped(table(spark, sf_dir, "documents")).drop("node", "component")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Second stage of the pipeline: one row of each group of linked documents stays, the one with
    the smallest id (among equal ids the smallest set hash; of equal rows, one). Rows without words
    link with nothing and stay."""
    keepers = (
        grouped(docs)
        .where("n_shingles > 0")
        .groupBy("component")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "node")).alias("kept"))
        .select(
            F.coalesce("kept.doc_id", F.lit(_NONE)).alias("__id"),
            F.col("kept.node").alias("__node"),
            F.lit(True).alias("__keep"),
        )
    )
    at = docs.columns.index("text")
    marked = T.StructType([*docs.schema.fields, T.StructField("__node", T.LongType())])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column(at), SMALL_SLICE_BYTES):
                nodes = [node_of(s) for s in shingles(Words.of(data, offsets, lower=True))]
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(low, high - low).columns, pa.array(nodes, pa.int64())],
                    [*batch.schema.names, "__node"],
                )

    # A row without words gets a key of its own, so that it is no repetition of another.
    own = F.when(F.col("__node") == 0, F.monotonically_increasing_id())
    return (
        docs.mapInArrow(tidy(mark), marked)
        .withColumn("__id", F.coalesce(F.col("doc_id").cast("long"), F.lit(_NONE)))
        .withColumn("__own", own)
        .join(keepers, ["__id", "__node"], "left")
        .where("__node = 0 or __keep")
        .dropDuplicates(["__id", "__node", "__own"])
        .select(*docs.columns)
    )


ORACLE = """
WITH RECURSIVE split AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x20\\x09-\\x0D]+') AS words
    FROM documents
), starts AS (
    SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 1))) AS i FROM split
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(list_slice(words, i, i + 4), ' ') AS s FROM starts
    UNION ALL
    SELECT doc_id, array_to_string(words, ' ') FROM split WHERE len(words) BETWEEN 1 AND 4
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
    WHERE 100 * shared >= 75 * (p.n + q.n - shared)
), reach AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION
    SELECT reach.doc_id, links.y FROM reach JOIN links ON reach.other = links.x
)
SELECT reach.doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles,
    min(other) AS component_id
FROM reach LEFT JOIN sizes ON sizes.doc_id = reach.doc_id GROUP BY reach.doc_id
"""
