"""Exact top-k inner products by bit-sliced indexes (operator 6).

Vectors are quantised to integers, ``floor(256 x)``. Rows are dealt into blocks; a block holds, for
each component, bitmaps of its leading bits above the block's least value (the bit-sliced index), and
the integers themselves. A query adds the component slices, weighted by its own integers, with
bitmap arithmetic: carry-save additions of whole bitmaps, complements for negative weights. From the
most significant slice of the sum downward it selects the ``k`` best rows. The bits that the index
leaves out bound the error, so rows that could still reach the best ones are a boundary set; their
scores are computed exactly from the integers.

Queries go to blocks in chunks, as an equi-join on the block number (the stated query set against all
rows); each block returns k rows for each query, which are merged.

Cases: vectors that are missing or hold missing or non-finite components take no part, nor do rows
without id; the query's own id is no candidate; rows with an id and vector seen before are dropped;
vectors of another length than the query's are not compared; equal scores go to the smaller id; an
empty table gives no rows; other columns are ignored. Components are below 2^20 in size, so sums
fit 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.llm.common import for_workers, stored, table

SCALE = 256
#: Rows of a block, queries of a chunk, and bits of each component that the index keeps.
BLOCK, CHUNK, BITS = 1 << 14, 32, 7

BLOCKS = "block int, width int, ids binary, vectors binary, least binary, shift int, slices binary"


def quantised(embeddings: DataFrame) -> DataFrame:
    """vec_id, width, vector (array of long), valid and different rows only."""
    value = F.col("embedding")
    good = F.forall(
        value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    return (
        embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), value)
        .where(F.col("vec_id").isNotNull() & value.isNotNull())
        .where(F.coalesce(good, F.lit(False)) & (F.size(value) > 0))
        .select(
            "vec_id",
            F.size(value).alias("width"),
            F.transform(value, lambda x: F.floor(x.cast("double") * SCALE)).alias("vector"),
        )
        .distinct()
    )


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as 64-bit words, low bit first."""
    n = bits.shape[-1]
    words = np.zeros((*bits.shape[:-1], -(-n // 64) * 8), np.uint8)
    words[..., : -(-n // 8)] = np.packbits(bits, axis=-1, bitorder="little")
    return words.view(np.uint64)


class Index:
    """The bit slices of one block of integer vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.least = vectors.min(0)
        above = vectors - self.least
        self.shift = max(0, int(above.max()).bit_length() - BITS)
        lead = above >> self.shift
        planes = (lead.T[:, None, :] >> np.arange(BITS)[None, :, None] & 1).astype(bool)
        #: component x bit x words
        self.slices = _packed(planes)
        self.live = _packed(np.ones((1, len(ids)), bool))[0]

    def sums(self, query: np.ndarray) -> np.ndarray:
        """Bit slices of the sum over components of |q| times the leading bits (of their complement
        where q is negative)."""
        weight = np.abs(query)
        top = max(int(weight.sum()) * ((1 << BITS) - 1), 1).bit_length() + 1
        words = self.slices.shape[2]
        total, carry = np.zeros((2, top, words), np.uint64)
        for d in np.flatnonzero(weight).tolist():
            planes = ~self.slices[d] if query[d] < 0 else self.slices[d]
            w = int(weight[d])
            while w:
                low = (w & -w).bit_length() - 1
                w &= w - 1
                add = np.zeros((top - low, words), np.uint64)
                add[:BITS] = planes
                s, c = total[low:], carry[low:]
                half = s ^ c
                out = (s & c) | (half & add)
                total[low:] = half ^ add
                carry[low] = 0
                carry[low + 1 :] = out[:-1]
        over = np.zeros(words, np.uint64)
        for i in range(top):
            s, c = total[i], carry[i]
            half = s ^ c
            after = (s & c) | (half & over)
            total[i] = half ^ over
            over = after
        return total

    def best(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows, smaller ids first among equal scores."""
        slices = self.sums(query)
        alive = self.live & ~_packed((self.ids == own)[None])[0]
        # The kth greatest sum, from the most significant slice downward.
        sure, maybe, kth, need = np.zeros_like(alive), alive, 0, k
        if int(np.bitwise_count(alive).sum()) > k:
            for i in range(len(slices) - 1, -1, -1):
                ones = maybe & slices[i]
                n = int(np.bitwise_count(sure | ones).sum())
                if n >= k:
                    maybe, kth = ones, kth | 1 << i
                else:
                    sure, maybe = sure | ones, maybe & ~slices[i]
        else:
            kth = 0
        # Left-out bits add less than 2^shift for each unit of weight.
        slack = ((1 << self.shift) - 1) * int(np.abs(query).sum())
        bound = max(0, kth - -(-slack >> self.shift)) if slack else kth
        above, equal = np.zeros_like(alive), alive
        for i in range(len(slices) - 1, -1, -1):
            if bound >> i & 1:
                equal = equal & slices[i]
            else:
                above, equal = above | (equal & slices[i]), equal & ~slices[i]
        rows = np.flatnonzero(np.unpackbits((above | equal).view(np.uint8), bitorder="little"))
        scores = self.vectors[rows].astype(np.int64) @ query
        order = np.lexsort((self.ids[rows], -scores))[:k]
        return self.ids[rows][order], scores[order]


def blocks(rows: DataFrame, n: int) -> DataFrame:
    """Rows (of one width each) as n numbered blocks."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        ids, vectors = [], []
        for batch in batches:
            ids.append(batch.column("vec_id").to_numpy())
            vectors += [np.asarray(v.values, np.int64) for v in batch.column("vector")]
        if not ids:
            return
        ids, width = np.concatenate(ids), np.array([len(v) for v in vectors])
        out = []
        for w in np.unique(width).tolist():
            mine = np.flatnonzero(width == w)
            matrix = np.array([vectors[i] for i in mine])
            out.append((number, w, ids[mine].tobytes(), matrix.astype("<i8").tobytes()))
        yield pa.RecordBatch.from_pylist(
            [dict(zip(("block", "width", "ids", "vectors"), row)) for row in out],
            pa.schema([("block", pa.int32()), ("width", pa.int32()), ("ids", pa.binary()), ("vectors", pa.binary())]),
        )

    schema = "block int, width int, ids binary, vectors binary"
    return rows.repartition(n).mapInArrow(pack, schema)


def chunks(queries: DataFrame) -> DataFrame:
    """Queries in packs of CHUNK: chunk, width, ids, vectors."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        kept: dict[int, list[tuple[int, np.ndarray]]] = {}
        number = 0

        def row(width: int) -> pa.RecordBatch:
            ids, vectors = zip(*kept.pop(width))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part << 32 | number]),
                    pa.array([width], pa.int32()),
                    pa.array([np.array(ids, np.int64).tobytes()], pa.binary()),
                    pa.array([np.array(vectors, np.int64).tobytes()], pa.binary()),
                ],
                ["chunk", "width", "query_ids", "queries"],
            )

        for batch in batches:
            for i, v in zip(batch.column("vec_id").to_pylist(), batch.column("vector")):
                vector = np.asarray(v.values, np.int64)
                kept.setdefault(len(vector), []).append((i, vector))
                if len(kept[len(vector)]) == CHUNK:
                    yield row(len(vector))
                    number += 1
        for width in list(kept):
            yield row(width)
            number += 1

    return queries.mapInArrow(pack, "chunk long, width int, query_ids binary, queries binary")


def search(embeddings: DataFrame, queries_are: str, k: int) -> DataFrame:
    """query_id, rank, vec_id, score of the k best rows for each row that ``queries_are`` selects."""
    for_workers(embeddings.sparkSession)
    rows = stored(quantised(embeddings), "vectors")
    n = max(1, -(-rows.count() // BLOCK))
    index = blocks(rows, n)
    asked = chunks(rows.where(queries_are)).select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("block")
    )
    # A few copies of each block, so that its chunks spread over tasks.
    copies = 8
    index = index.select("*", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy"))
    asked = asked.withColumn("copy", F.pmod(F.xxhash64("chunk"), F.lit(copies)).cast("int"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, index = None, None
        for batch in batches:
            for row in range(batch.num_rows):
                got = {c: batch.column(c)[row].as_py() for c in batch.schema.names if c != "vectors"}
                if key != (got["block"], got["width"]):
                    key = (got["block"], got["width"])
                    ids = np.frombuffer(got["ids"], np.int64)
                    vectors = batch.column("vectors")[row].as_buffer()
                    index = Index(ids, np.frombuffer(vectors, np.int64).reshape(len(ids), -1))
                query_ids = np.frombuffer(got["query_ids"], np.int64)
                queries = np.frombuffer(got["queries"], np.int64).reshape(len(query_ids), -1)
                found = [index.best(q, i, k) for i, q in zip(query_ids.tolist(), queries)]
                sizes = [len(f[0]) for f in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(query_ids, sizes)),
                        pa.array(np.concatenate([f[0] for f in found])),
                        pa.array(np.concatenate([f[1] for f in found])),
                    ],
                    ["query_id", "vec_id", "score"],
                )

    found = asked.join(index, ["block", "width", "copy"]).sortWithinPartitions("block", "width")
    found = found.mapInArrow(work, "query_id long, vec_id long, score long").distinct()
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0", 5)


ORACLE = """
WITH parts AS (
    SELECT vec_id, unnest(range(len(embedding))) AS place,
           unnest(embedding) AS x
    FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
), bad AS (
    SELECT DISTINCT vec_id FROM parts WHERE x IS NULL OR NOT isfinite(x)
), whole AS (
    SELECT vec_id, place, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS x
    FROM parts WHERE vec_id NOT IN (SELECT vec_id FROM bad)
), scores AS (
    SELECT q.vec_id AS query_id, v.vec_id, CAST(sum(q.x * v.x) AS BIGINT) AS score
    FROM whole q JOIN whole v ON q.place = v.place AND q.vec_id <> v.vec_id
    WHERE q.vec_id % 50 = 0 GROUP BY ALL
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM scores
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
