"""What the operators share: tables, written stages, and texts as flat byte arrays.

Texts reach numpy as Arrow string buffers. Words, their hashes and the hashes of word windows are
computed for many documents at once; a window hash is a difference of prefix sums modulo 2^64, so
its cost does not depend on its length. Hashes are 64 bit; two different word sequences share one
with a chance of about 2^-64 for each pair compared.
"""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import cadenza
from cadenza.session import shared_dir

SLICE_BYTES = 2 << 20
#: For work that keeps many arrays of a text's length: a worker holds less, and in nearer caches.
SMALL_SLICE_BYTES = 512 << 10
_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_KIND = np.full(256, 2, np.uint8)
_KIND[_SPACE] = 0
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the one that all executors share."""
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back: the lineage ends here.

    Shuffle files of what is done go when the driver collects its handles to them, which a driver
    with a large heap may not do for half an hour; so it is asked to.
    """
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(*frames: DataFrame) -> None:
    """Delete stages that nothing reads any more."""
    for df in frames:
        jvm = df.sparkSession.sparkContext._jvm
        for file in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(file)
            path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(
                path, True
            )


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a missing id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


_shipped: set[str] = set()


def for_workers(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application, and bound Arrow batches in
    bytes, so that long texts do not add up in a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(cadenza.__file__).parent
        # The driver serves this file to all executors for as long as it runs.
        archive = f"{tempfile.mkdtemp()}/cadenza-{context.applicationId}.zip"
        with zipfile.ZipFile(archive, "w") as file:
            for module in package.rglob("*.py"):
                file.write(module, module.relative_to(package.parent))
        context.addPyFile(archive)
        _shipped.add(context.applicationId)


_SLICES = 16


def summed(
    df: DataFrame,
    count: Callable[[Iterator[pa.RecordBatch]], np.ndarray],
    size: int,
    kind: type,
    how: str,
) -> np.ndarray:
    """The sum or union of bits over all tasks of an array of fixed size that ``count`` makes in each.
    Slices of the arrays meet in a few streaming tasks; only the result comes to the driver."""
    step = size // _SLICES

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = count(batches).astype(kind)
        if found.any():
            rows = [found[k * step : (k + 1) * step].tobytes() for k in range(_SLICES)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(_SLICES), pa.int32()), pa.array(rows, pa.binary())],
                ["slice", "part"],
            )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, part in zip(batch.column("slice").to_pylist(), batch.column("part")):
                part = np.frombuffer(part.as_buffer(), kind)
                if k not in totals:
                    totals[k] = part.copy()
                elif how == "or":
                    totals[k] |= part
                else:
                    totals[k] += part
        if totals:
            rows = [t.tobytes() for t in totals.values()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(totals), pa.int32()), pa.array(rows, pa.binary())],
                ["slice", "part"],
            )

    for_workers(df.sparkSession)
    schema = "slice int, part binary"
    arrays = df.mapInArrow(tidy(parts), schema).repartition(_SLICES, "slice")
    arrays = arrays.mapInArrow(tidy(add), schema)
    result = np.zeros(size, kind)
    for row in arrays.collect():  # one fixed-size array in _SLICES rows
        result[row["slice"] * step :][:step] = np.frombuffer(row["part"], kind)
    return result


def whole_texts(documents: DataFrame) -> DataFrame:
    """doc_id and text; a missing text is empty."""
    for_workers(documents.sparkSession)
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = n + n // 8
        for k, factor in enumerate((_MULTIPLIER, _INVERSE)):
            base = np.full(size, factor, np.uint64)
            base[0] = 1
            _powers[k] = np.multiply.accumulate(base)
    return _powers[0][:n], _powers[1][:n]


class Sums:
    """Hashes of any span of a sequence, from prefix sums."""

    def __init__(self, values: np.ndarray):
        power, self.inverse = _power(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * power[: len(values)], out=self.sums[1:])

    def span(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start])


@dataclass
class Words:
    """Words of consecutive documents: byte spans, document number, hash."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray
    #: First word of each document, and one past the last.
    first: np.ndarray
    #: Hashes of any span of bytes.
    bytes: Sums

    @classmethod
    def of(cls, data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
        if lower:
            data = _LOWER[data]
        n, docs = len(data), len(offsets) - 1
        inside = ~_SPACE[data]
        begins, ends = inside.copy(), inside.copy()
        if n:
            begins[1:] &= ~inside[:-1]
            ends[:-1] &= ~inside[1:]
            cut = offsets[:-1][offsets[:-1] < n]
            begins[cut] = inside[cut]
            cut = offsets[1:][offsets[1:] > 0] - 1
            ends[cut] = inside[cut]
        start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        first = np.searchsorted(start, offsets)
        spans = Sums(data.astype(np.uint64) + np.uint64(1))
        doc = np.repeat(np.arange(docs), np.diff(first))
        return cls(data, start, end, doc, spans.span(start, end), first, spans)

    @classmethod
    def runs(cls, data: np.ndarray, offsets: np.ndarray) -> Words:
        """Runs of word characters (letters, digits, all beyond ASCII) and runs of other visible
        characters, each a word of its own."""
        kind, n, docs = _KIND[data], len(data), len(offsets) - 1
        begins = np.ones(n, bool)
        if n:
            begins[1:] = kind[1:] != kind[:-1]
            begins[offsets[:-1][offsets[:-1] < n]] = True
        start = np.flatnonzero(begins)
        end = np.append(start[1:], n)[: len(start)]
        visible = kind[start] > 0 if n else np.zeros(0, bool)
        start, end = start[visible], end[visible]
        first = np.searchsorted(start, offsets)
        spans = Sums(data.astype(np.uint64) + np.uint64(1))
        doc = np.repeat(np.arange(docs), np.diff(first))
        return cls(data, start, end, doc, spans.span(start, end), first, spans)

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of all windows of one document each, and their hashes."""
        n = len(self.hash)
        if n < width:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.doc[: n - width + 1] == self.doc[width - 1 :])
        return at, Sums(self.hash).span(at, at + width)


def text_slices(
    texts: pa.Array, size: int = SLICE_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of pieces of about ``size`` bytes; whole rows only."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, where, values = texts.buffers()
    if not len(texts):
        return
    offsets = np.frombuffer(where, kind)[texts.offset : texts.offset + len(texts) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(values, np.uint8) if values else np.zeros(0, np.uint8)
    low = 0
    while low < len(texts):
        high = int(np.searchsorted(offsets, offsets[low] + size, "right")) - 1
        high = min(max(high, low + 1), len(texts))
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def tidy(
    work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``work``, returning freed memory to the system when a task ends: a worker is kept for later
    tasks, and its allocators would keep what the largest batches took."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
        if trim:
            trim(0)

    return run


def cut_slices(
    texts: pa.Array, cuts: np.ndarray, size: int = SLICE_BYTES
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) like ``text_slices``, but a row of far more than ``size`` bytes
    comes in several parts, each ending behind a byte that ``cuts`` (256 flags) names."""
    for low, _, data, offsets in text_slices(texts, size):
        if len(offsets) > 2 or len(data) <= 2 * size:
            yield low, data, offsets
            continue
        begin = 0
        while begin < len(data):
            end = begin + size
            while end < len(data) and not cuts[data[end - 1]]:
                near = np.flatnonzero(cuts[data[end : end + size]])
                end += int(near[0]) + 1 if len(near) else size
            end = min(end, len(data))
            yield low, data[begin:end], np.array([0, end - begin])
            begin = end


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z."""
    return _LOWER[data]


def numbers(column: pa.Array) -> np.ndarray:
    """A long column as int64; missing values become the smallest one."""
    return pc.fill_null(column, -(1 << 63)).to_numpy(zero_copy_only=False).astype(np.int64)
