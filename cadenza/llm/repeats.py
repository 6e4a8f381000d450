"""Removal of long repeated passages by a compacted de Bruijn graph (operator 5).

A window is ``WINDOW`` consecutive words of one document; every word inside a window whose words
also start anywhere else is removed.

1. Each document is read as a path through a sparse de Bruijn graph: a window's anchor is its
   k-mer of words with the smallest hash, so equal windows have equal anchors, at the same place.
   An edge is the stretch of words from one anchor to the next.
2. One count per anchor: how often it occurs, and whether one and the same edge always leaves it
   and always enters it. A window whose anchor occurs once is unique.
3. A join brings the counts of repeated anchors back to their sources. Anchors whose edges never
   branch are compacted into paths: all occurrences of an anchor share all words of its path, so a
   window inside the path of its anchor is repeated, without a look at other documents. That
   depends on the window's own words only, so all occurrences of a window are decided alike.
4. Windows that reach beyond the path of their repeated anchor (near branches and the ends of
   passages) are verified by their own hash and source coordinates: counted, and joined back.

Counts are combined before they are shuffled and joins are plain sort-merge joins, so copies of one
passage in a third of all documents split over tasks. Which documents take part in steps 3 and 4 is
told by a fixed-size filter; what it lets through by mistake has no repeated window.

Cases: missing and empty texts have no words (the hash is that of the empty text); documents of
fewer than ``WINDOW`` words lose none; repeated rows and ids repeat each other; a passage repeated
within one document counts; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm.common import (
    Sums, Words, dropped, mix, numbers, stored, summed, table, text_slices, whole_texts,
)

WINDOW = 35
#: Words of a k-mer.
K = 12
FILTER_BITS = 24
#: Bytes of text whose windows are held at once.
SLICE = 1 << 20

_DOC = ["doc_id", "text_hash"]
_DOC_TYPES = "doc_id long, text_hash long"


class Paths:
    """Windows of some documents, their anchors, and the edges between anchors."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.words = words = Words.of(data, offsets)
        n = len(words.hash)
        self.sums = Sums(words.hash)
        none = np.zeros(0, np.int64)
        self.window, self.anchor_of, self.anchor, self.key = none, none, none, none
        #: Hash of each whole text, as bytes.
        self.text = Sums(data.astype(np.uint64) + np.uint64(1)).span(offsets[:-1], offsets[1:])
        if n < WINDOW:
            return
        at = np.arange(n - K + 1)
        kmers = self.sums.span(at, at + K)
        self.window = np.flatnonzero(words.doc[: n - WINDOW + 1] == words.doc[WINDOW - 1 :])
        views = np.lib.stride_tricks.sliding_window_view(kmers, WINDOW - K + 1)
        least = np.empty(len(self.window), np.int64)
        for low in range(0, len(least), 1 << 16):  # the first minimum of each window
            some = self.window[low : low + (1 << 16)]
            least[low : low + len(some)] = views[some].argmin(1) + some
        self.anchor, self.anchor_of = np.unique(least, return_inverse=True)
        self.key = kmers[self.anchor]

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """The hash of the edge into and out of each anchor; 0 at a document's end."""
        into, out = np.zeros((2, len(self.anchor)), np.uint64)
        if len(self.anchor) > 1:
            doc = self.words.doc[self.anchor]
            inner = np.flatnonzero(doc[1:] == doc[:-1])
            edge = self.sums.span(self.anchor[inner], self.anchor[inner + 1] + K) | np.uint64(1)
            out[inner], into[inner + 1] = edge, edge
        return into, out


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64))


def _doc_columns(paths: Paths, ids: pa.Array, doc: np.ndarray) -> list[pa.Array]:
    return [ids.take(pa.array(doc)), _signed(paths.text[doc])]


def occurrences(texts: DataFrame, edges: bool) -> DataFrame:
    """key of each anchor occurrence, with its edges or with its source coordinates."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column("text"), SLICE):
                paths = Paths(data, offsets)
                if edges:
                    rest, names = [_signed(e) for e in paths.edges()], ["into", "out"]
                else:
                    ids = batch.column("doc_id").slice(low, high - low)
                    doc = paths.words.doc[paths.anchor]
                    place = paths.anchor - paths.words.first[doc]
                    rest = [*_doc_columns(paths, ids, doc), pa.array(place, pa.int32())]
                    names = [*_DOC, "place"]
                yield pa.RecordBatch.from_arrays([_signed(paths.key), *rest], ["key", *names])

    rest = "into long, out long" if edges else f"{_DOC_TYPES}, place int"
    return texts.mapInArrow(work, f"key long, {rest}")


def repeated_anchors(texts: DataFrame) -> DataFrame:
    """key of each anchor that occurs more than once, whether one edge always enters and leaves."""
    counted = occurrences(texts, edges=True).groupBy("key").agg(
        F.count("*").alias("n"),
        *(f(e).alias(f"{name}_{e}") for e in ("into", "out") for name, f in (("min", F.min), ("max", F.max))),
    )
    one = [
        ((F.col(f"min_{e}") == F.col(f"max_{e}")) & (F.col(f"min_{e}") != 0)).alias(e)
        for e in ("into", "out")
    ]
    return counted.where("n > 1").select("key", *one)


def _filter_bit(ids: np.ndarray, text_hash: np.ndarray) -> np.ndarray:
    h = mix(ids.astype(np.int64).view(np.uint64)) ^ text_hash.astype(np.int64).view(np.uint64)
    return (mix(h) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _marked(found: DataFrame) -> np.ndarray:
    """A filter over the documents of ``found``."""

    def mark(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        bits = np.zeros(1 << FILTER_BITS, np.uint8)
        for batch in batches:
            bits[_filter_bit(*(numbers(batch.column(c)) for c in _DOC))] = 1
        return np.packbits(bits)

    return summed(found.select(*_DOC), mark, 1 << (FILTER_BITS - 3), np.uint8, "or")


def _hashed(texts: DataFrame, bits: np.ndarray, inside: bool) -> DataFrame:
    """doc_id, text_hash, text of the documents that the filter lets through, or of the others."""
    shared = texts.sparkSession.sparkContext.broadcast(bits)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column("text"), SLICE):
                hashes = Sums(data.astype(np.uint64) + np.uint64(1)).span(offsets[:-1], offsets[1:])
                part = batch.slice(low, high - low)
                keep = bits[_filter_bit(numbers(part.column("doc_id")), hashes.view(np.int64))]
                out = pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), _signed(hashes), part.column("text")], [*_DOC, "text"]
                )
                yield out.filter(pa.array(keep == inside))

    return texts.mapInArrow(work, f"{_DOC_TYPES}, text string")


def _reach(paths: Paths, into: np.ndarray, out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word, and one past the last, that all occurrences of each anchor share."""
    left, right = paths.anchor.copy(), paths.anchor + K
    for i in range(1, len(left)):
        if into[i]:
            left[i] = left[i - 1]
    for i in range(len(right) - 2, -1, -1):
        if out[i]:
            right[i] = right[i + 1]
    return left, right


def decided(flagged: DataFrame) -> DataFrame:
    """Of documents with the places of their repeated anchors (arrays place, into, out): windows
    [start, stop) that are repeated (hash null), and windows to be verified (hash, start)."""
    names = [*_DOC, "hash", "start", "stop"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column("text"), SLICE):
                paths, part = Paths(data, offsets), batch.slice(low, high - low)
                if not len(paths.window):
                    continue
                lists = part.column("anchors")
                size = np.diff(np.asarray(lists.offsets))
                values = lists.flatten()
                doc = np.repeat(np.arange(high - low), size)
                place = values.field("place").to_numpy(zero_copy_only=False)
                at = np.searchsorted(paths.anchor, place + paths.words.first[doc])
                known, into, out = np.zeros((3, len(paths.anchor)), bool)
                known[at] = True
                into[at] = values.field("into").to_numpy(zero_copy_only=False)
                out[at] = values.field("out").to_numpy(zero_copy_only=False)
                left, right = _reach(paths, into, out)
                of, window = paths.anchor_of, paths.window
                sure = known[of] & (left[of] <= window) & (window + WINDOW <= right[of])
                check = window[known[of] & ~sure]
                sure = window[sure]
                cut = np.flatnonzero(
                    np.append(True, (np.diff(sure) > 1) | (np.diff(paths.words.doc[sure]) > 0))
                ) if len(sure) else np.zeros(0, np.int64)
                begin, end = sure[cut], sure[np.append(cut[1:], len(sure)) - 1] + 1 if len(sure) else sure
                ids = part.column("doc_id")
                for start, stop, hashes in (
                    (begin, end, None), (check, check + 1, paths.sums.span(check, check + WINDOW))
                ):
                    doc = paths.words.doc[start]
                    base = paths.words.first[doc]
                    value = pa.nulls(len(start), pa.int64()) if hashes is None else _signed(hashes)
                    yield pa.RecordBatch.from_arrays(
                        [
                            *_doc_columns(paths, ids, doc), value,
                            pa.array(start - base, pa.int32()), pa.array(stop - base, pa.int32()),
                        ],
                        names,
                    )

    return flagged.mapInArrow(work, f"{_DOC_TYPES}, hash long, start int, stop int")


def _same(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join on the document; a missing id equals itself."""
    renamed = right.withColumnsRenamed({c: f"_{c}" for c in _DOC})
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in _DOC]
    return left.join(renamed, on, "left").drop(*(f"_{c}" for c in _DOC))


def repeated_windows(texts: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """doc_id, text_hash, spans (array of start, stop) of repeated windows; and a filter over those
    documents."""
    anchors = stored(
        occurrences(texts, edges=False).join(repeated_anchors(texts), "key").drop("key"), "anchors"
    )
    bits = _marked(anchors)
    lists = anchors.groupBy(*_DOC).agg(
        F.collect_set(F.struct("place", "into", "out")).alias("anchors")
    )
    flagged = _same(_hashed(texts, bits, True), lists).where("anchors is not null")
    windows = stored(decided(flagged), "windows")
    counts = windows.where("hash is not null").groupBy("hash").count().where("count > 1")
    repeated = windows.join(counts, "hash").select(*_DOC, "start", "stop").union(
        windows.where("hash is null").select(*_DOC, "start", "stop")
    )
    spans = stored(
        repeated.groupBy(*_DOC).agg(F.collect_set(F.struct("start", "stop")).alias("spans")), "spans"
    )
    dropped(anchors, windows)
    return spans, bits


def kept(texts: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, text: the words that stay, joined by one space."""
    return _kept(texts, digest=False)


def _kept(texts: DataFrame, digest: bool) -> DataFrame:
    spans, bits = repeated_windows(texts)
    last = "kept_sha256" if digest else "text"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, texts = [], [], []
            spans = batch.column("spans") if "spans" in batch.schema.names else [None] * batch.num_rows
            for text, found in zip(batch.column("text"), spans):
                words = text.as_buffer().to_pybytes().split()
                sizes.append(len(words))
                gone = 0
                if found is not None and found.is_valid:
                    edge = np.zeros(len(words) + 1, np.int64)
                    start, stop = (
                        found.values.field(c).to_numpy(zero_copy_only=False) for c in ("start", "stop")
                    )
                    np.add.at(edge, start, 1)
                    np.add.at(edge, stop + WINDOW - 1, -1)
                    stay = np.cumsum(edge[:-1]) == 0
                    gone = len(words) - int(stay.sum())
                    words = list(compress(words, stay.tolist()))
                removed.append(gone)
                joined = b" ".join(words)
                texts.append(hashlib.sha256(joined).hexdigest() if digest else joined.decode())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(sizes, pa.int64()),
                    pa.array(removed, pa.int64()), pa.array(texts, pa.string()),
                ],
                ["doc_id", "n_words", "n_removed", last],
            )

    schema = f"doc_id long, n_words long, n_removed long, {last} string"
    touched = _same(_hashed(texts, bits, True), spans)
    others = _hashed(texts, bits, False).select("doc_id", "text")
    return touched.mapInArrow(work, schema).union(others.mapInArrow(work, schema))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kept(whole_texts(table(spark, sf_dir, "documents")), digest=True)


ORACLE = """
WITH split AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
    FROM documents
), starts AS (
    SELECT doc_id, words, unnest(range(1, greatest(len(words) - 33, 1))) AS i FROM split
), windows AS (
    SELECT doc_id, i, array_to_string(list_slice(words, i, i + 34), ' ') AS s FROM starts
), repeated AS (
    SELECT s FROM windows GROUP BY s HAVING count(*) > 1
), gone AS (
    SELECT DISTINCT doc_id, i + k AS place
    FROM windows JOIN repeated USING (s), (SELECT unnest(range(0, 35)) AS k)
), words AS (
    SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM split
), kept AS (
    SELECT words.doc_id, count(*) AS n_words, count(gone.place) AS n_removed,
        string_agg(word, ' ' ORDER BY words.place) FILTER (WHERE gone.place IS NULL) AS text
    FROM words LEFT JOIN gone ON gone.doc_id = words.doc_id AND gone.place = words.place
    GROUP BY words.doc_id
)
SELECT d.doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words,
    CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(kept.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept ON kept.doc_id = d.doc_id
"""
