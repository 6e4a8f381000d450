"""Quality scores from random-indexing word vectors and a small network (operator 10).

1. Every word (a run of word characters or of other visible characters, case kept) falls into one
   of ``BUCKETS`` buckets. A bucket has a fixed sparse random index vector; the vector of a word is
   the sum of the index vectors of the words up to two places away, over all documents.
2. A document is pooled: weighted mean, deviation and maximum of its word vectors, where frequent
   words weigh less.
3. A two-layer network learns the label from at most ``MOST_LABELLED`` labelled documents that are
   not held out; a fifth of them is kept back to choose the temperature that divides its output.

Only the text is an input of a score. The vectors are ``BUCKETS`` x ``DIMS`` numbers whatever the
input, so they may be summed over all tasks and sent to each.

Cases: missing and empty texts pool to zero and get the score of that; with fewer than
``LEAST_LABELLED`` labelled rows, or one kind only, every score is the share of label 1 (0.5 without any); repeated rows are kept and scored
alike; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm.common import Words, mix, table, text_slices, whole_texts
from cadenza.llm.labelled import held_out, training_texts

BUCKETS, DIMS, REACH, NONZERO = 1 << 14, 32, 2, 2
MOST_LABELLED = 20_000
LEAST_LABELLED = 10
THRESHOLD = 0.3
HIDDEN, EPOCHS = 32, 60
_SLICES = 16


def _places() -> tuple[np.ndarray, np.ndarray]:
    """The index vector of each bucket: NONZERO places and signs."""
    h = mix(np.arange(BUCKETS * NONZERO, dtype=np.uint64) + np.uint64(0x5BD1E995))
    place = (h % np.uint64(DIMS)).astype(np.int64).reshape(BUCKETS, NONZERO)
    sign = np.where(h >> np.uint64(63), 1.0, -1.0).reshape(BUCKETS, NONZERO)
    return place, sign


def _buckets(words: Words) -> np.ndarray:
    return (words.hash >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def contexts(documents: DataFrame) -> np.ndarray:
    """Context sums of each bucket and, in the last column, how often it occurs."""
    width = DIMS + 1
    step = BUCKETS // _SLICES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, sign = _places()
        total = np.zeros(BUCKETS * width)
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column("text")):
                words = Words.runs(data, offsets)
                b = _buckets(words)
                total += np.bincount(b * width + DIMS, minlength=len(total))
                for reach in range(1, REACH + 1):
                    near = words.doc[reach:] == words.doc[:-reach]
                    left, right = b[:-reach][near], b[reach:][near]
                    for word, context in ((left, right), (right, left)):
                        for k in range(NONZERO):
                            total += np.bincount(
                                word * width + place[context, k], sign[context, k], len(total)
                            )
        if total.any():
            parts = total.reshape(_SLICES, -1).astype(np.float32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(_SLICES), pa.int32()),
                    pa.array([p.tobytes() for p in parts], pa.binary()),
                ],
                ["slice", "sums"],
            )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for s, part in zip(batch.column("slice").to_pylist(), batch.column("sums")):
                part = np.frombuffer(part.as_buffer(), np.float32)
                sums[s] = sums.get(s, 0) + part.astype(np.float64)
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()])],
                ["slice", "sums"],
            )

    schema = "slice int, sums binary"
    parts = whole_texts(documents).select("text").mapInArrow(count, schema)
    parts = parts.repartition(_SLICES, "slice").mapInArrow(add, schema)
    found = np.zeros((BUCKETS, width))
    for row in parts.collect():  # _SLICES rows of a fixed size
        at = row["slice"] * step
        found[at : at + step] = np.frombuffer(row["sums"]).reshape(step, width)
    return found


def word_vectors(sums: np.ndarray) -> np.ndarray:
    """Unit vectors times a weight that falls with the word's share of all words, and the weight."""
    share = sums[:, DIMS] / max(sums[:, DIMS].sum(), 1.0)
    weight = 1e-3 / (1e-3 + share)
    length = np.sqrt((sums[:, :DIMS] ** 2).sum(1, keepdims=True))
    unit = sums[:, :DIMS] / np.maximum(length, 1e-9)
    return np.hstack([unit * weight[:, None], weight[:, None]]).astype(np.float32)


def pool(data: np.ndarray, offsets: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Mean, deviation and maximum of the word vectors of each document; zero without words."""
    words = Words.runs(data, offsets)
    docs = len(offsets) - 1
    out = np.zeros((docs, 3 * DIMS), np.float32)
    full = np.flatnonzero(np.diff(words.first))
    if len(full):
        rows = vectors[_buckets(words)]
        at = words.first[full]
        n = np.diff(words.first)[full][:, None]
        weight = np.add.reduceat(rows[:, DIMS], at)[:, None] + 1e-9
        values = rows[:, :DIMS]
        mean = np.add.reduceat(values, at) / weight
        spread = np.add.reduceat(values * values, at) / n - (np.add.reduceat(values, at) / n) ** 2
        out[full] = np.hstack(
            [mean, np.sqrt(np.maximum(spread, 0)), np.maximum.reduceat(values, at)]
        )
    return out


class Network:
    """Two layers and a temperature, fitted by Adam on minibatches."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        rng = np.random.default_rng(7)
        self.prior = float(y.mean()) if len(y) else 0.5
        self.constant = len(y) < LEAST_LABELLED or not 0 < self.prior < 1
        if self.constant:
            return
        order = rng.permutation(len(y))
        cut = max(1, len(y) // 5)
        kept, rest = order[:cut], order[cut:]
        self.mean, self.scale = x[rest].mean(0), x[rest].std(0) + 1e-6
        z = (x - self.mean) / self.scale
        d = x.shape[1]
        p = [
            rng.normal(0, d**-0.5, (d, HIDDEN)), np.zeros(HIDDEN),
            rng.normal(0, HIDDEN**-0.5, HIDDEN), np.array(np.log(self.prior / (1 - self.prior))),
        ]
        m, v, t = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
        for epoch in range(EPOCHS):
            for at in np.array_split(rng.permutation(rest), max(1, len(rest) // 256)):
                h = np.tanh(z[at] @ p[0] + p[1])
                error = (1 / (1 + np.exp(-(h @ p[2] + p[3]))) - y[at]) / max(len(at), 1)
                back = error[:, None] * p[2] * (1 - h * h)
                grads = [z[at].T @ back + 1e-4 * p[0], back.sum(0), h.T @ error, error.sum()]
                t += 1
                rate = 3e-3 * (1 - epoch / EPOCHS) * np.sqrt(1 - 0.999**t) / (1 - 0.9**t)
                for k, g in enumerate(grads):
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    p[k] = p[k] - rate * m[k] / (np.sqrt(v[k]) + 1e-8)
        self.p, self.temperature = p, 1.0
        logits, goal = self.logits(x[kept]), y[kept]
        temperatures = np.geomspace(0.25, 8, 61)
        losses = [np.mean(np.logaddexp(0, logits / c) - goal * logits / c) for c in temperatures]
        self.temperature = float(temperatures[int(np.argmin(losses))])

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) / self.scale
        return (np.tanh(z @ self.p[0] + self.p[1]) @ self.p[2] + self.p[3]) / self.temperature

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant:
            return np.full(len(x), self.prior)
        return 1 / (1 + np.exp(-np.clip(self.logits(x.astype(np.float64)), -60, 60)))


def fit(documents: DataFrame, labels: DataFrame) -> tuple[np.ndarray, Network]:
    vectors = word_vectors(contexts(documents))
    shared = documents.sparkSession.sparkContext.broadcast(vectors)
    marked = training_texts(documents, labels, "quality", held_out(5, 0), MOST_LABELLED)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column("text")):
                rows = pool(data, offsets, shared.value)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("label").slice(low, high - low),
                        pa.array([r.tobytes() for r in rows], pa.binary()),
                    ],
                    ["label", "x"],
                )

    rows = marked.select("text", "label").mapInArrow(features, "label int, x binary").collect()
    rows.sort(key=lambda r: (r["label"], bytes(r["x"])))  # the same order in any run
    x = np.array([np.frombuffer(r["x"], np.float32) for r in rows], np.float64)
    network = Network(x.reshape(len(rows), 3 * DIMS), np.array([r["label"] for r in rows], float))
    return vectors, network


def scored(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    vectors, network = fit(documents, labels)
    shared = documents.sparkSession.sparkContext.broadcast((vectors, network))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, network = shared.value
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column("text")):
                score = network.score(pool(data, offsets, vectors))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(low, high - low), pa.array(score)],
                    ["doc_id", "score"],
                )

    return (
        whole_texts(documents)
        .mapInArrow(work, "doc_id long, score double")
        .select(
            "doc_id",
            held_out(5, 0).alias("held_out"),
            "score",
            (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        )
    )


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
