"""Toxicity scores by weak supervision (operator 4).

1. Voters: lexicons of insults by theme and language, lexicons mined from at most ``MOST_LABELLED``
   labelled documents that are not held out (words and beginnings of words), and patterns (masked words, shouting, repeated or dense hits).
   Each document gets one bit for each voter.
2. Label model: documents are counted by their bits (at most one count for each combination), over
   the whole table. A two-class generative model of the bits is fitted by EM: labelled training rows
   have a known class, all others a latent one. It estimates how often each voter fires in each
   class (its accuracy) and, within classes, how voters correlate; voters that repeat each other
   are discounted by that.
3. A linear classifier over hashed words and voters learns the posterior of the labelled sample
   under the label model (not the labels), with an L1 penalty, so that words that mean nothing
   weigh nothing however long a text is.

Only the text is an input of a score.

Cases: missing and empty texts get the score of a text without words; without labelled rows of both
kinds nothing is mined and the label model starts from the fixed lexicons; repeated rows are kept
and scored alike; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm.common import (
    SMALL_SLICE_BYTES, Words, lowered, table, text_slices, tidy, whole_texts,
)
from cadenza.llm.labelled import held_out, training_texts

MOST_LABELLED = 8_000
THRESHOLD = 0.3
#: Hashed words of the classifier.
FEATURES = 1 << 16
#: A word is mined if its share among toxic documents exceeds that among others so many deviations.
MINE_DEVIATIONS = 8.0
MINED_VOTERS = 6
#: So many labelled rows with the same bits weigh as much as the model's own posterior.
MODEL_ROWS = 20.0
#: Beginnings of words, in bytes, that are words of their own to the miner and the classifier:
#: inflected and compounded insults share them.
STEMS = (6, 7)
PENALTY = 2e-4

# Fixed word lists.
LEXICONS = {
    "intellect": "idiot idiots stupid moron morons imbecile dumb dumbass fool dunce brainless",
    "worth": "worthless pathetic useless loser losers failure hopeless inferior",
    "disgust": "disgusting scum trash garbage filth filthy vermin vile repulsive",
    "mockery": "clown clowns freak creep coward weirdo liar hypocrite",
    "threat": "kill murder hang strangle exterminate",
    "vulgar": "damn crap bastard bitch asshole shit fuck fucking whore slut",
    "german": "idiotin dumm dummkopf arschloch abschaum verlierer wertlos widerlich trottel hure",
    "french": "idiote imbécile connard salope ordure minable dégoûtant débile crétin nul",
    "spanish": "estúpido imbécil basura asqueroso inútil patético tonto mierda puta cabrón",
}
PATTERNS = ("masked", "shouting", "twice", "several", "dense")
VOTERS = [*LEXICONS, *(f"mined{k}" for k in range(MINED_VOTERS)), *PATTERNS]


@dataclass
class Tokens:
    """Words and their beginnings."""

    words: Words
    word: np.ndarray
    doc: np.ndarray
    hash: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray, offsets: np.ndarray) -> Tokens:
        words = Words.runs(lowered(data), offsets)
        places, hashes = [np.arange(len(words.doc))], [words.hash]
        for size in STEMS:
            long = np.flatnonzero(words.end - words.start > size)
            start = words.start[long]
            places.append(long)
            hashes.append(words.bytes.span(start, start + size) ^ np.uint64(size))
        place = np.concatenate(places)
        return cls(words, place, words.doc[place], np.concatenate(hashes))


def _hash_words(words: list[str]) -> np.ndarray:
    raw = np.frombuffer(" ".join(words).encode(), np.uint8)
    return Words.runs(raw, np.array([0, len(raw)])).hash


class Voters:
    """The lexicons as sorted word hashes with a bit for each."""

    def __init__(self, mined: np.ndarray):
        hashes, bits = [], []
        for k, words in enumerate(LEXICONS.values()):
            found = _hash_words(words.split())
            hashes.append(found)
            bits.append(np.full(len(found), 1 << k, np.int64))
        # The mined words come from the surest to the least sure; each voter takes one stretch.
        hashes.append(mined)
        rank = np.arange(len(mined)) * MINED_VOTERS // max(len(mined), 1)
        bits.append(1 << (len(LEXICONS) + rank))
        hashes, bits = np.concatenate(hashes), np.concatenate(bits)
        self.hashes, place = np.unique(hashes, return_inverse=True)
        self.bits = np.zeros(len(self.hashes), np.int64)
        np.bitwise_or.at(self.bits, place, bits)
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[self.hashes >> np.uint64(48)] = True

    def votes(self, data: np.ndarray, tokens: Tokens) -> np.ndarray:
        """Bits of each document; data: the text before its case was folded."""
        words = tokens.words
        docs = len(words.first) - 1
        out = np.zeros(docs, np.int64)
        at = np.flatnonzero(self.maybe[tokens.hash >> np.uint64(48)])
        place = np.minimum(np.searchsorted(self.hashes, tokens.hash[at]), len(self.hashes) - 1)
        hit = self.hashes[place] == tokens.hash[at]
        at, place = at[hit], place[hit]
        np.bitwise_or.at(out, tokens.doc[at], self.bits[place])
        hits = np.bincount(words.doc[np.unique(tokens.word[at])], minlength=docs)
        first = len(VOTERS) - len(PATTERNS)
        # masked: letters, stars, letters without a gap
        stars = words.data[words.start] == ord("*")
        inner = np.zeros(len(stars), bool)
        if len(stars) > 2:
            whole = words.data[words.end - 1] == ord("*")
            touch = words.end[:-1] == words.start[1:]
            inner[1:-1] = stars[1:-1] & whole[1:-1] & touch[:-1] & touch[1:]
            inner[1:-1] &= (words.doc[:-2] == words.doc[2:])
        out |= (np.bincount(words.doc[inner], minlength=docs) > 0).astype(np.int64) << first
        upper = np.concatenate([[0], np.cumsum((data >= 65) & (data <= 90))])
        lower = np.concatenate([[0], np.cumsum((data >= 97) & (data <= 122))])
        loud = (upper[words.end] - upper[words.start] > 1) & (lower[words.end] == lower[words.start])
        share = np.bincount(words.doc[loud], minlength=docs)
        out |= ((share >= 5) & (4 * share >= np.diff(words.first))).astype(np.int64) << (first + 1)
        size = np.diff(words.first)
        for k, fired in enumerate((hits >= 2, hits >= 4, (hits >= 2) & (100 * hits >= size))):
            out |= fired.astype(np.int64) << (first + 2 + k)
        return out


def _features(words: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, hashed word) pairs."""
    pairs = words.doc * FEATURES + (words.hash >> np.uint64(48)).astype(np.int64)
    pairs = np.unique(pairs)
    return pairs // FEATURES, pairs % FEATURES


def mine(sample: DataFrame) -> np.ndarray:
    """Words (hashes) that toxic documents of the sample hold far more often than others do; surest
    first. Counted by Spark: a row for each document (word 0) and each of its different words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column("text"), SMALL_SLICE_BYTES):
                tokens = Tokens.of(data, offsets)
                label = np.asarray(batch.column("label").slice(low, high - low))
                order = np.lexsort((tokens.hash, tokens.doc))
                doc, word = tokens.doc[order], tokens.hash[order]
                new = np.ones(len(doc), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (word[1:] != word[:-1])
                words = np.concatenate([np.zeros(high - low, np.uint64), word[new]])
                labels = np.concatenate([label, label[doc[new]]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words.view(np.int64)), pa.array(labels.astype(np.int64))],
                    ["word", "label"],
                )

    counted = (
        sample.select("label", "text")
        .mapInArrow(tidy(work), "word long, label long")
        .groupBy("word")
        .agg(F.sum("label").alias("in1"), F.sum(1 - F.col("label")).alias("in0"))
    )
    # Words in fewer toxic documents are not mined; the sample bounds what is left.
    rows = counted.where("in1 >= 5 or word = 0").where(
        "word = 0 or in1 > in0 / 10"
    ).collect()
    totals = {r["word"]: (r["in1"], r["in0"]) for r in rows}
    n1, n0 = totals.pop(0, (0, 0))
    if not n1 or not n0 or not totals:
        return np.zeros(0, np.uint64)
    distinct = np.array(sorted(totals), np.int64)
    in1, in0 = np.array([totals[w] for w in distinct.tolist()], float).T
    distinct = distinct.view(np.uint64)
    p1, p = in1 / n1, (in1 + in0) / (n1 + n0)
    deviation = np.sqrt(p * (1 - p) * (1 / n1 + 1 / n0)) + 1e-12
    keen = (p1 - in0 / n0) / deviation > MINE_DEVIATIONS
    found = np.flatnonzero(keen & (p1 > 10 * in0 / n0))
    odds = (in1[found] / n1 + 1e-4) / (in0[found] / n0 + 1e-4)
    return distinct[found[np.lexsort((distinct[found], -odds))]]


class LabelModel:
    """Two classes, voters with class-wise firing rates and correlations, fitted by EM."""

    def __init__(self, bits: np.ndarray, label: np.ndarray, count: np.ndarray):
        """Combinations of bits with a label (0, 1, or -1 for none) and how many documents have it."""
        v = self.matrix(bits)
        known = label >= 0
        weight = count.astype(float)
        total = weight[known].sum()
        if total:  # the unlabelled rows together weigh as much as the labelled ones
            weight[~known] *= total / max(weight[~known].sum(), 1.0)
        any_lexicon = v[:, : len(LEXICONS)].any(1)
        # Labels of training rows with the same bits: what independence gets wrong, they mend.
        self.patterns, place = np.unique(bits, return_inverse=True)
        self.seen = np.bincount(place, count * known, len(self.patterns))
        self.toxic = np.bincount(place, count * (label == 1), len(self.patterns))
        q = np.where(known, label, any_lexicon).astype(float)
        if not known.any() or label[known].min() == label[known].max():
            known = np.zeros(len(label), bool)
            q = any_lexicon * 0.9 + 0.05
        else:
            self._maximise(v[known], q[known], weight[known])
            q = np.where(known, q, self.posterior(bits))
        for _ in range(30):
            self._maximise(v, q, weight)
            q = np.where(known, q, self.posterior(bits))

    @staticmethod
    def matrix(bits: np.ndarray) -> np.ndarray:
        return (bits[:, None] >> np.arange(len(VOTERS)) & 1).astype(float)

    def _maximise(self, v: np.ndarray, q: np.ndarray, weight: np.ndarray) -> None:
        self.rates, covariance = [], 0.0
        for share in (1 - q, q):
            w = share * weight
            rate = (w @ v + 0.5) / (w.sum() + 1000.0 * 0.5)
            centred = v - (w @ v) / max(w.sum(), 1e-9)
            covariance = covariance + (centred * w[:, None]).T @ centred
            self.rates.append(rate)
        self.prior = float(np.clip((q * weight).sum() / max(weight.sum(), 1e-9), 1e-3, 1 - 1e-3))
        scale = np.sqrt(np.maximum(np.diag(covariance), 1e-12))
        self.correlation = covariance / np.outer(scale, scale)
        np.fill_diagonal(self.correlation, 0.0)
        self.trust = 1 / (1 + np.maximum(self.correlation, 0.0).sum(1))

    def posterior(self, bits: np.ndarray) -> np.ndarray:
        v, (r0, r1) = self.matrix(bits), self.rates
        fired, silent = np.log(r1 / r0), np.log((1 - r1) / (1 - r0))
        logit = np.log(self.prior / (1 - self.prior))
        # A voter that fired counts less for each correlated one that fired too.
        alone = 1 / (1 + v @ np.maximum(self.correlation, 0.0))
        logit = logit + (v * alone) @ fired + (1 - v) @ (self.trust * silent)
        modelled = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        place = np.minimum(np.searchsorted(self.patterns, bits), len(self.patterns) - 1)
        there = self.patterns[place] == bits
        seen, toxic = self.seen[place] * there, self.toxic[place] * there
        return (toxic + MODEL_ROWS * modelled) / (seen + MODEL_ROWS)


class Linear:
    """L1-penalised logistic regression over word features and voter bits, by accelerated
    proximal gradient on soft labels."""

    def __init__(self, docs: np.ndarray, words: np.ndarray, bits: np.ndarray, goal: np.ndarray):
        n = len(goal)
        self.weights = np.zeros(FEATURES + len(VOTERS))
        self.bias = float(np.log((goal.mean() + 1e-3) / (1 - goal.mean() + 1e-3))) if n else 0.0
        if not n:
            return
        row, voter = np.nonzero(LabelModel.matrix(bits))
        rows = np.concatenate([docs, row])
        columns = np.concatenate([words, FEATURES + voter])
        used, column = np.unique(columns, return_inverse=True)
        w, bias = np.zeros(len(used)), self.bias
        norm = np.bincount(rows, minlength=n).max(initial=1)
        # Frequent words are damped, so one step size fits all.
        damp = 1 / np.sqrt(np.maximum(np.bincount(column), 1) / n * norm + 1)
        x = damp[column]
        ahead, ahead_bias, t = w.copy(), bias, 1.0
        step = 4.0 * n / max((np.bincount(rows, x * x, n)).max() * n, 1.0)
        for _ in range(150):
            z = np.bincount(rows, x * ahead[column], n) + ahead_bias
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - goal) / n
            gradient = np.bincount(column, x * error[rows], len(used))
            moved = ahead - step * n * 0.25 * gradient
            shrink = step * n * 0.25 * PENALTY
            moved = np.sign(moved) * np.maximum(np.abs(moved) - shrink, 0)
            moved_bias = ahead_bias - 2.0 * error.sum()
            after = (1 + np.sqrt(1 + 4 * t * t)) / 2
            ahead = moved + (t - 1) / after * (moved - w)
            ahead_bias = moved_bias + (t - 1) / after * (moved_bias - bias)
            w, bias, t = moved, moved_bias, after
        self.weights[used], self.bias = w * damp, float(bias)

    def score(self, docs: np.ndarray, words: np.ndarray, bits: np.ndarray) -> np.ndarray:
        z = np.bincount(docs, self.weights[words], len(bits)) + self.bias
        z = z + LabelModel.matrix(bits) @ self.weights[FEATURES:]
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def votes_of(documents: DataFrame, voters: Voters) -> DataFrame:
    """doc_id, bits."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column("text"), SMALL_SLICE_BYTES):
                bits = voters.votes(data, Tokens.of(data, offsets))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(low, high - low), pa.array(bits)],
                    ["doc_id", "bits"],
                )

    return whole_texts(documents).mapInArrow(tidy(work), "doc_id long, bits long")


def fit(documents: DataFrame, labels: DataFrame) -> tuple[Voters, LabelModel, Linear]:
    sample = training_texts(documents, labels, "toxic", held_out(4, 2), MOST_LABELLED)

    voters = Voters(mine(sample))

    marked = sample.select("doc_id", "label").distinct()
    counted = (
        votes_of(documents, voters)
        .join(F.broadcast(marked), "doc_id", "left")
        .groupBy("bits", F.coalesce("label", F.lit(-1)).alias("label"))
        .count()
        .collect()
    )
    counted.sort()
    bits, label, count = (np.array([r[k] for r in counted], np.int64) for k in range(3))
    model = LabelModel(bits, label, count)


    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column("text"), SMALL_SLICE_BYTES):
                tokens = Tokens.of(data, offsets)
                doc, word = _features(tokens)
                cuts = np.searchsorted(doc, np.arange(high - low + 1)).tolist()
                word = word.astype(np.uint16)
                sets = [word[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sets, pa.binary()), pa.array(voters.votes(data, tokens))],
                    ["words", "bits"],
                )

    rows = sample.select("text").mapInArrow(tidy(work), "words binary, bits long").collect()
    rows = sorted((bytes(r["words"]), r["bits"]) for r in rows)  # the same order in any run
    docs = np.repeat(np.arange(len(rows)), [len(r[0]) // 2 for r in rows])
    words = np.frombuffer(b"".join(r[0] for r in rows), np.uint16).astype(np.int64)
    sample_bits = np.array([r[1] for r in rows], np.int64)
    linear = Linear(docs, words, sample_bits, model.posterior(sample_bits))
    return voters, model, linear


def scored(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    voters, _, linear = fit(documents, labels)
    return _scores(whole_texts(documents), voters, linear).select(
        "doc_id",
        held_out(4, 2).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def _scores(texts: DataFrame, voters: Voters, linear: Linear) -> DataFrame:
    shared = texts.sparkSession.sparkContext.broadcast((voters, linear))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters, linear = shared.value
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column("text"), SMALL_SLICE_BYTES):
                words = Tokens.of(data, offsets)
                score = linear.score(*_features(words), voters.votes(data, words))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(low, high - low), pa.array(score)],
                    ["doc_id", "score"],
                )

    return texts.mapInArrow(tidy(work), "doc_id long, score double")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """First stage of the pipeline: rows of documents that are not toxic. Every row is scored with
    its own text, in the task that reads it."""
    voters, _, linear = fit(docs, table(spark, sf_dir, "labels"))
    shared = spark.sparkContext.broadcast((voters, linear))
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            voters, linear = shared.value
            texts = batch.column(at)
            for low, high, data, offsets in text_slices(texts, SMALL_SLICE_BYTES):
                words = Tokens.of(data, offsets)
                score = linear.score(*_features(words), voters.votes(data, words))
                yield batch.slice(low, high - low).filter(pa.array(score < THRESHOLD))

    return docs.mapInArrow(tidy(keep), docs.schema)
