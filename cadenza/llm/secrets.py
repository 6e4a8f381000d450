"""Secrets in texts: fixed patterns, and character Markov models for the rest (operator 8).

Only DataFrame functions are used. Positions come from the pieces between matches: a match starts
where the pieces and matches before it end, in code points.

Two first-order Markov models over printable ASCII, of random strings and of ordinary words, are
trained on labelled strings of at most ``MOST_SAMPLED`` documents: values that the patterns found
are random, alphabetic words of six letters or more are ordinary. ``PRIOR`` pseudo counts stand for
strings over hexadecimal and base64 alphabets, and for words and numbers, so that a pair of characters that
the sample lacks has a likelihood too. A run of ``LEAST`` or more key characters outside all pattern
spans is a secret if its log-likelihood ratio exceeds ``MARGIN``.

Result: one row per document row. Cases: missing and empty texts have no span (hash of the empty
string); repeated rows are kept; without any matches the models rest on the words and the pseudo
counts; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import string

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm.common import table

#: Labelled strings come from so many documents, those with the smallest hash of their id.
MOST_SAMPLED = 3_000
LEAST = 20
MARGIN = 8.0
PRIOR = 40.0

# Fixed patterns: kind, expression, group whose length counts, least length.
PATTERNS = (
    (
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        8,
    ),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]+", 0, 32),
)
RUN = r"[A-Za-z0-9+/_=-]{20,}"
#: Cheap necessary conditions: most texts are never split.
HINTS = {
    "assign": r"(?i)password|passwd|secret|token|api_?key",
    "access": r"AKIA[A-Z0-9]",
    "hex": r"[0-9a-f]{32}",
    "model": r"[A-Za-z0-9+/_=-]{20}",
}
_SPAN = "array<struct<start:int,kind:int,end:int>>"


def _spans(text: Column, kind: int, pattern: str, group: int, least: int) -> Column:
    """Spans of the matches whose group is long enough."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    pieces = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"), whole.alias("whole"), value.alias("value")
    )

    def step(state: Column, piece: Column) -> Column:
        start = state["at"] + F.length(piece["gap"])
        end = start + F.coalesce(F.length(piece["whole"]), F.lit(0))
        found = F.array(F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end")))
        good = F.coalesce(F.length(piece["value"]) >= least, F.lit(False))
        out = F.when(good, F.concat(state["out"], found)).otherwise(state["out"])
        return F.struct(end.alias("at"), out.alias("out"))

    first = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))
    return F.aggregate(pieces, first, step, lambda state: state["out"])


def _hinted(text: Column, name: str, spans: Column) -> Column:
    return F.when(text.rlike(HINTS[name]), spans).otherwise(F.array().cast(_SPAN))


def pattern_spans(documents: DataFrame) -> DataFrame:
    """doc_id, text, base (spans of the fixed patterns, by start and kind)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    parts = [
        _hinted(F.col("text"), name, _spans(F.col("text"), k, pattern, group, least))
        for k, (name, pattern, group, least) in enumerate(PATTERNS)
    ]
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).select(
        "doc_id", "text", F.sort_array(F.concat(*parts)).alias("base")
    )


def _long(strings: Column, least: int) -> Column:
    return F.filter(strings, lambda s: F.length(s) >= least)


def _of_kind(spans: str, kind: int) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def labelled_strings(documents: DataFrame) -> DataFrame:
    """label (1 random, 0 ordinary) and different strings of a bounded sample of documents: copies
    of one secret teach no more than one."""
    ids = (
        documents.select(F.col("doc_id").cast("long").alias("doc_id"))
        .where("doc_id is not null")
        .distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(MOST_SAMPLED)
    )
    # MOST_SAMPLED numbers: a proven bound.
    sample = pattern_spans(documents.select("doc_id", "text")).join(F.broadcast(ids), "doc_id")
    random = [
        _long(F.regexp_extract_all("text", F.lit(pattern), F.lit(group)), least)
        for _, pattern, group, least in PATTERNS
    ]
    words = F.regexp_extract_all("text", F.lit(r"\b[A-Za-z]{6,}\b"), F.lit(0))
    return sample.select(F.explode(F.concat(*random)).alias("string"), F.lit(1).alias("label")).union(
        sample.select(F.explode(words).alias("string"), F.lit(0).alias("label"))
    ).distinct()


def ratios(strings: DataFrame) -> list[float]:
    """Log-likelihood ratio of each pair of ASCII characters, at 128 * first + second."""
    pairs = F.transform(
        F.sequence(F.lit(1), F.length("string") - 1), lambda i: F.col("string").substr(i, F.lit(2))
    )
    counted = (
        strings.where("length(string) > 1")
        .select("label", F.explode(pairs).alias("pair"))
        .groupBy("label", "pair")
        .count()
        .collect()  # at most 2 x 128 x 128 rows
    )
    counts = np.zeros((2, 128, 128))
    alphabets = (
        (0, string.ascii_lowercase, 1.0), (0, string.ascii_uppercase, 0.5),
        (0, string.digits, 1.0), (0, string.ascii_letters, 0.2),
        (0, string.ascii_letters + string.digits + "+/_=-", 0.1),
        (1, "0123456789abcdef", 1.0), (1, "0123456789ABCDEF", 0.5),
        (1, string.ascii_letters + string.digits + "+/_=-", 1.0),
    )
    for label, alphabet, weight in alphabets:
        at = np.frombuffer(alphabet.encode(), np.uint8)
        counts[label][np.ix_(at, at)] += PRIOR * weight / len(at)
    for row in counted:
        a, b = map(ord, row["pair"])
        counts[row["label"], a, b] += row["count"]
    counts += 1e-3
    chance = counts / counts.sum(2, keepdims=True)
    return np.log(chance[1] / chance[0]).ravel().round(6).tolist()


def _ratio(run: Column, table_: Column) -> Column:
    codes = F.transform(F.split(run, ""), F.ascii)
    size = F.greatest(F.size(codes) - 1, F.lit(0))
    first, second = F.slice(codes, F.lit(1), size), F.slice(codes, F.lit(2), size)
    pairs = F.zip_with(first, second, lambda a, b: F.element_at(table_, a * 128 + b + 1))
    return F.aggregate(pairs, F.lit(0.0), lambda total, x: total + x)


def _model_spans(table_: Column) -> Column:
    """Runs of key characters that the models call random, apart from all pattern spans."""
    text = F.col("text")
    runs = _spans(text, len(PATTERNS), RUN, 0, LEAST)

    def apart(run: Column) -> Column:
        return ~F.exists("base", lambda b: (b["start"] < run["end"]) & (run["start"] < b["end"]))

    def odd(run: Column) -> Column:
        return _ratio(text.substr(run["start"] + 1, run["end"] - run["start"]), table_) > MARGIN

    return _hinted(text, "model", F.filter(F.filter(runs, apart), odd))


def _joined(spans: Column) -> Column:
    names = F.array(*(F.lit(n) for n in [p[0] for p in PATTERNS] + ["model"]))
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])
        ),
        ",",
    )


def found(documents: DataFrame) -> DataFrame:
    """doc_id, text, base and spans (arrays of start, kind, end; base spans among them)."""
    table_ = F.lit(ratios(labelled_strings(documents)))
    return pattern_spans(documents).withColumn(
        "spans", F.sort_array(F.concat("base", _model_spans(table_)))
    )


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = found(table(spark, sf_dir, "documents"))
    counts = [
        F.size(_of_kind("base", k)).cast("long").alias(f"n_{name}")
        for k, (name, *_) in enumerate(PATTERNS)
    ]
    return rows.select(
        "doc_id",
        *counts,
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans are one."""
    names = F.array(*(F.lit(f"[{n}]") for n in [p[0] for p in PATTERNS] + ["model"]))

    def step(state: Column, span: Column) -> Column:
        gap = text.substr(state["at"] + 1, F.greatest(span["start"] - state["at"], F.lit(0)))
        mark = F.when(span["start"] >= state["at"], F.element_at(names, span["kind"] + 1))
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.concat(state["out"], gap, F.coalesce(mark, F.lit(""))).alias("out"),
        )

    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.aggregate(
        spans, first, step, lambda s: F.concat(s["out"], text.substr(s["at"] + 1, F.length(text)))
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fourth stage of the pipeline: all rows, secrets in their texts replaced by the kind in
    brackets, ``n_chars`` (if there) counted again. Rows without a secret are unchanged."""
    table_ = F.lit(ratios(labelled_strings(docs)))
    rest = docs.select("*", F.struct("*").alias("__row"))
    inner = rest.select("__row", F.col("doc_id"), F.col("text"))
    inner = inner.select(
        "__row",
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    parts = [
        _hinted(F.col("text"), name, _spans(F.col("text"), k, pattern, group, least))
        for k, (name, pattern, group, least) in enumerate(PATTERNS)
    ]
    marked = inner.select("__row", "text", F.sort_array(F.concat(*parts)).alias("base"))
    marked = marked.select(
        "__row", "text", F.sort_array(F.concat("base", _model_spans(table_))).alias("__spans")
    )
    clean = F.when(F.size("__spans") > 0, redacted(F.col("text"), F.col("__spans")))
    marked = marked.select("__row", F.coalesce(clean, F.col("__row.text")).alias("__text"))
    columns = [
        F.col("__text").alias("text")
        if c == "text"
        else F.length("__text").cast(docs.schema["n_chars"].dataType).alias("n_chars")
        if c == "n_chars"
        else F.col(f"__row.`{c}`")
        for c in docs.columns
    ]
    return marked.select(*columns)
