"""Benchmark items in documents, also re-parameterised ones, by template windows (operator 3).

Only DataFrame functions are used.

1. Words lose their outer punctuation and case; numbers, names and units (behind a number) become
   typed placeholders. A name is a word that the items have as one (capitalised in the middle of a
   sentence, or at its start and nowhere in lower case), in whatever case, or a capitalised word that
   no item holds. So a word's type depends on no case or punctuation around it. The words of a text
   and of its template stay aligned. The words of the items come to the driver.
2. Windows of ``WINDOW`` words (a shorter item is one window) meet by hash in an equi-join: the plain
   words, and the template if it has a placeholder and ``LEAST_PLAIN`` different plain words (of a
   shorter window, the same share): placeholders alone, as in lists of numbers or names, say nothing.
   Items go to all tasks if their windows are few (counted first), else both sides are shuffled.
   Only documents that hold a seed are cut into windows: the seed of an item's window is its longest
   pair of adjacent plain words. A match needs several windows, so an item's weakest windows, one
   fewer than that, need no seed; if another one has none, all documents are cut.
3. Matches of one document and item on one diagonal (document position minus item position) belong
   together. They count if they cover ``COVERED`` windows, or all windows of the item.
4. Slots: windows that are equal word for word count by themselves. Where templates are needed to
   cover the item, the words behind the placeholders of a diagonal must map one to one, each value of
   the item to one value in the document and back. A document with other values but consistent slots
   is a re-parameterised copy; with inconsistent slots only the equal windows count.

Result: doc_id, item_id, n_matched, n_windows (of the item), reparameterised, one row for each
document and item that match. Cases: missing and empty texts and items match nothing; an item
shorter than ``SHORTEST`` words is skipped, it says too little; repeated rows of a document are one
(equal id and text), rows with one id and different texts are matched apart and reported once;
repeated items are reported each; missing ids stay missing; empty tables give no rows; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.llm.common import stored, table

WINDOW = 8
SHORTEST = 5
#: Windows on one diagonal: with eight words each, thirteen words in a row.
COVERED = 6
#: Different plain words that a template of WINDOW words must hold.
LEAST_PLAIN = 3
#: Windows of the items are sent to all tasks up to this many, of about 30 bytes each.
MOST_BROADCAST = 1_000_000

NUMBER = r"^[0-9][0-9.,:/]*$"
# Fixed word list: units of measure and money.
UNITS = (
    "mm cm m km mi ft in inch inches mile miles metre metres meter meters g kg mg lb lbs oz t ton tons "
    "tonne tonnes l ml litre litres liter liters s sec min minute minutes h hr hour hours day days week "
    "weeks month months year years percent usd eur gbp dollar dollars euro euros cent cents "
    "pound pounds kmh mph hz khz mhz ghz w kw mw j kj v a k c f degrees kb mb gb tb"
).split()
_OUTER = r"^[\p{P}\p{S}]+|[\p{P}\p{S}]+$"
_BETWEEN = r"[^\p{L}\p{N}]+"
#: A capitalised word behind a word of the same sentence, and any.
_NAME = r"(?<=[\p{Ll}\p{N},;:][\x20\x09-\x0D])(\p{Lu}\p{Ll}+[^\x20\x09-\x0D]*)"
_CAPITAL = r"^\p{Lu}\p{Ll}"


def _words(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _stripped(words: Column) -> Column:
    plain = F.transform(words, lambda w: F.regexp_replace(w, F.lit(_OUTER), F.lit("")))
    return F.filter(plain, lambda w: w != "")


def vocabulary(items: DataFrame) -> tuple[list[str], list[str]]:
    """The names, and all other words, of the items (lower case)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    inside = items.select(
        F.explode(_stripped(F.regexp_extract_all(text, F.lit(_NAME), F.lit(1)))).alias("w")
    ).select(F.lower("w").alias("word"), F.lit(True).alias("inside"), F.lit(False).alias("small"))
    words = items.select(F.explode(_stripped(_words(text))).alias("w")).select(
        F.lower("w").alias("word"), F.lit(False), ~F.col("w").rlike(_CAPITAL)
    )
    found = (
        inside.union(words)
        .groupBy("word")
        .agg((F.bool_or("inside") | ~F.bool_or("small")).alias("name"))
        .collect()
    )
    return [r["word"] for r in found if r["name"]], [r["word"] for r in found if not r["name"]]


def templates(rows: DataFrame, key: list[str], names: list[str], others: list[str]) -> DataFrame:
    """key, words (plain, lower case) and types (0 word, 1 number, 2 name, 3 unit) of each text.
    names, others: the vocabulary of the items."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    plain = _stripped(_words(text))
    units = F.array(*map(F.lit, UNITS))

    def kind(word: Column, i: Column) -> Column:
        digit = F.substring(word, 1, 1).between("0", "9")
        before = F.get(F.col("words"), i - 1)
        return (
            F.when(digit & word.rlike(NUMBER), 1)
            .when(word.isin(names), 2)
            .when(
                (i > 0)
                & F.substring(before, -1, 1).between("0", "9")
                & before.rlike(NUMBER)
                & F.array_contains(units, word),
                3,
            )
            .when(F.get(F.col("raw"), i).rlike(r"^\p{Lu}") & ~word.isin(others), 2)
            .otherwise(0)
        )

    lower = F.transform("raw", F.lower)
    return (
        rows.select(*key, plain.alias("raw"))
        .select(*key, "raw", lower.alias("words"))
        .select(*key, "words", F.transform("words", kind).alias("types"))
    )


def _rows(i: Column, width: Column, typed: Column) -> Column:
    """at, hash, slots of the window at i: its plain words, and its template if it has a placeholder."""
    some = F.slice("types", i + 1, width)
    slots = F.zip_with(
        F.slice("words", i + 1, width),
        some,
        lambda w, t: F.when(t > 0, F.concat_ws(":", t.cast("string"), w)),
    )
    place = i.alias("at")
    plain = F.struct(
        place,
        F.xxhash64(F.slice("plain", i + 1, width)).alias("hash"),
        F.lit(None).cast("array<string>").alias("slots"),
    )
    template = F.struct(
        place, F.xxhash64(F.slice("codes", i + 1, width)).alias("hash"), slots.alias("slots")
    )
    said = F.zip_with(F.slice("words", i + 1, width), some, lambda w, t: F.when(t == 0, w))
    told = F.size(F.array_distinct(F.filter(said, lambda w: w.isNotNull())))
    good = F.exists(some, lambda t: t > 0) & (told * WINDOW >= LEAST_PLAIN * width)
    return F.when(typed & good, F.array(plain, template)).otherwise(F.array(plain))


def windows(found: DataFrame, key: list[str], short: bool) -> DataFrame:
    """key, at, hash, n (words of the window), slots (types and words behind placeholders; null in
    the row of the plain words, which each window has). With ``short``, a text of fewer than WINDOW words is one window."""
    coded = F.zip_with(
        "words", "types", lambda w, t: F.when(t == 0, F.xxhash64(w)).otherwise(t.cast("long"))
    )
    found = found.select(
        *key, "words", "types", coded.alias("codes"), F.transform("words", lambda w: F.xxhash64(w)).alias("plain"),
        F.exists("types", lambda t: t > 0).alias("typed"), F.size("words").alias("size"),
    )
    last = F.col("size") - WINDOW
    least = SHORTEST if short else WINDOW
    width = F.least(F.col("size"), F.lit(WINDOW)) if short else F.lit(WINDOW)
    places = F.sequence(F.lit(0), F.greatest(last, F.lit(0)))

    def window(i: Column) -> Column:
        return _rows(i, width, F.col("typed"))

    return found.where(F.col("size") >= least).select(
        *key, width.alias("n"), F.explode(F.flatten(F.transform(places, window))).alias("w")
    ).select(*key, "n", "w.at", "w.hash", "w.slots")


def seeds(items: DataFrame) -> DataFrame:
    """x, y: two words (lower case, letters and digits) that follow each other in any match of an
    item; null for an item that cannot tell. items: item, words, types."""
    width = F.least(F.size("words"), F.lit(WINDOW))
    places = F.sequence(F.lit(0), F.greatest(F.size("words") - WINDOW, F.lit(0)))

    def pair(i: Column) -> Column:
        x = F.element_at(F.split(F.col("words")[i], _BETWEEN), -1)
        y = F.element_at(F.split(F.col("words")[i + 1], _BETWEEN), 1)
        good = (F.col("types")[i] == 0) & (F.col("types")[i + 1] == 0) & (x != "") & (y != "")
        length = F.when(good, F.length(x) + F.length(y)).otherwise(0)
        return F.struct(length.alias("length"), x.alias("x"), y.alias("y"))

    def best(i: Column) -> Column:
        return F.array_max(F.transform(F.sequence(i, i + width - 2), pair))

    found = items.where(F.size("words") >= SHORTEST).select(
        "item",
        F.least(F.lit(COVERED), F.size(places)).alias("need"),
        F.explode(F.transform(places, best)).alias("seed"),
    )
    order = Window.partitionBy("item").orderBy("seed.length", "seed.x", "seed.y")
    told = F.col("seed.length") > 0
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where("rank >= need")
        .select(F.when(told, F.col("seed.x")).alias("x"), F.when(told, F.col("seed.y")).alias("y"))
        .distinct()
    )


def _seeded(keyed: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that hold a seed."""
    found = stored(seeds(items), "seeds")
    if found.where("x is null").limit(1).count():
        return keyed
    few = found.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST
    parts = F.split(F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))), _BETWEEN)
    size = F.greatest(F.size("parts") - 1, F.lit(0))
    pairs = F.arrays_zip(
        F.slice("parts", F.lit(1), size).alias("x"), F.slice("parts", F.lit(2), size).alias("y")
    )
    holders = stored(
        keyed.select("doc_id", "text_hash", parts.alias("parts"))
        .select("doc_id", "text_hash", F.inline(pairs))
        .join(F.broadcast(found) if few else found, ["x", "y"], "left_semi")
        .select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
        .distinct(),
        "holders",
    )
    few = holders.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST
    on = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    return keyed.join(F.broadcast(holders) if few else holders, on, "left_semi")


def matched(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, text_hash, item_id, n_matched, n_windows, reparameterised."""
    keyed = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text_hash"),
        "text",
    )
    numbered = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"),
        F.monotonically_increasing_id().alias("item"),
        "text",
    )
    names, others = vocabulary(benchmark)
    plain = stored(templates(numbered, ["item_id", "item"], names, others), "templates")
    items = stored(windows(plain, ["item_id", "item"], short=True), "items")
    keyed = _seeded(keyed, plain)
    totals = items.groupBy("item").agg(F.countDistinct("at").alias("n_windows"))
    few = items.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST
    right = items.select(
        "item_id", "item", F.col("n").alias("item_n"), F.col("at").alias("item_at"), "hash",
        F.col("slots").alias("item_slots"),
    )
    shapes = [r["n"] for r in items.select("n").distinct().collect()]  # at most WINDOW sizes
    texts = stored(templates(keyed, ["doc_id", "text_hash"], names, others), "texts")
    left = windows(texts, ["doc_id", "text_hash"], short=False)
    for n in sorted(set(shapes) - {WINDOW}):
        left = left.unionByName(_sized(texts, n))
    hits = left.join(F.broadcast(right) if few else right, "hash").where("n = item_n")
    hits = stored(
        hits.select(
            "doc_id", "text_hash", "item_id", "item", "item_at", (F.col("at") - F.col("item_at")).alias("diagonal"),
            "slots", "item_slots",
        ).distinct(),
        "hits",
    )
    group = ["doc_id", "text_hash", "item_id", "item", "diagonal"]
    # The rows of plain words have no slots.
    counted = hits.groupBy(*group).agg(
        F.countDistinct("item_at").alias("n_all"),
        F.countDistinct(F.when(F.col("slots").isNull(), F.col("item_at"))).alias("n_equal"),
    )
    values = (
        hits.where("slots is not null")
        .select(*group, F.explode(F.arrays_zip("slots", "item_slots")).alias("v"))
        .select(*group, F.col("v.slots").alias("ours"), F.col("v.item_slots").alias("theirs"))
        .where("ours is not null")
        .distinct()
    )
    # One to one: as many pairs as values, on either side.
    slots = values.groupBy(*group).agg(
        (
            (F.countDistinct("ours") == F.count("*")) & (F.countDistinct("theirs") == F.count("*"))
        ).alias("consistent"),
        F.bool_or(F.col("ours") != F.col("theirs")).alias("changed"),
    )
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in group]
    slots = slots.withColumnsRenamed({c: f"_{c}" for c in group})
    return (
        counted.join(totals, "item")
        .join(slots, on, "left")
        .withColumn("consistent", F.coalesce("consistent", F.lit(True)))
        .withColumn("n_matched", F.when(F.col("consistent"), F.col("n_all")).otherwise(F.col("n_equal")))
        .withColumn("changed", F.col("consistent") & F.coalesce("changed", F.lit(False)))
        .where(F.col("n_matched") >= F.least(F.lit(COVERED), F.col("n_windows")))
        .groupBy("doc_id", "text_hash", "item_id", "item")
        .agg(
            F.max("n_matched").alias("n_matched"),
            F.first("n_windows").alias("n_windows"),
            F.min("changed").alias("reparameterised"),
        )
    )


def _sized(texts: DataFrame, n: int) -> DataFrame:
    """All windows of n words, fewer than WINDOW, to meet an item of that length."""
    codes = F.zip_with(
        "words", "types", lambda w, t: F.when(t == 0, F.xxhash64(w)).otherwise(t.cast("long"))
    )
    texts = texts.where(F.size("words") >= n).select(
        "*", codes.alias("codes"), F.transform("words", lambda w: F.xxhash64(w)).alias("plain")
    )
    places = F.sequence(F.lit(0), F.size("words") - n)
    rows = F.flatten(F.transform(places, lambda i: _rows(i, F.lit(n), F.lit(True))))
    return texts.select("doc_id", "text_hash", F.lit(n).alias("n"), F.explode(rows).alias("w")).select(
        "doc_id", "text_hash", "n", "w.at", "w.hash", "w.slots"
    )


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, by item."""
    found = matched(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.groupBy("doc_id", "item_id").agg(
        F.max("n_matched").alias("n_matched"),
        F.max("n_windows").alias("n_windows"),
        F.min("reparameterised").alias("reparameterised"),
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Third stage of the pipeline: rows of documents that hold no benchmark item."""
    bad = stored(
        matched(docs, table(spark, sf_dir, "benchmark"))
        .select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
        .distinct(),
        "contaminated",
    )
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    on = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__hash"))
    return docs.join(bad, on, "left_anti")
