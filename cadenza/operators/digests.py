"""Order-free fingerprints of sets of rows.

A row has two 64-bit hashes over all its values and over which of them are missing; a group of rows
has their number, the sum of one hash and the exclusive or of the other. Equal multisets of rows have
equal fingerprints, in whatever order and layout; two different ones share theirs with a chance of
about 2^-128. Fingerprints are merged map-side, so groups move, not rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

BUCKETS = 4096
BUCKET = "_bucket"
PRINT = ["_rows", "_sum", "_xor"]


def row_hash(columns: Sequence[str], seed: str = "") -> Column:
    """A missing value leaves the hash as it is, so which are missing is a value of its own."""
    names = [f"`{c.replace('`', '``')}`" for c in columns]
    missing = ", ".join(f"{n} IS NULL" for n in names)
    return F.expr(f"xxhash64('{seed}', array({missing}), {', '.join(names)})")


def fingerprints(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """One row for each group: its number of rows, sum and exclusive or."""
    total = F.sum(row_hash(columns).cast("decimal(20,0)"))
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_rows"),
        total.alias("_sum"),
        F.bit_xor(row_hash(columns, "second")).alias("_xor"),
    )


def in_buckets(df: DataFrame, columns: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(row_hash(columns, "bucket"), F.lit(buckets)).cast("int"))


def compared(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Groups of both sides with their numbers of rows (0 if absent) and whether they are equal."""
    sides = left.select(*by, *PRINT, F.lit(1).alias("_side")).unionByName(
        right.select(*by, *PRINT, F.lit(2).alias("_side"))
    )

    def of(side: int, name: str) -> Column:
        return F.max(F.when(F.col("_side") == side, F.col(name)))

    both = sides.groupBy(*by).agg(
        *[of(n, name).alias(f"{name}_{n}") for n in (1, 2) for name in PRINT]
    )
    same = F.lit(True)
    for name in PRINT:
        same = same & F.col(f"{name}_1").eqNullSafe(F.col(f"{name}_2"))
    return both.select(
        *by,
        F.coalesce("_rows_1", F.lit(0)).alias("left_rows"),
        F.coalesce("_rows_2", F.lit(0)).alias("right_rows"),
        same.alias("equal"),
    )
