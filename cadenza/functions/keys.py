"""Column helpers for epoch times, exact decimals and hashed keys."""

from pyspark.sql import Column, functions as F

# Fixed value: the marker that keeps NULL apart from '' in hashed keys.
NULL_MARKER = "_dbt_utils_surrogate_key_null_"


def from_epoch_ms(value: Column) -> Column:
    return F.timestamp_millis(value.cast("bigint"))


def exact(value: Column) -> Column:
    """A measured float as DECIMAL(18,3), rounded half up."""
    return value.cast("decimal(18,3)")


def surrogate_key(*columns: str | Column) -> Column:
    """md5 over the text of the fields joined by '-'."""
    texts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_MARKER))
        for c in columns
    ]
    return F.md5(F.concat_ws("-", *texts))
