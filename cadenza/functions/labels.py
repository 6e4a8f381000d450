"""Text clean-up for dashboard labels."""

from pyspark.sql import Column, functions as F

UNKNOWN = "Unknown"


def label(text: Column) -> Column:
    """Trimmed text; blank or missing becomes Unknown."""
    return F.coalesce(F.nullif(F.trim(text), F.lit("")), F.lit(UNKNOWN))
