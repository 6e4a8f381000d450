"""A corpus pipeline over the documents table: five stages, each written as Parquet and read again.

Toxic documents go; of each group of near duplicates one document stays; documents that hold a
benchmark item go; secrets in the rest are replaced by their kind; what is left is encoded. All
stages but the last return the columns of ``documents``; the last returns doc_id, ids and the text
that the ids decode to. SQL can express neither the first stage (a trained model) nor the last, so
there is no SQL for the whole; tests compare it with a plain version.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from cadenza.llm import decontamination, jaccard, pieces, secrets, toxicity  # noqa: E402
from cadenza.llm.common import stored, table  # noqa: E402

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity.stage),
    ("near duplicates", jaccard.stage),
    ("decontamination", decontamination.stage),
    ("secrets", secrets.stage),
    ("pieces", pieces.stage),
]
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
