"""Registered queries of the operators, and the DuckDB counterparts of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cadenza.llm import (
    byte_pairs, collocations, decontamination, jaccard, lexical, lm, pieces, quality, repeats,
    secrets, token_files, topk, toxicity,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm": lm.op1,
    "op2_jaccard": jaccard.op2,
    "op3_decontamination": decontamination.op3,
    "op4_toxicity": toxicity.op4,
    "op5_repeats": repeats.op5,
    "op8_secrets": secrets.op8,
    "op9_pieces": pieces.op9,
    "op6_topk": topk.op6,
    "op7_token_files": token_files.op7,
    "op10_quality": quality.op10,
    "op11_collocations": collocations.op11,
    "op12_lexical": lexical.op12,
    "op13_byte_pairs": byte_pairs.op13,
}

ORACLE_SQL: dict[str, str] = {
    "op2_jaccard": jaccard.ORACLE,
    "op5_repeats": repeats.ORACLE,
    "op6_topk": topk.ORACLE,
    "op11_collocations": collocations.ORACLE,
    "op12_lexical": lexical.ORACLE,
}
