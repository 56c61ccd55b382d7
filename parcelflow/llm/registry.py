"""Queries of the text operators and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from parcelflow.llm import (
    decontamination,
    filter_audit,
    fingerprints,
    near_dup,
    packing,
    pii,
    quality_model,
    quality_rules,
    repeats,
    token_counts,
    url_filter,
    warc,
    whitening,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "op1_warc": warc.op1_warc,
    "op2_best_fit_packing": packing.op2_best_fit_packing,
    "op3_decontamination": decontamination.op3_decontamination,
    "op4_near_dup": near_dup.op4_near_dup,
    "op5_url_filter": url_filter.op5_url_filter,
    "op6_quality_model": quality_model.op6_quality_model,
    "op7_pii": pii.op7_pii,
    "op8_quality_rules": quality_rules.op8_quality_rules,
    "op9_repeats": repeats.op9_repeats,
    "op10_token_counts": token_counts.op10_token_counts,
    "op11_fingerprints": fingerprints.op11_fingerprints,
    "op12_filter_audit": filter_audit.op12_filter_audit,
    "op13_whitening": whitening.op13_whitening,
}

# Queries without an entry are beyond SQL or too slow there; tests/llm holds them against brute force.
ORACLES: dict[str, str] = {"op1_warc": warc.OP1_SQL, "op5_url_filter": url_filter.OP5_SQL, "op12_filter_audit": filter_audit.OP12_SQL}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
