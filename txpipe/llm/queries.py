"""Queries of this subpackage by name, and DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from txpipe.llm import attention_lm, collocations, decontam, packing, quality, secrets, simhash, suffixes, topk, toxicity, warc, whitening, winnowing

_QUERIES: list[tuple[Callable[[SparkSession, str], DataFrame], str | None]] = [
    (secrets.op1_secret_scan, secrets.ORACLE_SQL),
    (quality.op2_quality_positive_unlabelled, None),
    (decontam.op3_benchmark_decontamination, decontam.ORACLE_SQL),
    (warc.op4_warc_gzip_normaliser, warc.ORACLE_SQL),
    (packing.op5_sum_of_squares_packing, None),
    (suffixes.op6_front_coded_suffix_sort, None),
    (toxicity.op7_toxicity_string_kernel, None),
    (attention_lm.op8_attention_lm_scoring, None),
    (simhash.op9_simhash_vantage_points, None),
    (topk.op10_block_at_a_time_topk, topk.ORACLE_SQL),
    (winnowing.op11_winnowing_fingerprints, winnowing.ORACLE_SQL),
    (collocations.op12_quotient_filter_collocations, collocations.ORACLE_SQL),
    (whitening.op13_spectrum_slicing_whitening, None),
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f, _ in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {f.__name__: sql for f, sql in _QUERIES if sql}
