"""The named queries of this subpackage and, where SQL can say the same, their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sensorflow.llm import codes, contamination, language, lines, mixing, near, packing, repair, rules, substring, tokens, twins, urls, wrappers

Query = Callable[[SparkSession, str], DataFrame]

QUERIES = (
    tokens.op1_token_output,
    substring.op2_substring_dedup,
    mixing.op3_source_mixing,
    urls.op4_url_filter,
    rules.op5_quality_rules,
    near.op6_near_dedup,
    contamination.op7_decontamination,
    wrappers.op8_html_extraction,
    lines.op9_line_dedup,
    language.op10_lm_scoring,
    packing.op11_best_fit_packing,
    repair.op12_conversation_repair,
    codes.op13_vector_codes,
)


def queries() -> dict[str, Query]:
    return {query.__name__: query for query in QUERIES}


def oracle_sql() -> dict[str, str]:
    return twins.oracle_sql()
