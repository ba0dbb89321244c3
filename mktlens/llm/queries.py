"""The ``opN_`` queries: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mktlens.llm import (
    embedding_dedup,
    html_extract,
    jaccard_join,
    langid,
    line_dedup,
    lm_scoring,
    merkle,
    mixing,
    packing,
    quality_rules,
    substring_dedup,
    vector_codes,
    warc,
)
from mktlens.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def _over(name: str, op: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: op(table(spark, sf_dir, name))


QUERIES: dict[str, Query] = {
    "op1_html_extraction": _over("pages", html_extract.op1_html_extraction),
    "op3_packing": _over("documents", packing.op3_packing),
    "op2_language_id": _over("documents", langid.op2_language_id),
    "op4_jaccard_join": _over("documents", jaccard_join.op4_jaccard_join),
    "op5_quality_rules": _over("documents", quality_rules.op5_quality_rules),
    "op6_substring_dedup": _over("documents", substring_dedup.op6_substring_dedup),
    "op7_mixing": _over("documents", mixing.op7_mixing),
    "op8_line_dedup": _over("documents", line_dedup.op8_line_dedup),
    "op9_embedding_dedup": _over("embeddings", embedding_dedup.op9_embedding_dedup),
    "op10_warc_derivatives": _over("pages", warc.op10_warc_derivatives),
    "op11_merkle_manifest": _over("documents", merkle.op11_merkle_manifest),
    "op12_lm_scoring": _over("documents", lm_scoring.op12_lm_scoring),
    "op13_vector_codes": _over("embeddings", vector_codes.op13_vector_codes),
}

SQL: dict[str, str] = {
    "op4_jaccard_join": jaccard_join.OP4_SQL,
    "op5_quality_rules": quality_rules.OP5_SQL,
    "op6_substring_dedup": substring_dedup.OP6_SQL,
    "op8_line_dedup": line_dedup.OP8_SQL,
    "op9_embedding_dedup": embedding_dedup.OP9_SQL,
    "op11_merkle_manifest": merkle.OP11_SQL,
    "op13_vector_codes": vector_codes.OP13_SQL,
}
