"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from narrata.llm import (
    ball_tree,
    chat_format,
    collocations,
    decontaminate,
    kd_shards,
    language_id,
    license_scan,
    ngram_join,
    packing,
    piece_bpe,
    spelling,
    token_counts,
    token_files,
)

_QUERIES = [
    ngram_join.op1_ngram_join,
    license_scan.op2_license_scan,
    packing.op3_packing,
    token_counts.op4_token_counts,
    decontaminate.op5_benchmark_decontamination,
    token_files.op6_token_files,
    chat_format.op7_chat_format,
    kd_shards.op8_kd_shards,
    language_id.op9_language_id,
    ball_tree.op10_ball_tree_top_k,
    collocations.op11_collocations,
    spelling.op12_spelling_variants,
    piece_bpe.op13_piece_bpe,
]
_SQL: dict[str, str] = {
    "op5_benchmark_decontamination": decontaminate.SQL,
    "op7_chat_format": chat_format.SQL,
    "op10_ball_tree_top_k": ball_tree.SQL,
    "op11_collocations": collocations.SQL,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _QUERIES} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    own = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return _SQL | own
