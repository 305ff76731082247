"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from saleswright.llm import (
    conversation_trie,
    decontaminate,
    exact_dedup,
    hard_negatives,
    langid,
    line_dedup,
    lm,
    quality,
    repeats,
    simhash,
    token_counts,
    token_files,
    unigram,
)
from saleswright.llm.common import ship

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {
    "op1_token_files": token_files.op1_token_files,
    "op2_decontaminate": decontaminate.op2_decontaminate,
    "op3_sentencepiece": unigram.op3_sentencepiece,
    "op4_repeats": repeats.op4_repeats,
    "op5_exact_dedup": exact_dedup.op5_exact_dedup,
    "op6_langid": langid.op6_langid,
    "op7_quality": quality.op7_quality,
    "op8_token_counts": token_counts.op8_token_counts,
    "op9_lm": lm.op9_lm,
    "op10_simhash": simhash.op10_simhash,
    "op11_prefix_trie": conversation_trie.op11_prefix_trie,
    "op12_line_dedup": line_dedup.op12_line_dedup,
    "op13_hard_negatives": hard_negatives.op13_hard_negatives,
}


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


def all_queries() -> dict[str, Query]:
    """Queries by name."""
    return {name: _shipped(query) for name, query in _QUERIES.items()}


def oracle_queries() -> dict[str, str]:
    """SQL for the queries that SQL can express."""
    return {
        "op2_decontaminate": decontaminate.ORACLE_SQL,
        "op5_exact_dedup": exact_dedup.ORACLE_SQL,
        "op11_prefix_trie": conversation_trie.ORACLE_SQL,
        "op12_line_dedup": line_dedup.ORACLE_SQL,
        "op13_hard_negatives": hard_negatives.ORACLE_SQL,
    }
