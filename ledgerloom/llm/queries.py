"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import (
    alignment,
    bpe,
    divergence,
    exact_dedup,
    jaccard_join,
    line_dedup,
    packing,
    retrieval_packing,
    substring_dedup,
    token_counts,
    token_files,
    topk,
    toxicity,
)
from ledgerloom.llm.store import table

Query = Callable[[SparkSession, str], DataFrame]


def _over(name: str, operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(table(spark, sf_dir, name))


def registered() -> dict[str, Query]:
    return {
        "op1_byte_bpe": _over("documents", bpe.op1),
        "op2_topk_maxscore": _over("embeddings", topk.op2),
        "op3_ngram_jaccard_join": _over("documents", jaccard_join.op3),
        "op4_toxicity": lambda spark, sf_dir: toxicity.op4(
            table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
        ),
        "op5_exact_dedup": _over("documents", exact_dedup.op5),
        "op6_best_fit_packing": _over("documents", packing.op6),
        "op7_token_counts": _over("documents", token_counts.op7),
        "op8_line_dedup": _over("documents", line_dedup.op8),
        "op9_token_files": _over("documents", token_files.op9),
        "op10_substring_dedup": _over("documents", substring_dedup.op10),
        "op11_token_alignment": _over("documents", alignment.op11),
        "op12_retrieval_packing": _over("documents", retrieval_packing.op12),
        "op13_source_divergence": _over("documents", divergence.op13),
    }


def statements() -> dict[str, str]:
    return {
        "op2_topk_maxscore": topk.OP2_SQL,
        "op5_exact_dedup": exact_dedup.OP5_SQL,
        "op13_source_divergence": divergence.OP13_SQL,
    }
