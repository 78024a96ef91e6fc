"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from basalt.llm import ann, jaccard_join, line_dedup, merge_dropout, packing, quality_rules, secret_scan, token_counts, toxicity, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_warc": warc.op2_warc,
    "op3_merge_dropout": merge_dropout.op3_merge_dropout,
    "op4_line_dedup": line_dedup.op4_line_dedup,
    "op5_secret_scan": secret_scan.op5_secret_scan,
    "op6_best_fit": packing.op6_best_fit,
    "op7_nearest": ann.op7_nearest,
    "op8_token_counts": token_counts.op8_token_counts,
    "op9_jaccard_join": jaccard_join.op9_jaccard_join,
    "op10_quality_rules": quality_rules.op10_quality_rules,
}

SQL: dict[str, str] = {
    "op2_warc": warc.OP2_SQL,
    "op4_line_dedup": line_dedup.OP4_SQL,
    "op9_jaccard_join": jaccard_join.OP9_SQL,
    "op10_quality_rules": quality_rules.OP10_SQL,
}
