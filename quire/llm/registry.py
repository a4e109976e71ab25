"""Queries of this package and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat, decontam, exact_dedup, mixing, near_dedup, pii, quality, suffix_lm, toxicity, warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_decontaminate": decontam.op1_decontaminate,
        "op2_toxicity": toxicity.op2_toxicity,
        "op3_quality_rules": quality.op3_quality_rules,
        "op4_pareto_mix": mixing.op4_pareto_mix,
        "op5_warc_revisits": warc.op5_warc_revisits,
        "op6_suffix_dedup": exact_dedup.op6_suffix_dedup,
        "op7_signature_tree_join": near_dedup.op7_signature_tree_join,
        "op8_suffix_tree_lm": suffix_lm.op8_suffix_tree_lm,
        "op9_chat_format": chat.op9_chat_format,
        "op10_pii": pii.op10_pii,
        "quality_base": quality.quality_base,
        "lm_base": suffix_lm.lm_base,
        "pii_base": pii.pii_base,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_decontaminate": decontam.OP1_SQL, "op4_pareto_mix": mixing.OP4_SQL, "op5_warc_revisits": warc.OP5_SQL, "op6_suffix_dedup": exact_dedup.OP6_SQL, "op7_signature_tree_join": near_dedup.OP7_SQL, "op9_chat_format": chat.OP9_SQL, "quality_base": quality.BASE_SQL, "lm_base": suffix_lm.BASE_SQL, "pii_base": pii.BASE_SQL}
