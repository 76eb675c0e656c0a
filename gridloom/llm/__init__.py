"""Operators of a training-data pipeline. Nothing outside this subpackage imports it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from gridloom.llm import collocations, divergence, exact_dedup, line_dedup, mixing, packing, pii, quality, secrets, sharding, simhash, topk, toxicity

    found = [mixing.op1_mix_sources, pii.op2_pii, packing.op3_pack, topk.op4_topk, sharding.op5_shard, toxicity.op6_toxicity, quality.op7_quality, line_dedup.op8_line_dedup, exact_dedup.op9_exact_dedup, simhash.op10_simhash, collocations.op11_collocations, divergence.op12_divergence, secrets.op13_secrets]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    from gridloom.llm import collocations, divergence, exact_dedup, line_dedup, mixing, topk

    return {"op1_mix_sources": mixing.ORACLE_SQL, "op4_topk": topk.ORACLE_SQL, "op8_line_dedup": line_dedup.ORACLE_SQL, "op9_exact_dedup": exact_dedup.ORACLE_SQL, "op11_collocations": collocations.ORACLE_SQL, "op12_divergence": divergence.ORACLE_SQL}
