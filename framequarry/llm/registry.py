"""Queries of the corpus operators, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from framequarry.llm import bpe, decontam, fingerprints, near_dedup, pii, quality, secret_scan, toxicity, url_cascade, warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_url_cascade": url_cascade.op1_url_cascade,
        "op2_near_dedup": near_dedup.op2_near_dedup,
        "op3_pii": pii.op3_pii,
        "op4_toxicity": toxicity.op4_toxicity,
        "op5_fingerprints": fingerprints.op5_fingerprints,
        "op6_warc": warc.op6_warc,
        "op7_bpe": bpe.op7_bpe,
        "op8_secrets": secret_scan.op8_secrets,
        "op9_decontam": decontam.op9_decontam,
        "op10_quality": quality.op10_quality,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_url_cascade": url_cascade.OP1_SQL, "op2_near_dedup": near_dedup.OP2_SQL, "op6_warc": warc.OP6_SQL}
