"""Corpus pipeline: quality rules, near-dedup, decontamination, mixing, token ids.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor
kept, and returns a DataFrame that is written as Parquet and reread as the
next one's docs.  All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tandem.llm.common import load, stored
from tandem.llm.decontaminate import stage_decontaminate
from tandem.llm.mixing import stage_mix
from tandem.llm.neardup import stage_near_dedup
from tandem.llm.quality import stage_quality
from tandem.llm.token_ids import stage_token_ids

STAGES = [
    ("quality_rules", stage_quality),
    ("minhash_near_dedup", stage_near_dedup),
    ("benchmark_decontamination", stage_decontaminate),
    ("source_mixing", stage_mix),
    ("token_ids_orc", stage_token_ids),
]

# The stages use a trained model, hashing and random rounding: no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
