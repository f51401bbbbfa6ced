"""From raw documents to a mixed training corpus: five stages, each written as Parquet and read again by the next.

    quality rules -> near duplicates -> benchmark decontamination -> personal data -> mixing

All but the last stage return the columns of ``documents``; the last adds the slot and the place of every document in the mixture.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sensorlake.llm.decontamination import stage_decontaminate
from sensorlake.llm.mixing import stage_mix
from sensorlake.llm.near_duplicates import stage_near_duplicates
from sensorlake.llm.personal import stage_personal
from sensorlake.llm.quality import stage_quality
from sensorlake.llm.shared import Scratch

STAGES = [
    ("quality_rules", stage_quality),
    ("near_duplicates", stage_near_duplicates),
    ("decontamination", stage_decontaminate),
    ("personal_data", stage_personal),
    ("mixing", stage_mix),
]

# Learned rules and hashed signatures are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark)
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), f"stage-{name}", docs)
    return docs
