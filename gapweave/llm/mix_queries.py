"""The query of the source mix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapweave.llm.mixing import Mix


def op12_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = Mix(spark.read.parquet(f"{folder}/documents.parquet"))
    return mixed.taken().select(
        F.col("id").alias("doc_id"), "size", F.col("total").alias("source_size"), "target", "taken"
    )
