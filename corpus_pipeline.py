"""From raw documents to packed training sequences: five stages over the whole corpus.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes as Parquet to
the shared folder and reads again as the next stage's documents. All but the last keep the columns
of ``docs``. Nothing here is sampled or capped but the labelled rows that the quality rules learn from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapweave.llm.decontamination import few, without_contaminated
from gapweave.llm.line_dedup import dedup_lines
from gapweave.llm.ngram_join import near_duplicates
from gapweave.llm.quality_rules import keep_good, learn_rules
from gapweave.llm.queries import packed_documents, table
from gapweave.llm.shared import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the decision list learned from ``labels`` keep."""
    return keep_good(docs, learn_rules(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many documents share, but for one; n_chars follows the text."""
    cleaned = dedup_lines(docs).select(*[F.col(f"`{c}`") for c in docs.columns])
    return cleaned.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cleaned


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates, the document with the smallest id."""
    first = near_duplicates(docs).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    stays = written(first.select(F.col("doc_id").alias("_stays")).distinct(), "stays")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    kept = rows.join(few(stays), F.col("_row.doc_id").eqNullSafe(F.col("_stays")), "left_semi")
    return kept.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 4096 ids."""
    return packed_documents(docs)


STAGES = [
    ("quality rules", quality),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicate),
    ("benchmark decontamination", decontaminate),
    ("best-fit packing", pack),
]

#: the vocabulary's ids can't be had from SQL; tests compare the stages with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs, "stage")
    return docs
