"""Five-stage corpus pipeline; each stage reads, as Parquet, what the one before it kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.common import bounded, discard, shared_dir, small_batches, table
from quern.llm.decontamination import decontaminate
from quern.llm.line_dedup import dedup_lines
from quern.llm.mixing import mix
from quern.llm.near_dedup import near_duplicates
from quern.llm.quality import drop_rejected


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    small_batches(spark)
    return drop_rejected(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of lines go from the texts, and documents with them of which no text is left; n_chars follows."""
    kept = dedup_lines(docs).filter((F.col("n_dropped") == 0) | F.col("text").rlike(r"\S"))
    n_chars = F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return kept.withColumn("n_chars", n_chars).select(docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, similarity 0.8) the document with the smallest id stays."""
    small_batches(spark)
    gone = near_duplicates(docs).filter("NOT kept").select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__text")).distinct()
    return docs.join(bounded(gone), (docs.doc_id == F.col("__id")) & F.xxhash64(docs.text).eqNullSafe(F.col("__text")), "left_anti")


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    small_batches(spark)
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many copies of each document the mix takes, and how many words."""
    return mix(docs)


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("near_dedup", near), ("decontamination", benchmark), ("mixing", mixing)]

#: Suffix arrays, MinHash components and the cube method have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each result is written to the shared folder and read again, the last but one deleted."""
    folder, docs, before = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}", table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        made = stage(spark, docs, sf_dir)
        made.write.option("compression", "zstd").parquet(f"{folder}/{name}")
        docs = spark.read.schema(made.schema).parquet(f"{folder}/{name}")
        if before:
            discard(spark, before)
        before = f"{folder}/{name}"
    return docs
