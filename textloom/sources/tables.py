"""Inputs derived by Spark from the driver's parquet tables.

Each function reads a whole table and derives the operator input that the
corresponding oracle SQL derives the same way (see FIXTURES.md section 3).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.sources.corpus import LABEL, ROW_ID, TEXT


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def corpus_from_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-corpus: ``documents`` as a raw labelled corpus with nulls and both
    comma kinds in the multi-label string."""
    d = F.col("doc_id")
    label_raw = (
        F.when(d % 41 == 5, F.lit(None).cast("string"))
        .when(d % 3 == 0, F.concat(F.lit(" "), F.col("lang"), F.lit("，"), F.col("source")))
        .when(d % 3 == 1, F.concat(F.col("lang"), F.lit(","), F.col("source"), F.lit(" ")))
        .otherwise(F.col("lang"))
    )
    return table(spark, sf_dir, "documents").select(
        d.alias(ROW_ID),
        F.when(d % 50 == 7, F.lit(None).cast("string")).otherwise(F.col("text")).alias(TEXT),
        label_raw.alias(LABEL),
        F.col("source"),
    )


def rare_threshold(n_rows: int) -> int:
    """F-corpus threshold floor(0.12 * rows), in integers."""
    return (n_rows * 12) // 100


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as a clean corpus: text labelled by language."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias(ROW_ID), F.col("text").alias(TEXT), F.col("lang").alias(LABEL))


def logits_from_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-logits: the embedding values as logits, ``label`` as truth."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias(ROW_ID),
        F.col("embedding").cast("array<double>").alias("logits"),
        F.col("label").cast("int").alias("y_true"),
    )


def pairs_from_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-pairs: ``quality`` as truth and ``toxic`` as prediction."""
    return table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias(ROW_ID),
        F.col("quality").cast("int").alias("y_true"),
        F.col("toxic").cast("int").alias("y_pred"),
    )


def history_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-history: run = event type, epoch = day of month, score = daily mean/100."""
    return (table(spark, sf_dir, "events")
            .groupBy(F.col("event_type").alias("run"), F.dayofmonth("ts").alias("epoch"))
            .agg(F.round(F.avg("value") / 100, 6).alias("score")))
