"""Batch top-k scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.operators.metrics import TOP_K, topk_classes
from textloom.operators.softmax import Softmax
from textloom.plans.training import score_rows
from textloom.sources.corpus import ROW_ID


def score_top5(model: Softmax, df: DataFrame, dictionary: DataFrame, k: int = TOP_K,
               keep=(ROW_ID,)) -> DataFrame:
    """``rank, code, class, probability, percentage`` for the top
    ``min(k, n_classes)`` classes of every row (one output row per rank)."""
    return topk_classes(score_rows(model, df), "probs", k, dictionary, keep)


def score_texts(spark, model_dir: str, input_path: str, output_path: str, fmt: str = "parquet",
                text_col: str = "summary", row_id_col: str | None = None, k: int = TOP_K) -> str:
    """M10 end to end: load a saved model folder (S11) and write the top-k
    classes of every non-blank text of ``input_path`` as parquet."""
    from textloom.operators.clean import drop_blank_text
    from textloom.plans.training import load_model
    from textloom.sources.corpus import TEXT
    from textloom.sources.positions import with_positions

    model, dictionary = load_model(spark, model_dir)
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("multiLine", True).option("escape", '"')
    df = reader.load(input_path)
    if row_id_col is None:
        df, row_id_col = with_positions(df, "_row_id", fmt == "parquet"), "_row_id"
    texts = drop_blank_text(df.select(F.col(row_id_col).cast("bigint").alias(ROW_ID), F.col(text_col).alias(TEXT)))
    score_top5(model, texts, dictionary, k).write.mode("overwrite").parquet(output_path)
    return output_path
