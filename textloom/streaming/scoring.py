"""Streaming top-k scoring.

Texts arrive as files in a folder; blank texts are skipped, every other
text gets its top-k classes. The query is stateless (no watermark is
needed); the dictionary join is a stream-static broadcast join, and the
sink is a file sink with a checkpoint folder, so a restarted query
resumes exactly where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from textloom.operators.clean import drop_blank_text
from textloom.operators.metrics import TOP_K
from textloom.operators.softmax import Softmax
from textloom.plans.scoring import score_top5
from textloom.sources.corpus import ROW_ID, TEXT

INPUT_SCHEMA = f"{ROW_ID} BIGINT, {TEXT} STRING"


def scored_stream(spark: SparkSession, model: Softmax, dictionary: DataFrame, input_path: str,
                  fmt: str = "parquet", schema: str = INPUT_SCHEMA, k: int = TOP_K,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """The streaming DataFrame of ranked predictions."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.load(input_path)
    texts = drop_blank_text(src.where(F.col(TEXT).isNotNull()))
    return score_top5(model, texts, dictionary, k)


def score_stream(spark: SparkSession, model: Softmax, dictionary: DataFrame, input_path: str,
                 output_path: str, checkpoint_path: str, fmt: str = "parquet", k: int = TOP_K,
                 available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the scoring query (append mode, parquet sink)."""
    w = (scored_stream(spark, model, dictionary, input_path, fmt, k=k,
                       max_files_per_trigger=max_files_per_trigger).writeStream
         .format("parquet").outputMode("append")
         .option("path", output_path).option("checkpointLocation", checkpoint_path))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
