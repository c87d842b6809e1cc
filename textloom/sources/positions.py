"""Rows of files numbered by their place in the file.

A number depends on the files alone: not on how Spark splits them, how many tasks
read them or where a split starts. Files are ranked by path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.session import small_table

FILE_BITS = 40        # rows of a file; 2^23 files are left


def _ranked(files: DataFrame) -> DataFrame:
    """``_at_file, _at_rank`` of distinct paths: a row a file."""
    return files.select("_at_file", (F.row_number().over(Window.orderBy("_at_file")) - 1).cast("bigint").alias("_at_rank"))


def with_positions(df: DataFrame, name: str, indexed: bool = False) -> DataFrame:
    """``df``, a scan of files, with ``name``: rank of the file << 40 | row in it.

    ``indexed``: the format knows a row's index (Parquet). Otherwise rows
    are counted: Spark numbers the rows of each split in order, one narrow scan
    counts the splits (a small table: a row a split), and a row's place is its
    split's offset in the file plus its place in the split. Both scans cut the
    files alike, as the session does not change in between. Columns of ``df``
    that start with ``_at_`` are not for it.
    """
    tagged = df.withColumn("_at_file", F.col("_metadata.file_path"))
    if indexed:
        ranks = small_table(_ranked(tagged.select("_at_file").distinct()), "files")
        return (tagged.withColumn("_at_row", F.col("_metadata.row_index")).join(ranks, "_at_file")
                .withColumn(name, F.shiftleft("_at_rank", FILE_BITS).bitwiseOR(F.col("_at_row"))).drop("_at_file", "_at_rank", "_at_row"))
    tagged = tagged.withColumn("_at_split", F.col("_metadata.file_block_start")).withColumn("_at_seq", F.monotonically_increasing_id())
    splits = tagged.groupBy("_at_file", "_at_split").agg(F.min("_at_seq").alias("_at_first"), F.count("*").alias("_at_n"))
    before = Window.partitionBy("_at_file").orderBy("_at_split").rowsBetween(Window.unboundedPreceding, -1)
    splits = small_table(splits.select("_at_file", "_at_split", "_at_first", F.coalesce(F.sum("_at_n").over(before), F.lit(0)).alias("_at_before")), "splits")
    splits = splits.join(_ranked(splits.select("_at_file").distinct()), "_at_file")
    place = F.col("_at_before") + F.col("_at_seq") - F.col("_at_first")
    return (tagged.join(splits, ["_at_file", "_at_split"]).withColumn(name, F.shiftleft("_at_rank", FILE_BITS).bitwiseOR(place))
            .drop("_at_file", "_at_split", "_at_seq", "_at_first", "_at_before", "_at_rank"))
