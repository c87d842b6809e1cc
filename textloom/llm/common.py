"""Helpers shared by the training-data operators."""

from __future__ import annotations

import pickle
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.session import work_path
from textloom.sources.positions import with_positions

# The ASCII word class of the contracts, as Java regex.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read whole by Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it
    back: cuts lineage, survives lost executors, gives real size statistics."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


BATCH_BYTES = 1 << 20


@contextmanager
def small_batches(spark: SparkSession):
    """For tables written inside: Arrow batches to Python workers have about
    ``BATCH_BYTES``. Spark's bound is 10,000 rows, so that an executor would hold
    a task's whole texts several times. A bound of the session's own stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    own = spark.conf.get(key, None)
    if own is None:
        spark.conf.set(key, str(BATCH_BYTES))
    try:
        yield
    finally:
        if own is None:
            spark.conf.unset(key)


def lower_ascii(c):
    """Lower-case A-Z only."""
    return F.translate(c, ASCII_UPPER, ASCII_LOWER)


def words(c):
    """``array<string>`` of the contract's words; empty for null text."""
    parts = F.split(F.coalesce(c, F.lit("")), GAP)
    return F.filter(parts, lambda w: w != "")


def positions(df: DataFrame, order: list, name: str = "positions") -> DataFrame:
    """``df`` (a narrow table) with ``pos``, the 0-based place of each row in
    the total order ``order``. One range exchange and a sort inside each
    partition; a place is the partition's offset plus the index inside it. The
    offsets have one row a partition, which bounds their broadcast."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = stored(df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                    .withColumn("_i", F.monotonically_increasing_id()), name)
    part = F.shiftright("_i", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
               .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    return (placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
            .withColumn("pos", F.col("_before") + F.col("_i").bitwiseAND(F.lit((1 << 33) - 1)))
            .drop("_i", "_part", "_before"))


BROADCAST_BYTES = 64 << 20


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def numbered(df: DataFrame, name: str, scan: bool = False) -> tuple[DataFrame, str]:
    """``df`` with a unique, repeatable row number, and that column's name.

    ``scan``: ``df`` is a plain scan of Parquet files, whose rows have places in
    their files; nothing is written. Otherwise a numbered copy is stored."""
    row = fresh(df, "_row")
    if scan:
        return with_positions(df, row, indexed=True), row
    return stored(df.withColumn(row, F.monotonically_increasing_id()), name, "zstd"), row


def small_side(df: DataFrame, row_bytes, bound: int = BROADCAST_BYTES) -> DataFrame:
    """``df``, a stored table, marked for broadcast if its rows (``row_bytes``
    each) are counted to stay within ``bound``; else Spark joins by shuffle."""
    size = df.agg(F.sum(F.lit(row_bytes) if isinstance(row_bytes, int) else row_bytes)).first()[0] or 0
    return F.broadcast(df) if size <= bound else df


def without_rows(rows: DataFrame, row: str, gone: DataFrame) -> DataFrame:
    """``rows`` less those numbered in ``gone`` (one column), and less ``row``."""
    with small_batches(gone.sparkSession):
        gone = stored(gone.toDF(row), "gone-rows")
    return rows.join(small_side(gone, 32), row, "left_anti").drop(row)


class Shared:
    """A broadcast value that may hold instances of the package's own classes:
    they travel as bytes with their classes, so executors need no copy of the
    package. A worker unpickles it once and keeps it beside the broadcast."""

    def __init__(self, spark: SparkSession, value):
        self._bytes = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        if not hasattr(self._bytes, "held"):
            self._bytes.held = pickle.loads(self._bytes.value)
        return self._bytes.held
