"""Session set-up, the shared work folder, and derived small tables."""

from __future__ import annotations

import os
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app: str = "textloom", driver_memory: str = "8g") -> SparkSession:
    """Build (or reuse) a session with AQE and skew handling on and the UI off."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    spark = (
        builder
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # remove checkpoint files once their DataFrame is no longer referenced
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Read from the session; only in local mode with nothing configured (tests)
    a fresh folder under /tmp is set, elsewhere a missing folder is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="textloom-ckpt-", dir="/tmp")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh folder inside the shared checkpoint folder for written tables."""
    base = shared_dir(spark)
    return os.path.join(base, "tables", f"{name}-{uuid.uuid4().hex[:12]}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def local_table(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A few rows of the driver as a table, handed over as Arrow: no Python
    workers are started (and kept) on the executors to unpickle them."""
    fields = StructType.fromDDL(schema)
    arrow = to_arrow_schema(fields)
    columns = [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow), fields)


def small_table(df: DataFrame, name: str = "small") -> DataFrame:
    """Write a derived table as Parquet in the shared folder and read it back.

    It is computed once, survives executor loss and has real byte statistics,
    so Spark itself broadcasts it below ``spark.sql.autoBroadcastJoinThreshold``
    and joins by shuffle (with skew handling) beyond; there is no row limit.
    """
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
