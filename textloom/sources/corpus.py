"""Corpus scans and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.text import PANDAS_NA_TOKENS, null_if_token
from textloom.sources.positions import with_positions

TEXT = "summary"
LABEL = "label"
ROW_ID = "row_id"


def read_corpus(spark: SparkSession, path: str, fmt: str = "csv",
                text_col: str = TEXT, label_col: str = LABEL,
                row_id_col: str | None = None, multiline: bool = True) -> DataFrame:
    """Scan a labelled corpus; output ``row_id, summary, label`` + extras.

    CSV is read with a header, quoted multi-line fields and doubled quotes,
    all columns as strings (no schema inference pass over the data). Extra
    columns pass through untouched; one that would clash with an output name
    raises. An existing ``row_id`` column is used; without one a row id is the
    row's place in its file (``with_positions``), so it is the same however the
    input is split; for CSV and JSON that takes one more scan, which counts rows.
    A multi-line CSV file cannot be split, so each file is one task: at
    scale use many moderate files, Parquet, or ``multiline=False`` when no
    quoted field holds a line break.
    """
    if fmt == "csv":
        df = (spark.read.option("header", True).option("multiLine", multiline)
              .option("escape", '"').option("inferSchema", False).csv(path))
    elif fmt == "parquet":
        df = spark.read.parquet(path)
    elif fmt == "json":
        df = spark.read.json(path)
    else:
        raise ValueError(f"unsupported format {fmt!r}")
    missing = [c for c in (text_col, label_col) if c not in df.columns]
    if missing:
        raise ValueError(f"corpus is missing required column(s) {missing}")
    if row_id_col is None and ROW_ID in df.columns:
        row_id_col = ROW_ID
    used = {text_col, label_col, row_id_col}
    clash = [c for c in (TEXT, LABEL, ROW_ID) if c in df.columns and c not in used]
    if clash:
        raise ValueError(f"column(s) {clash} would be replaced; rename them or name them as text, label or row id")
    extras = [c for c in df.columns if c not in used]
    if row_id_col is None:
        df, row_id_col = with_positions(df, ROW_ID, fmt == "parquet"), ROW_ID
    rid = F.col(row_id_col).cast("bigint")
    return df.select(
        rid.alias(ROW_ID),
        F.col(text_col).cast("string").alias(TEXT),
        F.col(label_col).cast("string").alias(LABEL),
        *extras,
    )


def normalize_na(df: DataFrame, cols=(TEXT, LABEL), tokens=PANDAS_NA_TOKENS) -> DataFrame:
    """Turn the CSV null words pandas recognises into real nulls."""
    return df.withColumns({c: null_if_token(F.col(c), tokens) for c in cols})


def write_corpus(df: DataFrame, path: str, fmt: str = "csv") -> str:
    """S3: write all columns (no index) as a folder of part files."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        (w.option("header", True).option("escape", '"').option("encoding", "UTF-8")
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    elif fmt == "parquet":
        w.parquet(path)
    else:
        raise ValueError(f"unsupported format {fmt!r}")
    return path


def preview(df: DataFrame, n: int = 5, order_col: str = ROW_ID) -> DataFrame:
    """First ``n`` rows in row-id (file) order; a top-k, not a full sort."""
    return df.orderBy(order_col).limit(n)
