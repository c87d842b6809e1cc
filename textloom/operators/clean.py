"""Cleaning operators.

Plan shape at scale: the corpus is scanned once for the per-label
summary (partial + final hash aggregate, so a hot label is combined on
the map side) and once for the output (a broadcast left-semi join against
the kept classes, so the corpus itself is never shuffled).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.scores import keep_flag
from textloom.functions.text import has_visible_text
from textloom.session import small_table
from textloom.sources.corpus import LABEL, TEXT

SECTION_DELETED = "deleted"
SECTION_KEPT = "kept"


def drop_null_rows(df: DataFrame, cols=(TEXT, LABEL)) -> DataFrame:
    """drop rows that are null in any of ``cols``.

    Written as ``IS NOT NULL`` predicates (not ``na.drop``, whose
    ``AtLeastNNonNulls`` is not translated into a data source filter), so
    the checks reach the Parquet scan as pushed filters.
    """
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df.where(cond)


def drop_blank_text(df: DataFrame, col: str = TEXT) -> DataFrame:
    """keep rows whose stripped text is non-empty."""
    return df.where(has_visible_text(F.col(col)))


def label_summary(df: DataFrame, text_col: str = TEXT, label_col: str = LABEL) -> DataFrame:
    """One pass per label: all rows (``n_all``) and rows without nulls (``n``).

    The null-label group is kept (``label`` null, ``n`` 0) so that input and
    null counts come out of the same aggregate as the class counts.
    """
    ok = F.col(text_col).isNotNull() & F.col(label_col).isNotNull()
    return df.groupBy(F.col(label_col).alias(LABEL)).agg(
        F.count(F.lit(1)).alias("n_all"),
        F.count_if(ok).alias("n"),
    )


def label_counts(df: DataFrame, label_col: str = LABEL, ordered: bool = False) -> DataFrame:
    """A1: rows per non-null label, optionally ordered by count desc."""
    out = (df.where(F.col(label_col).isNotNull())
           .groupBy(F.col(label_col).alias(LABEL)).agg(F.count(F.lit(1)).alias("n")))
    return out.orderBy(F.desc("n"), LABEL) if ordered else out


def counts_from_summary(summary: DataFrame) -> DataFrame:
    """A1 derived from ``label_summary`` (classes present after null removal)."""
    return summary.where(F.col(LABEL).isNotNull() & (F.col("n") > 0)).select(LABEL, "n")


def row_count(df: DataFrame) -> DataFrame:
    """A2: one-row row count."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def n_classes(df: DataFrame, label_col: str = LABEL) -> DataFrame:
    """A3: distinct non-null labels."""
    return df.agg(F.countDistinct(label_col).alias("n_classes"))


def kept_classes(counts: DataFrame, min_samples: int) -> DataFrame:
    return counts.where(F.col("n") >= F.lit(min_samples)).select(LABEL)


def filter_rare_classes(df: DataFrame, min_samples: int = 100,
                        counts: DataFrame | None = None, label_col: str = LABEL) -> DataFrame:
    """Rows whose class has at least ``min_samples`` rows.

    A broadcast left-semi join against the kept classes (size-checked);
    beyond the bound Spark falls back to a shuffle join.
    """
    counts = counts if counts is not None else label_counts(df, label_col)
    kept = kept_classes(counts, min_samples).withColumnRenamed(LABEL, label_col)
    return df.join(small_table(kept), label_col, "left_semi").select(*df.columns)


def rare_rows(df: DataFrame, min_samples: int = 100,
              counts: DataFrame | None = None, label_col: str = LABEL) -> DataFrame:
    """The removed rows (non-null label of a rare class)."""
    counts = counts if counts is not None else label_counts(df, label_col)
    kept = kept_classes(counts, min_samples).withColumnRenamed(LABEL, label_col)
    return (df.where(F.col(label_col).isNotNull())
            .join(small_table(kept), label_col, "left_anti").select(*df.columns))


def cleaning_stats(summary: DataFrame, min_samples: int) -> DataFrame:
    """One row of audit counts from ``label_summary``.

    ``n_input`` counts rows before null removal, ``n_null_dropped`` rows
    with a null text or label, ``n_rare_dropped`` rows of rare classes.
    """
    has = F.col(LABEL).isNotNull() & (F.col("n") > 0)
    big = has & (F.col("n") >= F.lit(min_samples))
    small = has & (F.col("n") < F.lit(min_samples))
    return summary.agg(
        F.coalesce(F.sum("n_all"), F.lit(0)).cast("bigint").alias("n_input"),
        F.coalesce(F.sum(F.col("n_all") - F.col("n")), F.lit(0)).cast("bigint").alias("n_null_dropped"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_after_null"),
        F.coalesce(F.sum(F.when(small, F.col("n"))), F.lit(0)).cast("bigint").alias("n_rare_dropped"),
        F.coalesce(F.sum(F.when(big, F.col("n"))), F.lit(0)).cast("bigint").alias("n_output"),
        F.count_if(has).alias("n_classes_before"),
        F.count_if(big).alias("n_classes_after"),
        F.count_if(small).alias("n_classes_deleted"),
        F.lit(min_samples).cast("bigint").alias("min_samples"),
    )


def cleaning_classes(counts: DataFrame, min_samples: int) -> DataFrame:
    """A19 + P5 + W1: classes in report sections, ranked by count desc.

    ``counts`` is the (small) class table; the window is partitioned by
    section over that table, never over corpus rows.
    """
    section = F.when(F.col("n") >= F.lit(min_samples), F.lit(SECTION_KEPT)).otherwise(F.lit(SECTION_DELETED))
    w = Window.partitionBy("section").orderBy(F.desc("n"), F.col(LABEL))
    return (counts.select(LABEL, "n")
            .withColumn("section", section)
            .withColumn("status", keep_flag("n", min_samples))
            .withColumn("rank", F.row_number().over(w)))


def label_rank(counts: DataFrame, partition_col: str | None = None) -> DataFrame:
    """Position of each class (count desc, label asc) within a section."""
    w = Window.orderBy(F.desc("n"), F.col(LABEL))
    if partition_col:
        w = Window.partitionBy(partition_col).orderBy(F.desc("n"), F.col(LABEL))
    return counts.withColumn("rank", F.row_number().over(w))


def pct_of_total(counts: DataFrame, n_col: str = "n") -> DataFrame:
    """Each row's share of the total in percent (on a small table; the
    total is a scalar subquery, not a join)."""
    total = counts.agg(F.sum(n_col)).scalar()
    return counts.withColumn("pct", F.col(n_col) / total * 100)
