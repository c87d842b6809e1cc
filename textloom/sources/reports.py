"""Text reports as ordered line tables.

A report is a DataFrame ``block, ord, line``; ``write_lines`` writes it as
text with a range-partitioned sort, so part files concatenated in name
order give the report and no single task holds all lines. Numbers are
formatted with Python's rules (round-half-even on the binary value) by a
small Arrow-batched helper that only ever sees the few report rows.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from textloom.operators.clean import SECTION_DELETED, SECTION_KEPT
from textloom.sources.positions import with_positions

# ---------------------------------------------------------------------------
# Fixed values (report wording and layout of the reference)
# ---------------------------------------------------------------------------
RULE_EQ = "=" * 60
RULE_DASH = "-" * 60
CLEAN_TITLE_NEW = "数据处理统计信息"
CLEAN_TITLE_OLD = "数据清洗统计信息"
CLEAN_LINES_NEW = ("原始样本数", "处理后样本数", "删除样本数", "原始类别数", "处理后类别数",
                   "删除类别数", "最小样本数标准")
CLEAN_LINES_OLD = ("原始样本数", "清洗后样本数", "删除样本数", "原始类别数", "清洗后类别数",
                   "删除类别数", "最小样本数标准")
SECTION_DELETED_TITLE = "删除的类别:"
SECTION_KEPT_TITLE = "保留的类别分布:"
SAMPLES_WORD = "样本"
LENGTH_TITLE = "Summary Token长度统计"
LENGTH_LINES = ("总样本数", "最小token长度", "最大token长度", "平均token长度", "中位数token长度", "标准差")
COVERAGE_LINE = "MAX_LENGTH={limit}: 覆盖 {pct}% 的数据"
# ---------------------------------------------------------------------------


@F.pandas_udf(StringType())
def _pyfmt(values: pd.Series, specs: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(v) else format(float(v), s) for v, s in zip(values, specs)])


def pyformat(col, spec: str) -> Column:
    """Format a double with a Python format spec such as ``.2f``."""
    c = F.col(col) if isinstance(col, str) else col
    return _pyfmt(c.cast("double"), F.lit(spec))


def _line(block: int, ord_, text: Column) -> Column:
    return F.struct(F.lit(block).alias("block"), F.lit(ord_).cast("bigint").alias("ord"), text.alias("line"))


def cleaning_report_lines(stats: DataFrame, classes: DataFrame, style: str = "new") -> DataFrame:
    """Summary lines, deleted section (omitted when empty), kept section.

    ``style='old'`` uses the old job's title and wording and takes the
    count after null removal as the original count.
    """
    names = CLEAN_LINES_NEW if style == "new" else CLEAN_LINES_OLD
    title = CLEAN_TITLE_NEW if style == "new" else CLEAN_TITLE_OLD
    first = "n_input" if style == "new" else "n_after_null"
    values = (first, "n_output", "n_rare_dropped", "n_classes_before", "n_classes_after",
              "n_classes_deleted", "min_samples")
    head = [_line(0, 0, F.lit(RULE_EQ)), _line(0, 1, F.lit(title)), _line(0, 2, F.lit(RULE_EQ))]
    head += [_line(0, 3 + i, F.concat(F.lit(f"{nm}: "), F.col(v).cast("string")))
             for i, (nm, v) in enumerate(zip(names, values))]
    head.append(_line(0, 10, F.lit("")))
    has_deleted = F.col("n_classes_deleted") > 0
    head += [
        F.when(has_deleted, _line(1, 0, F.lit(SECTION_DELETED_TITLE))),
        F.when(has_deleted, _line(1, 1, F.lit(RULE_DASH))),
        _line(3, 0, F.lit("")),
        _line(3, 1, F.lit(SECTION_KEPT_TITLE)),
        _line(3, 2, F.lit(RULE_DASH)),
    ]
    header = (stats.select(F.explode(F.array(*head)).alias("r"))
              .where(F.col("r").isNotNull()).select("r.*"))
    body = classes.select(
        F.when(F.col("section") == SECTION_DELETED, F.lit(2)).otherwise(F.lit(4)).alias("block"),
        F.col("rank").cast("bigint").alias("ord"),
        F.concat(F.col("label"), F.lit(": "), F.col("n").cast("string"), F.lit(f" {SAMPLES_WORD}")).alias("line"),
    ).where(F.col("block").isin(2, 4))
    lines = header.unionByName(body)
    if style != "new":
        # the old job writes no report at all when nothing is deleted
        lines = lines.where(stats.agg(F.max("n_classes_deleted")).scalar() > 0)
    return lines


def write_stats_report(stats: DataFrame, classes: DataFrame, path: str, style: str = "new") -> str:
    """Write the cleaning report as text (see ``cleaning_report_lines``)."""
    return write_lines(cleaning_report_lines(stats, classes, style), path)


def write_length_report(summary: DataFrame, coverage: DataFrame, path: str) -> str:
    """Write the length report as text (see ``length_report_lines``)."""
    return write_lines(length_report_lines(summary, coverage), path)


def length_report_lines(summary: DataFrame, coverage: DataFrame) -> DataFrame:
    """Title, rule, six statistics (means with 2 decimals), blank, one
    coverage line per limit."""
    vals = (F.col("n").cast("string"), F.col("min_len").cast("string"), F.col("max_len").cast("string"),
            pyformat("mean_len", ".2f"), pyformat("median_len", ".2f"), pyformat("std_len", ".2f"))
    head = [_line(0, 0, F.lit(LENGTH_TITLE)), _line(0, 1, F.lit(RULE_EQ))]
    head += [_line(0, 2 + i, F.concat(F.lit(f"{nm}: "), v)) for i, (nm, v) in enumerate(zip(LENGTH_LINES, vals))]
    head.append(_line(0, 8, F.lit("")))
    header = summary.select(F.explode(F.array(*head)).alias("r")).select("r.*")
    body = coverage.select(
        F.lit(1).alias("block"), F.col("limit").cast("bigint").alias("ord"),
        F.concat(F.lit("MAX_LENGTH="), F.col("limit").cast("string"), F.lit(": 覆盖 "),
                 pyformat("coverage_pct", ".2f"), F.lit("% 的数据")).alias("line"))
    return header.unionByName(body)


def write_lines(lines: DataFrame, path: str) -> str:
    """Write a line table as text in report order (no single-task funnel)."""
    lines.orderBy("block", "ord").select("line").write.mode("overwrite").text(path)
    return path


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``line_no, line`` of a written report: from 1, in file order."""
    text = spark.read.text(path)
    placed = with_positions(text, "_at")
    return placed.select(F.row_number().over(Window.orderBy("_at")).cast("bigint").alias("line_no"), F.col("value").alias("line"))


__all__ = ["read_lines", "cleaning_report_lines", "length_report_lines", "write_lines", "write_stats_report",
           "write_length_report", "pyformat", "SECTION_KEPT"]
