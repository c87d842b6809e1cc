"""Evaluation report job."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators import metrics as MT
from textloom.session import small_table
from textloom.sources.corpus import LABEL
from textloom.sources.reports import pyformat, write_lines

# ---------------------------------------------------------------------------
# Fixed values (scikit-learn classification report layout, 4 digits)
# ---------------------------------------------------------------------------
REPORT_HEADERS = ("precision", "recall", "f1-score", "support")
LAST_LINE_HEADING = "weighted avg"
REPORT_DIGITS = 4
# ---------------------------------------------------------------------------


class Evaluation(NamedTuple):
    confusion: DataFrame   # y_true, y_pred, n (A11)
    per_class: DataFrame   # code, label, precision, recall, f1_score, support (A12 + J5)
    overall: DataFrame     # one row (A13)


def evaluation_report(pairs: DataFrame, dictionary: DataFrame,
                      true_col: str = "y_true", pred_col: str = "y_pred") -> Evaluation:
    """M9: confusion matrix, per-class and overall metrics from pairs. The
    cells (classes squared at most) are written once for all that read them."""
    conf = small_table(MT.confusion_matrix(pairs, true_col, pred_col), "confusion")
    per = MT.per_class_metrics(conf, dictionary)
    return Evaluation(conf, per, MT.overall_metrics(per))


def metrics_document(per_class: DataFrame) -> DataFrame:
    """One row, ``per_class`` map (class -> P/R/F1/support) and the
    ``overall`` struct, built in a single aggregate over the class table."""
    agg = per_class.agg(
        F.map_from_entries(F.collect_list(F.struct(
            F.col(LABEL), F.struct("precision", "recall", "f1_score", F.col("support").cast("int").alias("support"))
        ))).alias("per_class"),
        *MT.overall_exprs(),
    )
    return agg.select(
        "per_class",
        F.struct(
            "accuracy",
            F.struct(F.col("macro_precision").alias("precision"), F.col("macro_recall").alias("recall"),
                     F.col("macro_f1_score").alias("f1_score")).alias("macro_avg"),
            F.struct(F.col("weighted_precision").alias("precision"), F.col("weighted_recall").alias("recall"),
                     F.col("weighted_f1_score").alias("f1_score")).alias("weighted_avg"),
        ).alias("overall"))


def write_metrics_json(per_class: DataFrame, path: str) -> str:
    """The metrics document as one JSON line."""
    metrics_document(per_class).select(F.to_json(F.struct("per_class", "overall")).alias("json")) \
        .write.mode("overwrite").text(path)
    return path


def write_confusion(confusion: DataFrame, path: str, wide: bool = False,
                    dictionary: DataFrame | None = None) -> str:
    """The confusion matrix as parquet: long cells, or the square
    matrix in column blocks (over seen classes, or over the dictionary when
    given), whatever the number of classes."""
    out = MT.confusion_blocks(confusion, dictionary) if wide else confusion
    out.write.mode("overwrite").parquet(path)
    return path


def read_confusion_wide(spark: SparkSession, path: str) -> DataFrame:
    """Cells ``y_true, y_pred, n`` of a written square matrix."""
    return MT.cells_of_blocks(spark.read.parquet(path))


def report_rows(per_class: DataFrame) -> DataFrame:
    """Numeric rows of the classification report: classes, then accuracy,
    macro avg and weighted avg (``kind`` orders them)."""
    classes = per_class.select(F.lit(1).alias("kind"), F.col("code").cast("bigint").alias("code"),
                               F.col(LABEL).alias("name"), "precision", "recall",
                               "f1_score", F.col("support").cast("bigint").alias("support"))
    o = MT.overall_metrics(per_class)

    def row(kind, name, p, r, f):
        return F.struct(F.lit(kind).alias("kind"), F.lit(None).cast("bigint").alias("code"),
                        F.lit(name).alias("name"), p.cast("double").alias("precision"),
                        r.cast("double").alias("recall"), f.alias("f1_score"), F.col("support").alias("support"))

    none = F.lit(None)
    avgs = o.select(F.explode(F.array(
        row(2, "accuracy", none, none, F.col("accuracy")),
        row(3, "macro avg", F.col("macro_precision"), F.col("macro_recall"), F.col("macro_f1_score")),
        row(4, "weighted avg", F.col("weighted_precision"), F.col("weighted_recall"), F.col("weighted_f1_score")),
    )).alias("r")).select("r.*")
    return classes.unionByName(avgs)


def classification_report_lines(per_class: DataFrame, best_epoch: int | None = None,
                                val_acc: float | None = None) -> DataFrame:
    """The per-class table with averages (4 digits); with a best
    epoch, the v2 header ``Best Epoch`` / ``Validation Accuracy`` first."""
    rows = report_rows(per_class)
    width = F.greatest(F.lit(len(LAST_LINE_HEADING)), F.lit(REPORT_DIGITS),
                       per_class.agg(F.max(F.length(LABEL))).scalar())
    num = [pyformat(c, f">9.{REPORT_DIGITS}f") for c in ("precision", "recall", "f1_score")]
    sup = pyformat("support", ">9.0f")
    name = F.lpad(F.col("name"), width, " ")
    body = F.when(F.col("kind") == 2, F.concat(name, F.lit(" "), F.lit(" " * 20), F.lit(" "), num[2], F.lit(" "), sup)) \
        .otherwise(F.concat(name, F.lit(" "), F.lit(" "), num[0], F.lit(" "), num[1], F.lit(" "), num[2], F.lit(" "), sup))
    lines = rows.select(F.when(F.col("kind") == 1, F.lit(2)).otherwise(F.lit(4)).alias("block"),
                        F.when(F.col("kind") == 1, F.col("code") + 1)
                        .otherwise(F.col("kind")).cast("bigint").alias("ord"),
                        body.alias("line"))
    head_txt = F.concat(F.repeat(F.lit(" "), width), F.lit(" "),
                        *[F.lit(" " + h.rjust(9)) for h in REPORT_HEADERS])
    spark = per_class.sparkSession
    fixed = spark.range(1).select(F.explode(F.array(
        F.struct(F.lit(1).alias("block"), F.lit(0).cast("bigint").alias("ord"), head_txt.alias("line")),
        F.struct(F.lit(1).alias("block"), F.lit(1).cast("bigint").alias("ord"), F.lit("").alias("line")),
        F.struct(F.lit(3).alias("block"), F.lit(0).cast("bigint").alias("ord"), F.lit("").alias("line")),
    )).alias("r")).select("r.*")
    out = fixed.unionByName(lines)
    if best_epoch is not None:
        acc = "" if val_acc is None else format(float(val_acc), ".4f")
        top = spark.range(1).select(F.explode(F.array(
            F.struct(F.lit(0).alias("block"), F.lit(0).cast("bigint").alias("ord"),
                     F.lit(f"Best Epoch: {best_epoch}").alias("line")),
            F.struct(F.lit(0).alias("block"), F.lit(1).cast("bigint").alias("ord"),
                     F.lit(f"Validation Accuracy: {acc}").alias("line")),
            F.struct(F.lit(0).alias("block"), F.lit(2).cast("bigint").alias("ord"), F.lit("").alias("line")),
        )).alias("r")).select("r.*")
        out = top.unionByName(out)
    return out


def write_classification_report(per_class: DataFrame, path: str, best_epoch: int | None = None,
                                val_acc: float | None = None) -> str:
    return write_lines(classification_report_lines(per_class, best_epoch, val_acc), path)
