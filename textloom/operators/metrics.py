"""Evaluation operators.

Row-level work (argmax, loss, top-k) is native array math; the only
shuffles are the confusion aggregate (partial + final, at most
classes x classes groups) and small joins against the broadcast class
dictionary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.operators.labels import CODE
from textloom.session import small_table
from textloom.sources.corpus import LABEL

TOP_K = 5
BLOCK_COLUMNS = 256       # of the blocked confusion matrix


def accuracy(pairs: DataFrame, true_col: str = "y_true", pred_col: str = "y_pred") -> DataFrame:
    """Share of rows where prediction equals truth."""
    return pairs.agg(F.avg((F.col(true_col) == F.col(pred_col)).cast("int")).alias("accuracy"))


def confusion_matrix(pairs: DataFrame, true_col: str = "y_true", pred_col: str = "y_pred") -> DataFrame:
    """Long (sparse) confusion matrix ``y_true, y_pred, n``."""
    return pairs.groupBy(F.col(true_col).alias("y_true"), F.col(pred_col).alias("y_pred")).agg(
        F.count(F.lit(1)).alias("n"))


def _codes(confusion: DataFrame, dictionary: DataFrame | None) -> DataFrame:
    """Codes of a square matrix: every class of the dictionary when given,
    else every class seen as truth or prediction (the scikit-learn default)."""
    if dictionary is not None:
        return dictionary.select(F.col(CODE).cast("int").alias("c"))
    return (confusion.select(F.col("y_true").cast("int").alias("c"))
            .union(confusion.select(F.col("y_pred").cast("int").alias("c"))).distinct())


def confusion_wide(confusion: DataFrame, dictionary: DataFrame | None = None) -> DataFrame:
    """A11 wide form: a square matrix, one row per true code and one column
    per predicted code, zeros filled (codes as in ``_codes``). A matrix of many
    classes is one column a class; ``confusion_blocks`` and the long form
    (``confusion_matrix``) have no such width."""
    codes_df = _codes(confusion, dictionary)
    codes = sorted(r[0] for r in codes_df.collect())
    cells = [F.sum(F.when(F.col("y_pred") == c, F.col("n")).otherwise(0)).alias(str(c)) for c in codes]
    wide = confusion.groupBy("y_true").agg(*cells) if cells else confusion.select("y_true").distinct()
    rows = codes_df.select(F.col("c").alias("y_true"))
    return rows.join(wide, "y_true", "left").fillna(0)


def confusion_blocks(confusion: DataFrame, dictionary: DataFrame | None = None, width: int = BLOCK_COLUMNS) -> DataFrame:
    """The square matrix in blocks of ``width`` columns, the same layout
    for any number of classes: ``y_true``, ``first`` (the block's first column,
    counted over the sorted codes), ``codes`` and ``n`` (arrays of at most
    ``width`` predicted codes and their counts, zeros filled)."""
    order = small_table(_codes(confusion, dictionary).select(
        "c", (F.row_number().over(Window.orderBy("c")) - 1).alias("place")), "matrix-codes")
    blocks = order.groupBy((F.floor(F.col("place") / width) * width).cast("int").alias("first")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("place", "c"))), lambda x: x["c"]).alias("codes"))
    at = order.select(F.col("c").alias("y_pred"), (F.floor(F.col("place") / width) * width).cast("int").alias("first"))
    held = confusion.join(at, "y_pred").groupBy("y_true", "first").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("y_pred").cast("int"), F.col("n")))).alias("m"))
    # classes x blocks: every row of the matrix has every block
    n_blocks = blocks.agg(F.count("*")).scalar()
    grid = order.select(F.col("c").alias("y_true"), F.explode(F.sequence(F.lit(0), (n_blocks - 1).cast("int"))).alias("b"))
    grid = grid.select("y_true", (F.col("b") * width).alias("first"))
    return (grid.join(blocks, "first").join(held, ["y_true", "first"], "left")
            .select("y_true", "first", "codes", F.transform("codes", lambda c: F.coalesce(
                F.try_element_at("m", c), F.lit(0).cast("bigint"))).alias("n")))


def cells_of_blocks(blocks: DataFrame) -> DataFrame:
    """Long cells ``y_true, y_pred, n`` of a blocked matrix, zeros included."""
    return blocks.select("y_true", F.explode(F.arrays_zip("codes", "n")).alias("x")).select(
        "y_true", F.col("x.codes").alias("y_pred"), F.col("x.n").alias("n"))


def class_totals(confusion: DataFrame) -> DataFrame:
    """Per class code: true positives, support (row sum), predicted (column sum).

    One pass over the confusion cells: each cell contributes to its row
    class and its column class through ``explode``; no self-joins.
    """
    cell = F.explode(F.array(
        F.struct(F.col("y_true").alias(CODE), F.col("n").alias("sup"), F.lit(0).cast("bigint").alias("pred"),
                 F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(0).cast("bigint").alias("tp")),
        F.struct(F.col("y_pred").alias(CODE), F.lit(0).cast("bigint").alias("sup"), F.col("n").alias("pred"),
                 F.lit(0).cast("bigint").alias("tp")),
    ))
    return (confusion.select(cell.alias("c")).select("c.*")
            .groupBy(CODE).agg(F.sum("tp").alias("tp"), F.sum("sup").alias("support"),
                               F.sum("pred").alias("predicted")))


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def per_class_metrics(confusion: DataFrame, dictionary: DataFrame | None = None) -> DataFrame:
    """A12 + J5: precision, recall, F1, support per class; 0 when a
    denominator is 0. With a dictionary every known class gets a row
    (left join, zeros when absent) and its name."""
    t = class_totals(confusion)
    if dictionary is not None:
        t = (dictionary.select(CODE, LABEL).join(t, CODE, "left")
             .fillna(0, subset=["tp", "support", "predicted"]))
    tp, sup, pred = F.col("tp"), F.col("support"), F.col("predicted")
    cols = [CODE] + ([LABEL] if dictionary is not None else [])
    return t.select(
        *cols,
        _ratio(tp, pred).alias("precision"),
        _ratio(tp, sup).alias("recall"),
        _ratio(2 * tp, sup + pred).alias("f1_score"),
        sup.cast("bigint").alias("support"),
        pred.cast("bigint").alias("predicted"),
        tp.cast("bigint").alias("tp"),
    )


def overall_exprs() -> list:
    """Aggregate expressions of A13 over a per-class metrics table."""
    present = (F.col("support") + F.col("predicted")) > 0
    tot = F.sum("support")
    out = [(F.sum("tp") / tot).alias("accuracy")]
    for m in ("precision", "recall", "f1_score"):
        out.append(F.avg(F.when(present, F.col(m))).alias(f"macro_{m}"))
        out.append((F.sum(F.col(m) * F.col("support")) / tot).alias(f"weighted_{m}"))
    out.append(tot.cast("bigint").alias("support"))
    return out


def overall_metrics(per_class: DataFrame) -> DataFrame:
    """Accuracy, macro and support-weighted averages of P/R/F1.

    Macro averages run over classes present in truth or prediction (the
    scikit-learn default); weights are supports.
    """
    return per_class.agg(*overall_exprs())


def batch_mean_loss(df: DataFrame, loss_col: str = "loss", batch_col: str = "batch",
                    replica_col: str | None = None, group_cols=()) -> DataFrame:
    """Mean over batches of the batch loss, where a batch loss is the
    mean row loss (or, with replicas, the mean of the replica means)."""
    g = list(group_cols)
    per = df
    if replica_col:
        per = per.groupBy(*g, batch_col, replica_col).agg(F.avg(loss_col).alias(loss_col))
    per = per.groupBy(*g, batch_col).agg(F.avg(loss_col).alias("batch_loss"))
    return per.groupBy(*g).agg(F.avg("batch_loss").alias("mean_loss"),
                               F.count(F.lit(1)).alias("n_batches"))


def topk_struct(probs, k: int = TOP_K) -> Column:
    """T5: top ``min(k, n_classes)`` as ``array<struct<rank, code, probability,
    percentage>>``; ties keep the lowest class index first."""
    p = F.col(probs) if isinstance(probs, str) else probs
    keyed = F.transform(p, lambda x, i: F.struct((-x).alias("neg"), i.alias("idx"), x.alias("p")))
    top = F.slice(F.array_sort(keyed), 1, F.least(F.lit(k), F.size(p)))
    return F.transform(top, lambda s, i: F.struct(
        (i + 1).alias("rank"), s["idx"].alias(CODE), s["p"].alias("probability"),
        (s["p"] * 100).alias("percentage")))


def topk_classes(df: DataFrame, probs_col: str = "probs", k: int = TOP_K,
                 dictionary: DataFrame | None = None, keep=("row_id",)) -> DataFrame:
    """T5 (+J4): one row per (row, rank) with the class name when a
    dictionary is given (broadcast left join)."""
    out = df.select(*keep, F.explode(topk_struct(probs_col, k)).alias("t")).select(*keep, "t.*")
    if dictionary is not None:
        d = dictionary.select(CODE, F.col(LABEL).alias("class"))
        out = out.join(small_table(d), CODE, "left")
    return out
