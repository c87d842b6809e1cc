"""Epoch/batch history operators.

Histories are small per run (epochs), but per-batch logs grow with the
data (rows / batch size), so running metrics use bucketed prefix sums:
batches are grouped into fixed-width buckets, bucket totals (a small
table) give offsets, and the ordered window runs per bucket only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.session import cut_lineage, small_table

BATCHES_PER_BUCKET = 4096


def _clean(c: Column) -> Column:
    """NaN -> null, so NaN never wins a max (Python: ``nan > x`` is false)."""
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def best_so_far(history: DataFrame, run_col: str = "run", epoch_col: str = "epoch",
                score_col: str = "score") -> DataFrame:
    """Flag the epochs whose score strictly beats every earlier one
    (starting from 0); a NaN score is never an improvement."""
    w = Window.partitionBy(run_col).orderBy(epoch_col).rowsBetween(Window.unboundedPreceding, -1)
    prev = F.greatest(F.max(_clean(F.col(score_col))).over(w), F.lit(0.0))
    s = F.col(score_col)
    return history.withColumn("prev_best", prev).withColumn(
        "is_best", (~F.isnan(s)) & (s > F.col("prev_best")))


def early_stopping(history: DataFrame, patience: int = 3, min_delta: float = 0.0001,
                   mode: str = "max", run_col: str = "run", epoch_col: str = "epoch",
                   score_col: str = "score") -> DataFrame:
    """Per run, the best score and epoch and the epoch where training
    stops (null if it never stops), as an ordered fold over the run's
    epochs. The first epoch sets the baseline; later ones improve it only
    by more than ``min_delta``; ``patience`` non-improving epochs stop it.
    """
    if mode not in ("max", "min"):
        raise ValueError("mode must be 'max' or 'min'")
    epochs = F.array_sort(F.collect_list(F.struct(F.col(epoch_col).alias("e"), F.col(score_col).cast("double").alias("s"))))
    init = F.struct(F.lit(None).cast("double").alias("best"), F.lit(None).cast("int").alias("best_epoch"),
                    F.lit(0).alias("counter"), F.lit(None).cast("int").alias("stop_epoch"),
                    F.lit(False).alias("started"))

    def step(acc, x):
        s, best = x["s"], acc["best"]
        gain = (s > best + F.lit(min_delta)) if mode == "max" else (s < best - F.lit(min_delta))
        improved = (~F.isnan(s)) & (~F.isnan(best)) & gain
        counter = F.when(improved, F.lit(0)).otherwise(acc["counter"] + 1)
        return (F.when(acc["stop_epoch"].isNotNull(), acc)
                .when(~acc["started"], F.struct(s.alias("best"), x["e"].cast("int").alias("best_epoch"),
                                                F.lit(0).alias("counter"), F.lit(None).cast("int").alias("stop_epoch"),
                                                F.lit(True).alias("started")))
                .otherwise(F.struct(
                    F.when(improved, s).otherwise(best).alias("best"),
                    F.when(improved, x["e"].cast("int")).otherwise(acc["best_epoch"]).alias("best_epoch"),
                    counter.alias("counter"),
                    F.when(counter >= patience, x["e"].cast("int")).alias("stop_epoch"),
                    F.lit(True).alias("started"))))

    return (history.groupBy(run_col).agg(F.aggregate(epochs, init, step).alias("f"))
            .select(run_col, F.col("f.best").alias("best_score"), F.col("f.best_epoch").alias("best_epoch"),
                    F.col("f.stop_epoch").alias("stop_epoch")))


def running_sums(df: DataFrame, part_cols, order_col: str, value_cols,
                 per_bucket: int = BATCHES_PER_BUCKET) -> DataFrame:
    """Running totals of ``value_cols`` in ``order_col`` order per partition,
    computed per bucket of ``per_bucket`` consecutive order values plus the
    bucket's offset, so no window partition exceeds ``per_bucket`` rows."""
    part_cols = list(part_cols)
    b = df.withColumn("_bk", F.floor(F.col(order_col) / per_bucket))
    tot = b.groupBy(*part_cols, "_bk").agg(*[F.sum(v).alias(f"_t_{v}") for v in value_cols])
    wb = Window.partitionBy(*part_cols).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select(*part_cols, "_bk", *[F.coalesce(F.sum(f"_t_{v}").over(wb), F.lit(0)).alias(f"_o_{v}")
                                           for v in value_cols])
    # one row per bucket of ``per_bucket`` order values: small, materialised
    # once and broadcast after its size is checked
    offs = small_table(offs)
    wr = Window.partitionBy(*part_cols, "_bk").orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    out = b.join(offs, part_cols + ["_bk"])
    for v in value_cols:
        out = out.withColumn(f"cum_{v}", F.col(f"_o_{v}") + F.sum(v).over(wr))
    return out.drop("_bk", *[f"_o_{v}" for v in value_cols])


def running_train_metrics(rows: DataFrame, part_cols=("run", "epoch"), batch_col: str = "batch",
                          correct_col: str = "correct", loss_col: str = "loss") -> DataFrame:
    """Per batch, the batch loss and the cumulative accuracy so far."""
    per = rows.groupBy(*part_cols, batch_col).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(correct_col).cast("bigint")).alias("n_correct"),
        F.avg(loss_col).alias("batch_loss"))
    # one row per batch (rows / batch size), read twice below: written once
    per = cut_lineage(per)
    run = running_sums(per, part_cols, batch_col, ["n", "n_correct"])
    return run.select(*part_cols, batch_col, "n", "n_correct", "batch_loss",
                      (F.col("cum_n_correct") / F.col("cum_n")).alias("running_acc"))


def every_nth(df: DataFrame, n: int, col: str = "batch", one_based: bool = False) -> DataFrame:
    """keep every ``n``-th row by a 0-based (or 1-based) counter: the
    100th, 200th, ... batch, or every ``n``-th epoch."""
    c = F.col(col) if one_based else F.col(col) + 1
    return df.where(c % n == 0)


def history_columns(history: DataFrame, metrics, run_col: str = "run", epoch_col: str = "epoch") -> DataFrame:
    """S7 column form: per run, one array per metric in epoch order."""
    cols = []
    for m in metrics:
        arr = F.array_sort(F.collect_list(F.struct(F.col(epoch_col).alias("e"), F.col(m).alias("v"))))
        cols.append(F.transform(arr, lambda x: x["v"]).alias(m))
    return history.groupBy(run_col).agg(*cols)


def write_history(history: DataFrame, path: str, metrics, run_col: str = "run",
                  epoch_col: str = "epoch", form: str = "rows") -> str:
    """Row form (one JSON object per epoch) or column form (per run)."""
    out = history if form == "rows" else history_columns(history, metrics, run_col, epoch_col)
    out.write.mode("overwrite").json(path)
    return path
