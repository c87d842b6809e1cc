"""Exact stratified split and batch assignment.

Both need a rank inside a large ordered set (a class, or the whole table). A
plain window would put a whole class - or the whole table - into one task.

The split looks for one cut-off per class: the ``(md5, row id)`` key that its
quota ends with. Count histograms of a narrow table of keys close in on it, and
then one scan of the rows compares each with its class's cut-off; rows are
not exchanged. Batches order rows by buckets of about ``rows_per_bucket``, whose
counts give each bucket's offset; rows cross one exchange, by bucket.
"""

from __future__ import annotations

import math

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.session import small_table
from textloom.sources.corpus import LABEL, ROW_ID

ROWS_PER_BUCKET = 1_000_000
LEAST_PER_BUCKET = 10_000
KEY_BITS, PROBE_BITS = 60, 12       # of the md5 key; of one histogram
TRAIN = "train"
VALIDATION = "validation"


def shuffle_key(*parts) -> Column:
    """md5 hex of ``parts`` joined by ``|`` (seeded, reproducible order)."""
    return F.md5(F.concat_ws("|", *[p if isinstance(p, Column) else F.lit(str(p)) for p in parts]))


def _key_bucket(h: Column, n_buckets: Column) -> Column:
    """Bucket of a hex key: ``floor(top32(h) * n / 2^32)``, monotone in ``h``."""
    top32 = F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint")
    return F.floor(top32.cast("double") * n_buckets / F.lit(4294967296.0)).cast("bigint")


def _bucket_rows(df: DataFrame, n_rows: int, rows_per_bucket: int) -> int:
    """Rows per bucket: at most ``rows_per_bucket`` (bounds every window
    partition), and for large tables about four buckets per core."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(1, min(rows_per_bucket, max(LEAST_PER_BUCKET, math.ceil(n_rows / (4 * cores)))))


# -- W7 ----------------------------------------------------------------------
def split_quotas(counts: DataFrame, test_size: float) -> DataFrame:
    """Exact per-class train quotas (largest remainder, ties by label).

    n_test = ceil(test_size * n), n_train = n - n_test; each class gets
    floor(c * n_train / n) and the leftover seats go to the largest
    remainders. Runs on the (size-checked) class table only.
    """
    tot = Window.partitionBy()
    n = F.sum("n").over(tot)
    n_train = n - F.ceil(F.lit(test_size) * n)
    prod = F.col("n").cast("decimal(38,0)") * F.col("n_train").cast("decimal(38,0)")
    base = (counts.select(LABEL, "n")
            .withColumn("n_total", n)
            .withColumn("n_train", n_train.cast("bigint"))
            .withColumn("q_floor", F.floor(prod / F.col("n_total")).cast("bigint"))
            .withColumn("rem", (prod % F.col("n_total")).cast("decimal(38,0)")))
    seats = F.col("n_train") - F.sum("q_floor").over(tot)
    order = Window.orderBy(F.desc("rem"), F.col(LABEL))
    return (base.withColumn("seats", seats)
            .withColumn("r", F.row_number().over(order))
            .select(LABEL, "n", "n_total", "n_train",
                    (F.col("q_floor") + F.when(F.col("r") <= F.col("seats"), 1).otherwise(0))
                    .cast("bigint").alias("quota")))


def _cells(hist: DataFrame, wanted: DataFrame) -> DataFrame:
    """Of each class, the cell of ``hist`` (``label, cell, cnt``) that holds the
    ``need``-th of its rows: ``label, cell, cnt`` and the ``need`` inside it."""
    w = Window.partitionBy(LABEL).orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = hist.withColumn("upto", F.sum("cnt").over(w)).join(wanted, LABEL)
    first = (F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("cnt") < F.col("need"))
    return upto.where(first).select(LABEL, "cell", "cnt", (F.col("need") - F.col("upto") + F.col("cnt")).alias("need"))


def split_cutoffs(df: DataFrame, test_size: float = 0.2, seed: int = 42, label_col: str = LABEL,
                  rows_per_bucket: int = ROWS_PER_BUCKET, materialize: bool = True) -> DataFrame:
    """``label, cut_key, cut_id`` of every class: the last key (md5 hex,
    then row id) of its train quota, null where that is 0.

    A first histogram over the keys' top bits gives class counts, quotas and the
    cell each cut-off lies in. While a cell holds more than ``rows_per_bucket``
    rows, a further one over its rows alone narrows it. The rows left are
    counted by whole key, so repeated ids are one key.
    """
    def keep(d, name):
        return small_table(d, name) if materialize else d

    key = shuffle_key(F.lit(seed), F.col(ROW_ID).cast("string"))
    keys = keep(df.where(F.col(label_col).isNotNull()).select(
        F.col(label_col).alias(LABEL), F.conv(F.substring(key, 1, KEY_BITS // 4), 16, 10).cast("bigint").alias("h"), ROW_ID), "split-keys")
    shift = KEY_BITS - PROBE_BITS
    hist = keep(keys.groupBy(LABEL, F.shiftright("h", shift).alias("cell")).agg(F.count(F.lit(1)).alias("cnt")), "split-counts")
    counts = hist.groupBy(LABEL).agg(F.sum("cnt").alias("n"))
    row = counts.agg(F.sum("n").alias("n"), F.min("n").alias("mn"), F.count("*").alias("c")) \
        .withColumn("most", hist.agg(F.max("cnt")).scalar()).first()
    n_classes, n_total, smallest = int(row["c"]), int(row["n"] or 0), int(row["mn"] or 0)
    n_test = math.ceil(test_size * n_total)
    n_train = n_total - n_test
    if smallest < 2:
        raise ValueError("The least populated class has only 1 member; a stratified split needs at least 2.")
    if n_train < n_classes or n_test < n_classes:
        raise ValueError(f"train ({n_train}) and test ({n_test}) sizes must be at least the number of "
                         f"classes ({n_classes})")
    wanted = split_quotas(counts, test_size).select(LABEL, F.col("quota").alias("need"))
    cells, most = _cells(hist, wanted), int(row["most"])
    while most > rows_per_bucket and shift > 0:
        cells, wide = keep(cells, "split-cells"), shift
        shift = max(0, shift - PROBE_BITS)
        inside = keys.join(cells.select(LABEL, "cell"), (keys[LABEL] == cells[LABEL]) & (F.shiftright("h", wide) == cells["cell"]), "left_semi")
        hist = keep(inside.groupBy(LABEL, F.shiftright("h", shift).alias("cell")).agg(F.count(F.lit(1)).alias("cnt")), "split-counts")
        most = int(hist.agg(F.max("cnt")).first()[0] or 0)
        cells = _cells(hist, cells.select(LABEL, "need"))
    cells = keep(cells, "split-cells")
    near = keys.join(cells.select(LABEL, "cell"), (keys[LABEL] == cells[LABEL]) & (F.shiftright("h", shift) == cells["cell"]), "left_semi")
    near = near.groupBy(LABEL, ROW_ID).agg(F.count(F.lit(1)).alias("cnt")).withColumn("cell", F.struct(key.alias("k"), F.col(ROW_ID).alias("id")))
    found = _cells(near.select(LABEL, "cell", "cnt"), cells.select(LABEL, "need"))
    cuts = counts.select(LABEL).join(found, LABEL, "left").select(
        LABEL, F.col("cell.k").alias("cut_key"), F.col("cell.id").alias("cut_id"))
    return keep(cuts, "split-cutoffs")


def stratified_split(df: DataFrame, test_size: float = 0.2, seed: int = 42,
                     label_col: str = LABEL, rows_per_bucket: int = ROWS_PER_BUCKET,
                     materialize: bool = True) -> DataFrame:
    """Exact stratified train/validation split; adds column ``split``.

    Membership: within each class, the ``quota`` rows with the smallest
    ``md5(seed|row_id)`` (ties by row id) go to train. Rows are compared with
    their class's cut-off (``split_cutoffs``) in one scan. Rows of one class and
    id are never parted: where an id is repeated across the cut-off, all its
    rows go to train. Rows without a label are dropped. Raises like the
    reference's splitter when a class has one member or either side would
    be smaller than the number of classes.
    """
    cuts = split_cutoffs(df, test_size, seed, label_col, rows_per_bucket, materialize)
    cuts = cuts.withColumnRenamed(LABEL, "_label")
    key = shuffle_key(F.lit(seed), F.col(ROW_ID).cast("string"))
    upto = (key < F.col("cut_key")) | ((key == F.col("cut_key")) & (F.col(ROW_ID) <= F.col("cut_id")))
    return (df.join(cuts, F.col(label_col) == F.col("_label"))
            .withColumn("split", F.when(upto, F.lit(TRAIN)).otherwise(F.lit(VALIDATION)))
            .drop("_label", "cut_key", "cut_id"))


# -- W6 ----------------------------------------------------------------------
def global_positions(df: DataFrame, bucket: Column, order_cols: list) -> DataFrame:
    """0-based position of each row in the order ``order_cols``.

    ``bucket`` must be a monotone function of that order and read narrow
    columns only. Positions are the bucket's offset (from a small table of
    counts, over a scan of those columns) plus the rank inside the bucket: one
    exchange of rows.
    """
    b = df.withColumn("_b", bucket)
    sizes = b.groupBy("_b").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = small_table(sizes.select("_b", F.coalesce(F.sum("_cnt").over(w), F.lit(0)).alias("_off")), "offsets")
    wr = Window.partitionBy("_b").orderBy(*order_cols)
    return (b.join(offsets, "_b")
            .withColumn("pos", (F.col("_off") + F.row_number().over(wr) - 1).cast("bigint"))
            .drop("_b", "_off"))


def _range_bucket(df: DataFrame, n_buckets: int) -> Column:
    """Bucket of a row id among ``n_buckets`` even ranges: bounds are quantiles
    of all ids (a sketch), looked up by binary search in Arrow batches of the id
    column alone. Null ids come first."""
    share = [i / n_buckets for i in range(1, n_buckets)]
    cuts = df.agg(F.percentile_approx(ROW_ID, share, max(10_000, 10 * n_buckets))).first()[0] or []
    bounds = np.unique(np.array(cuts, np.int64))

    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for ids in batches:
            values = pc.fill_null(ids.cast(pa.int64()), np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
            yield pa.array(np.searchsorted(bounds, values, "right"), pa.int64())
    return F.arrow_udf(find, "bigint")(F.col(ROW_ID))


def assign_batches(df: DataFrame, batch_size: int, seed: int = 42, epoch: int = 1,
                   shuffle: bool = True, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Global position and ``batch = pos div batch_size``.

    ``shuffle=True``: order by ``md5(seed|epoch|row_id)`` (a fresh order per
    epoch); buckets are ranges of the hash, so they are even by design.
    ``shuffle=False``: keep row-id order (validation loader); buckets are ranges
    between quantiles of the ids, so sparse or clustered ids still give even
    buckets. Either way rows cross one exchange and are not written first.
    """
    n = int(df.agg(F.count(F.lit(1))).first()[0] or 0)
    nb = max(1, math.ceil(n / _bucket_rows(df, n, rows_per_bucket)))
    if shuffle:
        key = shuffle_key(F.lit(seed), F.lit(epoch), F.col(ROW_ID).cast("string"))
        out = global_positions(df, _key_bucket(key, F.lit(nb)), [key, F.col(ROW_ID)])
    else:
        out = global_positions(df, _range_bucket(df, nb) if nb > 1 else F.lit(0), [F.col(ROW_ID)])
    return out.withColumn("batch", F.floor(F.col("pos") / F.lit(batch_size)).cast("bigint"))


# -- A20, A21, U2 --------------------------------------------------------------
def split_sizes(split_df: DataFrame, by_label: bool = False, label_col: str = LABEL) -> DataFrame:
    """Rows per split (and per class)."""
    keys = ["split", label_col] if by_label else ["split"]
    return split_df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def batch_counts(split_df: DataFrame, batch_size: int) -> DataFrame:
    """Batches per split, ``ceil(n / batch_size)``."""
    return split_df.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"),
        F.ceil(F.count(F.lit(1)) / F.lit(batch_size)).cast("bigint").alias("n_batches"))


def split_is_partition(df: DataFrame, split_df: DataFrame) -> DataFrame:
    """Train and validation are disjoint and together equal the input.

    One row: ``n_missing`` (input rows in no split), ``n_extra`` (split rows
    not in the input, or repeated), ``n_overlap`` (ids in both splits). Both
    tables' ids are tagged with their side and counted by id in one aggregate.
    """
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    sides = df.select(ROW_ID, one.alias("i"), none.alias("t"), none.alias("v")).unionByName(split_df.select(
        ROW_ID, none.alias("i"), F.when(F.col("split") == TRAIN, one).otherwise(none).alias("t"),
        F.when(F.col("split") == VALIDATION, one).otherwise(none).alias("v")))
    by_id = sides.groupBy(ROW_ID).agg(F.sum("i").alias("i"), F.sum("t").alias("t"), F.sum("v").alias("v"))
    spare = F.col("t") + F.col("v") - F.col("i")
    return by_id.agg(F.coalesce(F.sum(F.greatest(-spare, none)), none).alias("n_missing"),
                     F.coalesce(F.sum(F.greatest(spare, none)), none).alias("n_extra"),
                     F.count_if((F.col("t") > 0) & (F.col("v") > 0)).alias("n_overlap"))
