"""Token-length profile operators.

Plan shape: texts are tokenised once into a ``(row_id, len)`` table and
collapsed into a frequency table ``(len, n)`` whose size is the number of
distinct lengths (bounded by the longest text, not by the row count).
Percentiles, bins, histogram, CDF, coverage and truncation all run on
that small table with frequency weights; only the summary moments and the
top-k extremes touch the row table (both are partial aggregates).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.functions.scores import LENGTH_BIN_LABELS, length_bin_ord
from textloom.functions.text import (
    N_SPECIAL_TOKENS, basic_tokens, text_preview, to_text, token_count, token_preview,
)
from textloom.session import local_table
from textloom.sources.corpus import ROW_ID, TEXT

# ---------------------------------------------------------------------------
# Fixed values (defaults of the reference's profiler)
# ---------------------------------------------------------------------------
PERCENTILES = (50, 75, 80, 85, 90, 95, 99)
RECOMMEND_PERCENTILES = (90, 95, 99)
COMMON_LIMITS = (64, 128, 192, 256, 384, 512)
HISTOGRAM_BINS = 50
EXTREME_K = 3
CLS_TOKEN, SEP_TOKEN = "[CLS]", "[SEP]"
# ---------------------------------------------------------------------------

LEN = "len"


def length_table(df: DataFrame, text_col: str = TEXT, keep_text: bool = False) -> DataFrame:
    """P3 + P15 + P17 per row: ``row_id, len`` (and the text when asked).
    A null text is measured as the text ``nan``, as the reference's string
    cast does."""
    text = to_text(F.col(text_col), "literal_nan")
    cols = [F.col(ROW_ID), (token_count(text) + F.lit(N_SPECIAL_TOKENS)).alias(LEN)]
    if keep_text:
        cols.insert(1, F.col(text_col).alias(TEXT))
    return df.select(*cols)


def length_frequencies(lens: DataFrame) -> DataFrame:
    """``len, n``: one row per distinct length (partial aggregate first)."""
    return lens.groupBy(LEN).agg(F.count(F.lit(1)).alias("n"))


def length_summary(lens: DataFrame, freq: DataFrame | None = None) -> DataFrame:
    """A4: n, min, max, mean, median and sample standard deviation.

    Moments come from the row table (mergeable partial aggregates); the
    exact median comes from the frequency table when given.
    """
    moments = lens.agg(
        F.count(F.lit(1)).alias("n"),
        F.min(LEN).alias("min_len"),
        F.max(LEN).alias("max_len"),
        F.avg(LEN).alias("mean_len"),
        F.stddev_samp(LEN).alias("std_len"),
        *([] if freq is not None else [F.percentile(LEN, 0.5).alias("median_len")]),
    )
    if freq is None:
        return moments
    med = freq.agg(F.percentile(LEN, 0.5, F.col("n"))).scalar()
    return moments.withColumn("median_len", med)


def length_percentiles(freq: DataFrame, percentiles=PERCENTILES) -> DataFrame:
    """A5: exact linear-interpolation percentiles ``p, value``."""
    fracs = [p / 100.0 for p in percentiles]
    arr = freq.agg(F.percentile(LEN, fracs, F.col("n")).alias("v"))
    return (arr.select(F.posexplode("v").alias("i", "value"))
            .select(F.element_at(F.array(*[F.lit(p) for p in percentiles]), F.col("i") + 1).alias("p"),
                    F.col("value")))


def recommend_max_length(freq: DataFrame, percentiles=RECOMMEND_PERCENTILES) -> DataFrame:
    """Percentiles truncated to int as candidate maximum lengths."""
    return (length_percentiles(freq, percentiles)
            .select("p", F.col("value").cast("int").alias("max_length")))


def _limits(spark: SparkSession, limits) -> DataFrame:
    return local_table(spark, [(int(x),) for x in limits], "limit INT")


def length_coverage(freq: DataFrame, limits=COMMON_LIMITS) -> DataFrame:
    """Per limit, % of rows within it and rows that would be truncated.

    One pass over the frequency table with conditional sums, then ``stack``.
    """
    aggs = [F.sum("n").alias("total")]
    for L in limits:
        aggs.append(F.sum(F.when(F.col(LEN) <= L, F.col("n")).otherwise(0)).alias(f"in_{L}"))
    wide = freq.agg(*aggs)
    stacked = ", ".join(f"{L}, in_{L}" for L in limits)
    return wide.selectExpr(f"stack({len(limits)}, {stacked}) AS (limit, n_within)", "total").select(
        F.col("limit").cast("int").alias("limit"),
        (F.col("n_within") / F.col("total") * 100).alias("coverage_pct"),
        (F.col("total") - F.col("n_within")).cast("bigint").alias("n_truncated"),
    )


def coverage_by_limit(freq: DataFrame, limits=COMMON_LIMITS) -> DataFrame:
    """The same coverage through a theta join of the (small) limits
    dimension with the frequency table on ``len > limit``."""
    lim = F.broadcast(_limits(freq.sparkSession, limits))
    every = Window.partitionBy()                 # over distinct lengths only, in the same pass
    held = freq.select(LEN, "n", F.sum("n").over(every).alias("total"),
                       F.col(LEN).eqNullSafe(F.min(LEN).over(every)).alias("least"))
    # the least length meets every limit and brings the total along
    over = (lim.join(held, (held[LEN] > lim["limit"]) | held["least"], "left")
            .groupBy("limit").agg(F.coalesce(F.sum(F.when(F.col(LEN) > F.col("limit"), F.col("n"))), F.lit(0)).alias("n_truncated"),
                                  F.max("total").alias("total")))
    return over.select("limit", ((F.col("total") - F.col("n_truncated")) / F.col("total") * 100).alias("coverage_pct"),
                       F.col("n_truncated").cast("bigint").alias("n_truncated"))


def truncation_loss(freq: DataFrame, limits=COMMON_LIMITS) -> DataFrame:
    """Per limit, mean and max tokens lost among truncated rows
    (both null when nothing is truncated)."""
    aggs = []
    for L in limits:
        over = F.col(LEN) > L
        aggs += [
            F.sum(F.when(over, (F.col(LEN) - L) * F.col("n"))).alias(f"s_{L}"),
            F.sum(F.when(over, F.col("n"))).alias(f"c_{L}"),
            F.max(F.when(over, F.col(LEN) - L)).alias(f"m_{L}"),
        ]
    wide = freq.agg(*aggs)
    stacked = ", ".join(f"{L}, s_{L}, c_{L}, m_{L}" for L in limits)
    return wide.selectExpr(f"stack({len(limits)}, {stacked}) AS (limit, s, c, m)").select(
        F.col("limit").cast("int").alias("limit"),
        (F.col("s") / F.col("c")).alias("mean_loss"),
        F.col("m").cast("int").alias("max_loss"),
    )


def length_bins(spark: SparkSession) -> DataFrame:
    """The 8-row bin dimension ``bin_ord, bin``."""
    return local_table(spark, list(enumerate(LENGTH_BIN_LABELS, start=1)), "bin_ord INT, bin STRING")


def length_distribution(freq: DataFrame) -> DataFrame:
    """A9 + J7: rows and % per bin in bin order; empty bins kept (left join
    from the bin dimension).

    Bins and total come from one aggregate without keys: a filter on a bin
    would be pushed below ``freq`` and measure every text again for each of its
    comparisons, and a total of its own would be another pass.
    """
    at = length_bin_ord(LEN)
    sums = [F.sum(F.when(at == i, F.col("n"))).alias(f"n_{i}") for i in range(1, len(LENGTH_BIN_LABELS) + 1)]
    wide = freq.agg(F.sum("n").alias("total"), *sums)
    stacked = ", ".join(f"{i}, n_{i}" for i in range(1, len(LENGTH_BIN_LABELS) + 1))
    per_bin = wide.selectExpr(f"stack({len(LENGTH_BIN_LABELS)}, {stacked}) AS (bin_ord, n)", "total")
    n = F.coalesce(F.col("n"), F.lit(0))
    return (F.broadcast(length_bins(freq.sparkSession)).join(per_bin, "bin_ord", "left")
            .select("bin_ord", "bin", n.cast("bigint").alias("n"), (n / F.col("total") * 100).alias("pct"))
            .orderBy("bin_ord"))


def length_histogram(freq: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """A10: equal-width histogram over [min, max] (last bin closed); a
    constant column uses [v - 0.5, v + 0.5]. Empty bins are kept."""
    spark = freq.sparkSession
    every = Window.partitionBy()                 # over distinct lengths only, in the same pass
    lo0, hi0 = F.min(LEN).over(every), F.max(LEN).over(every)
    lo = F.when(lo0 == hi0, lo0 - 0.5).otherwise(lo0).cast("double")
    hi = F.when(lo0 == hi0, hi0 + 0.5).otherwise(hi0).cast("double")
    ranged = freq.select(LEN, "n", lo.alias("lo"), hi.alias("hi"))
    lo, hi = F.col("lo"), F.col("hi")
    idx = F.least(F.floor((F.col(LEN) - lo) * bins / (hi - lo)), F.lit(bins - 1)).cast("int")
    counts = ranged.groupBy(idx.alias("bin")).agg(F.sum("n").alias("n"), F.max("lo").alias("lo"), F.max("hi").alias("hi"))
    lo, hi = F.max("lo").over(every), F.max("hi").over(every)
    ids = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    step = (hi - lo) / bins
    return (ids.join(counts, "bin", "left")
            .select("bin", (lo + F.col("bin") * step).alias("lo_edge"),
                    (lo + (F.col("bin") + 1) * step).alias("hi_edge"),
                    F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n")))


def length_cdf(freq: DataFrame) -> DataFrame:
    """Empirical cumulative % per distinct length (window over the
    frequency table, never over raw rows)."""
    w = Window.orderBy(LEN).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tot = Window.partitionBy()
    return freq.select(
        LEN, "n",
        F.sum("n").over(w).alias("cum_n"),
        (F.sum("n").over(w) / F.sum("n").over(tot) * 100).alias("cum_pct"),
    )


def over_length(lens: DataFrame, limit: int) -> DataFrame:
    """rows that would be truncated at ``limit``."""
    return lens.where(F.col(LEN) > limit)


def _extremes(lens: DataFrame, order, k: int, text_col: str,
              corpus: DataFrame | None, ellipsis: bool) -> DataFrame:
    top = lens.orderBy(*order).limit(k)          # TakeOrderedAndProject
    if text_col not in lens.columns:
        # k is a parameter, so k ids and lengths are a bounded side; the texts
        # come from one pass over two columns, when the result is run
        top = F.broadcast(top.select(ROW_ID, LEN)).join(corpus.select(ROW_ID, text_col), ROW_ID)
    w = Window.orderBy(*order)                   # over k rows only
    # the preview shows the encoded sequence, special tokens included
    toks = F.concat(F.array(F.lit(CLS_TOKEN)), basic_tokens(F.col(text_col)), F.array(F.lit(SEP_TOKEN)))
    return top.select(
        F.row_number().over(w).alias("rank"), ROW_ID, LEN,
        text_preview(F.col(text_col), ellipsis=ellipsis).alias("text_preview"),
        token_preview(toks).alias("token_preview"),
    )


def shortest_k(lens: DataFrame, k: int = EXTREME_K, text_col: str = TEXT,
               corpus: DataFrame | None = None) -> DataFrame:
    """K shortest texts, ties by row id. ``lens`` either carries the text
    or the texts are fetched from ``corpus`` by id."""
    return _extremes(lens, [F.col(LEN), F.col(ROW_ID)], k, text_col, corpus, ellipsis=False)


def longest_k(lens: DataFrame, k: int = EXTREME_K, text_col: str = TEXT,
              corpus: DataFrame | None = None) -> DataFrame:
    """T4: k longest texts, ties by row id; the text preview ends in ``...``."""
    return _extremes(lens, [F.desc(LEN), F.col(ROW_ID)], k, text_col, corpus, ellipsis=True)
