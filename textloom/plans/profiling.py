"""Length profile job."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.operators import profile as P
from textloom.session import cut_lineage
from textloom.sources.corpus import TEXT


class Profile(NamedTuple):
    lens: DataFrame          # row_id, len
    freq: DataFrame          # len, n
    summary: DataFrame       # A4
    percentiles: DataFrame   # A5
    recommend: DataFrame     # A6
    coverage: DataFrame      # A7
    truncation: DataFrame    # A8
    distribution: DataFrame  # A9 + J7
    histogram: DataFrame     # A10
    cdf: DataFrame           # W2
    shortest: DataFrame      # T3
    longest: DataFrame       # T4


def profile_lengths(df: DataFrame, text_col: str = TEXT, materialize: bool = True) -> Profile:
    """M3: tokenise once, then every statistic from the row table or the
    frequency table. With ``materialize`` the row table and the frequency
    table are checkpointed to the shared folder, so tokenisation runs once
    and the later jobs restart from there after an executor loss."""
    lens = P.length_table(df, text_col)
    if materialize:
        lens = cut_lineage(lens)
    freq = P.length_frequencies(lens)
    if materialize:
        freq = cut_lineage(freq)
    corpus = df.select(F.col("row_id"), F.col(text_col))
    return Profile(
        lens=lens, freq=freq,
        summary=P.length_summary(lens, freq),
        percentiles=P.length_percentiles(freq),
        recommend=P.recommend_max_length(freq),
        coverage=P.length_coverage(freq),
        truncation=P.truncation_loss(freq),
        distribution=P.length_distribution(freq),
        histogram=P.length_histogram(freq),
        cdf=P.length_cdf(freq),
        shortest=P.shortest_k(lens, text_col=text_col, corpus=corpus),
        longest=P.longest_k(lens, text_col=text_col, corpus=corpus),
    )


def profile_metrics(p: Profile) -> DataFrame:
    """One long table ``metric, key, value`` with the numeric profile."""
    s = p.summary
    summary = s.select(F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.lit("").alias("key"), F.col(c).cast("double").alias("value"))
        for m, c in (("n", "n"), ("min", "min_len"), ("max", "max_len"), ("mean", "mean_len"),
                     ("median", "median_len"), ("std", "std_len"))
    ])).alias("r")).select("r.*")
    pct = p.percentiles.select(F.lit("percentile").alias("metric"), F.col("p").cast("string").alias("key"),
                               F.col("value").cast("double").alias("value"))
    cov = p.coverage.select(F.lit("coverage_pct").alias("metric"), F.col("limit").cast("string").alias("key"),
                            F.col("coverage_pct").alias("value"))
    trn = p.coverage.select(F.lit("n_truncated").alias("metric"), F.col("limit").cast("string").alias("key"),
                            F.col("n_truncated").cast("double").alias("value"))
    loss = p.truncation.select(F.lit("mean_loss").alias("metric"), F.col("limit").cast("string").alias("key"),
                               F.col("mean_loss").alias("value"))
    return summary.unionByName(pct).unionByName(cov).unionByName(trn).unionByName(loss)
