"""

Each run is rebuilt as a synthetic corpus with the recorded structure:
kept classes (each >= 100 rows) summing to the output, deleted classes
(each < 100) summing to the rare-removed rows, and the derived null rows.
All seven summary numbers of the report must come out as recorded.
"""

import pytest
from pyspark.sql import functions as F

from textloom.plans.cleaning import clean_corpus

# (input, output, rare removed, classes before, kept, deleted, null rows),
RECORDED = {
    "run1": (120651, 119961, 686, 110, 83, 27, 4),
    "run2": (120651, 119965, 686, 110, 83, 27, 0),
    "run3": (120651, 116274, 4373, 355, 193, 162, 4),
    "run4": (120651, 116278, 4373, 355, 193, 162, 0),
}


def split_evenly(total, parts):
    base, extra = divmod(total, parts)
    return [base + (1 if i < extra else 0) for i in range(parts)]


@pytest.mark.parametrize("run", sorted(RECORDED))
def test_recorded_run(spark, run):
    n_in, n_out, n_rare, c_before, c_kept, c_del, n_null = RECORDED[run]
    kept = split_evenly(n_out, c_kept)
    rare = split_evenly(n_rare, c_del)
    assert min(kept) >= 100 and max(rare) < 100
    classes = [(f"k{i}", n) for i, n in enumerate(kept)] + [(f"d{i}", n) for i, n in enumerate(rare)]
    spec = spark.createDataFrame(classes, "label string, n int")
    rows = spec.select("label", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("i")).select(
        F.monotonically_increasing_id().alias("row_id"), F.lit("text").alias("summary"), "label")
    nulls = spark.range(n_null).select((F.col("id") + 10**9).alias("row_id"),
                                       F.lit(None).cast("string").alias("summary"), F.lit("k0").alias("label"))
    res = clean_corpus(rows.unionByName(nulls), min_samples=100)
    st = res.stats.first()
    got = (st["n_input"], st["n_output"], st["n_rare_dropped"], st["n_classes_before"],
           st["n_classes_after"], st["n_classes_deleted"], st["n_null_dropped"])
    assert got == (n_in, n_out, n_rare, c_before, c_kept, c_del, n_null)
    assert res.corpus.count() == n_out
