"""Invariants on the driver tables at sf0.01."""

import pytest
from pyspark.sql import functions as F

from textloom.functions import argmax, softmax
from textloom.operators import encode as EN
from textloom.operators import labels as L
from textloom.operators import metrics as MT
from textloom.operators import profile as P
from textloom.operators import split as SP
from textloom.sources import tables as T


@pytest.fixture(scope="module")
def docs(spark, sf001):
    return T.labelled_documents(spark, sf001)


def test_split_is_partition_and_quotas(spark, docs):
    s = SP.stratified_split(docs.select("row_id", "label"), 0.2, 7, rows_per_bucket=50)
    chk = SP.split_is_partition(docs, s).first()
    assert (chk["n_missing"], chk["n_extra"], chk["n_overlap"]) == (0, 0, 0)
    per = SP.split_sizes(s, by_label=True).groupBy("label").pivot("split", ["train", "validation"]).sum("n").collect()
    n_train = sum(r["train"] for r in per)
    n = n_train + sum(r["validation"] for r in per)
    for r in per:
        exact = (r["train"] + r["validation"]) * n_train / n
        assert abs(r["train"] - exact) < 1


def test_bucketed_split_equals_single_bucket(spark, docs):
    d = docs.select("row_id", "label")
    a = SP.stratified_split(d, 0.3, 5).select("row_id", "split")
    b = SP.stratified_split(d, 0.3, 5, rows_per_bucket=13).select("row_id", "split")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_batches_cover_positions(spark, docs):
    b = SP.assign_batches(docs.select("row_id"), 64, seed=3, epoch=2, rows_per_bucket=111)
    r = b.agg(F.min("pos"), F.max("pos"), F.countDistinct("pos"), F.max("batch")).first()
    assert tuple(r) == (0, 999, 1000, 15)


def test_coverage_and_cdf(spark, docs):
    freq = P.length_frequencies(P.length_table(docs))
    for r in P.length_coverage(freq).collect():
        within = r["coverage_pct"] * 1000 / 100
        assert round(within) + r["n_truncated"] == 1000
    last = P.length_cdf(freq).orderBy(F.desc("len")).first()
    assert last["cum_pct"] == pytest.approx(100.0) and last["cum_n"] == 1000
    dist = P.length_distribution(freq).agg(F.sum("n")).first()[0]
    hist = P.length_histogram(freq).agg(F.sum("n")).first()[0]
    assert dist == 1000 and hist == 1000


def test_metrics_consistency(spark, sf001):
    z = T.logits_from_embeddings(spark, sf001)
    s = z.select("row_id", "y_true", argmax("logits").alias("y_pred"), softmax("logits").alias("p"))
    assert s.where(F.abs(F.aggregate("p", F.lit(0.0), lambda a, x: a + x) - 1) > 1e-9).count() == 0
    conf = MT.confusion_matrix(s)
    per = MT.per_class_metrics(conf)
    ov = MT.overall_metrics(per).first()
    assert conf.agg(F.sum("n")).first()[0] == ov["support"] == 500
    assert ov["weighted_recall"] == pytest.approx(ov["accuracy"])


def test_encoding_shapes(spark, docs):
    vocab = EN.build_vocab(docs, 300)
    enc = EN.encode_fixed_length(docs, vocab, 64)
    lens = P.length_table(docs)
    j = enc.join(lens, "row_id").select(
        F.size("input_ids").alias("n"), F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("m"),
        F.least(F.col("len"), F.lit(64)).alias("want"))
    assert j.where((F.col("n") != 64) | (F.col("m") != F.col("want"))).count() == 0
    ids = vocab.where(F.col("token").startswith("[") & F.col("token").endswith("]")).collect()
    assert sorted(r["id"] for r in ids if r["token"].isupper()) == [0, 100, 101, 102, 103]
    assert vocab.count() == 305 and vocab.select("id").distinct().count() == 305


def test_encode_decode_labels(spark, docs):
    d = L.label_dictionary(docs)
    enc = L.encode_labels(docs, d)
    back = L.decode_labels(enc.drop("label"), d)
    assert back.join(docs.select("row_id", F.col("label").alias("orig")), "row_id") \
        .where(F.col("label") != F.col("orig")).count() == 0


def test_ordered_batches_with_sparse_ids(spark):
    # ids shaped like monotonically_increasing_id (partition index << 33): very sparse
    df = spark.range(3000).select(((F.col("id") % 7) * (1 << 33) + F.col("id")).alias("row_id"))
    b = SP.assign_batches(df, 64, shuffle=False, rows_per_bucket=100)
    got = [r["row_id"] for r in b.orderBy("pos").collect()]
    assert got == sorted(got) and b.agg(F.max("pos")).first()[0] == 2999
    assert b.agg(F.max("batch")).first()[0] == 2999 // 64
