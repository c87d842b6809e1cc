"""Expected values of the derived fixtures (FIXTURES.md section 3) at sf0.01."""

import pytest
from pyspark.sql import functions as F

from textloom.functions import first_label
from textloom.operators import history as H
from textloom.operators import metrics as MT
from textloom.operators import profile as P
from textloom.operators import split as SP
from textloom.plans.cleaning import clean_corpus
from textloom.sources import tables as T


def test_f_corpus(spark, sf001):
    raw = T.corpus_from_documents(spark, sf001)
    assert raw.count() == 1000
    assert raw.where(F.col("summary").isNull()).count() == 20
    assert raw.where(F.col("label").isNull()).count() == 25
    assert raw.where(F.col("summary").isNull() | F.col("label").isNull()).count() == 44
    t = T.rare_threshold(1000)
    assert t == 120
    res = clean_corpus(raw, t)
    counts = {r["label"]: r["n"] for r in res.counts.collect()}
    assert counts == {"en": 592, "fr": 139, "de": 123, "es": 102}
    st = res.stats.first()
    assert (st["n_input"], st["n_null_dropped"], st["n_rare_dropped"], st["n_output"]) == (1000, 44, 102, 854)
    assert res.corpus.count() == 854
    deleted = [r["label"] for r in res.classes.where("section = 'deleted'").collect()]
    assert deleted == ["es"]


def test_f_split(spark, sf001):
    docs = T.labelled_documents(spark, sf001).select("row_id", "label")
    s = SP.stratified_split(docs, 0.2, 42)
    sizes = {r["split"]: r["n"] for r in SP.split_sizes(s).collect()}
    assert sizes == {"train": 800, "validation": 200}


def test_f_tokens(spark, sf001):
    docs = T.labelled_documents(spark, sf001)
    lens = P.length_table(docs)
    assert lens.agg(F.sum(F.col("len") - 2)).first()[0] == 497333
    chars = T.table(spark, sf001, "documents").select(F.col("n_chars").alias("len"))
    freq = P.length_frequencies(chars)
    pct = {r["p"]: r["value"] for r in P.length_percentiles(freq, (50, 90, 99)).collect()}
    assert pct[50] == pytest.approx(1475.5) and pct[90] == pytest.approx(5259.2)
    assert pct[99] == pytest.approx(13909.59)
    std = P.length_summary(chars, freq).first()["std_len"]
    assert std == pytest.approx(2943.140409, abs=1e-6)


def test_f_logits(spark, sf001):
    from textloom.functions import argmax, row_cross_entropy
    z = T.logits_from_embeddings(spark, sf001)
    s = z.select(argmax("logits").alias("y_pred"), "y_true", row_cross_entropy("logits", "y_true").alias("loss"))
    r = s.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("y_pred") == F.col("y_true")).cast("int")).alias("c"),
              F.avg("loss").alias("l")).first()
    import numpy as np
    import pyarrow.parquet as pq
    t = pq.read_table(f"{sf001}/embeddings.parquet").to_pandas()
    x, y = np.stack(t["embedding"]).astype(float), t["label"].to_numpy()
    assert x.shape[1] == 64
    loss = np.log(np.exp(x).sum(1)) - x[np.arange(len(x)), y]
    assert (r["n"], r["c"]) == (len(x), int((x.argmax(1) == y).sum()))
    assert r["l"] == pytest.approx(loss.mean(), abs=1e-6)


def test_f_pairs(spark, sf001):
    conf = {(r["y_true"], r["y_pred"]): r["n"] for r in MT.confusion_matrix(T.pairs_from_labels(spark, sf001)).collect()}
    assert conf == {(0, 0): 49, (0, 1): 9, (1, 0): 299, (1, 1): 42}


def test_f_history(spark, sf001):
    es = {r["run"]: (round(r["best_score"], 6), r["best_epoch"], r["stop_epoch"])
          for r in H.early_stopping(T.history_from_events(spark, sf001), 3, 0.001).collect()}
    assert es == {"click": (0.557144, 6, 9), "error": (0.516964, 4, 7), "purchase": (0.576135, 4, 7),
                  "signup": (0.568874, 1, 4), "view": (0.557914, 5, 8)}


def test_first_label_on_documents_is_lang(spark, sf001):
    raw = T.corpus_from_documents(spark, sf001).where(F.col("label").isNotNull())
    docs = T.table(spark, sf001, "documents").select(F.col("doc_id").alias("row_id"), "lang")
    bad = raw.join(docs, "row_id").where(first_label("label") != F.col("lang")).count()
    assert bad == 0


def test_two_stage_with_real_csv_round_trip(spark, sf001):
    from textloom.plans.cleaning import clean_corpus_two_stage
    from textloom.session import work_path
    raw = T.corpus_from_documents(spark, sf001)
    a = clean_corpus_two_stage(raw, 120)
    b = clean_corpus_two_stage(raw, 120, intermediate_path=work_path(spark, "stage1_csv"))
    cols = ["row_id", "summary", "label"]
    assert a.corpus.select(cols).exceptAll(b.corpus.select(cols)).count() == 0
    assert b.corpus.select(cols).exceptAll(a.corpus.select(cols)).count() == 0
    assert a.stats.first().asDict() == b.stats.first().asDict()
