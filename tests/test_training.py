"""Training, scoring, model storage and streaming."""

import os

import pytest
from pyspark.sql import functions as F

from textloom.operators import labels as L
from textloom.plans import training as TR
from textloom.plans.scoring import score_top5
from textloom.session import work_path
from textloom.sources import tables as T
from textloom.streaming.scoring import score_stream


@pytest.fixture(scope="module")
def fitted(spark, sf001):
    prep = TR.prepare_training(T.labelled_documents(spark, sf001), 0.2, 42)
    train, val = TR.split_frames(prep)
    out = work_path(spark, "test_fit")
    fit = TR.fit_text_classifier(train, val, prep.dictionary, out, epochs=2, num_features=1 << 11,
                                 iters_per_epoch=6, seed=42)
    return prep, fit, out, val


def test_quality_bar(spark, fitted):
    prep, fit, out, val = fitted
    majority = val.groupBy("label").count().agg(F.max("count")).first()[0] / val.count()
    assert fit.best_accuracy > majority
    h = fit.history.orderBy("epoch").collect()
    assert [r["epoch"] for r in h] == [1, 2]
    assert all(0 <= r["val_acc"] <= 1 and r["val_loss"] > 0 for r in h)


def local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def test_artifacts_written(spark, fitted):
    prep, fit, out, val = fitted
    for name in ("best", "checkpoint-epoch-1", "classification_report", "detailed_metrics",
                 "confusion_matrix", "training_history"):
        assert os.path.exists(os.path.join(local(out), name)), name
    report = [r[0] for r in spark.read.text(os.path.join(out, "classification_report")).collect()]
    assert report[0].startswith("Best Epoch: ") and report[1].startswith("Validation Accuracy: ")
    hist = spark.read.json(os.path.join(out, "training_history")).first()
    assert len(hist["val_acc"]) == fit.history.count()


def test_load_and_resume(spark, fitted):
    prep, fit, out, val = fitted
    model, dictionary = TR.load_model(spark, os.path.join(out, "best"))
    assert sorted(r["label"] for r in dictionary.collect()) == sorted(r["label"] for r in prep.dictionary.collect())
    a = TR.score_rows(model, val).select("row_id", "y_pred")
    assert a.count() == val.count()
    train, _ = TR.split_frames(prep)
    out2 = work_path(spark, "test_resume")
    fit2 = TR.fit_text_classifier(train, val, prep.dictionary, out2, epochs=1, num_features=1 << 11,
                                  iters_per_epoch=2, resume_from=os.path.join(out, "best"), seed=42)
    assert fit2.best_accuracy >= fit.best_accuracy - 0.05


def test_top5_shape(spark, fitted):
    prep, fit, out, val = fitted
    t = score_top5(fit.model, val, prep.dictionary)
    n_classes = prep.dictionary.count()
    per_row = t.groupBy("row_id").agg(F.count(F.lit(1)).alias("k"), F.sum("probability").alias("p"))
    assert per_row.where(F.col("k") != min(5, n_classes)).count() == 0
    assert per_row.where(F.col("p") > 1 + 1e-9).count() == 0
    assert t.where(F.col("class").isNull()).count() == 0


def test_stream_equals_batch(spark, fitted, sf001):
    prep, fit, out, val = fitted
    src = work_path(spark, "test_stream_in")
    rows = val.select("row_id", "summary")
    blank = spark.createDataFrame([(10**9, "　 ")], "row_id bigint, summary string")
    rows.unionByName(blank).repartition(3).write.parquet(src)
    sink, ckpt = work_path(spark, "test_stream_out"), work_path(spark, "test_stream_ckpt")
    q = score_stream(spark, fit.model, prep.dictionary, src, sink, ckpt)
    q.awaitTermination()
    streamed = spark.read.parquet(sink).select("row_id", "rank", "code")
    batch = score_top5(fit.model, rows, prep.dictionary).select("row_id", "rank", "code")
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
    assert streamed.where(F.col("row_id") == 10**9).count() == 0


def test_run_training_and_score_texts(spark, sf0001):
    from textloom.plans.scoring import score_texts
    out = work_path(spark, "run_training")
    fit = TR.run_training(spark, f"{sf0001}/documents.parquet", out, fmt="parquet", text_col="text",
                          label_col="lang", row_id_col="doc_id", test_size=0.2, seed=42, epochs=1,
                          num_features=1 << 10, iters_per_epoch=3)
    cfg = spark.read.json(os.path.join(out, "training_config")).first()
    stats = spark.read.json(os.path.join(out, "training_stats")).collect()
    assert [r["epoch"] for r in stats] == [1]
    mapping = L.read_label_dict(spark, os.path.join(out, "label_mapping"), "map")
    assert sorted(r["label"] for r in mapping.collect()) == ["de", "en", "es", "fr"]
    assert cfg["train_samples"] + cfg["val_samples"] == 200 and cfg["num_labels"] == 4
    assert cfg["best_epoch"] == fit.best_epoch == 1
    scored = score_texts(spark, os.path.join(out, "best"), f"{sf0001}/documents.parquet",
                         work_path(spark, "scored"), text_col="text", row_id_col="doc_id")
    res = spark.read.parquet(scored)
    assert res.select("row_id").distinct().count() == 200 and res.where("rank > 4").count() == 0


def test_registered_fit_has_full_width(spark, monkeypatch):
    from textloom.checks import training as C
    from textloom.plans import training as plans

    asked = {}
    monkeypatch.setattr(C, "_FITS", {})
    monkeypatch.setattr(C, "labelled_documents", lambda *a: None)
    monkeypatch.setattr(plans, "prepare_training", lambda *a: plans.Prepared(None, None))
    monkeypatch.setattr(plans, "split_frames", lambda prep: (None, None))
    monkeypatch.setattr(plans, "fit_text_classifier", lambda *a, **k: asked.update(k))
    C._fit(spark, "none")
    assert asked["num_features"] == plans.NUM_FEATURES and asked["iters_per_epoch"] == plans.ITERS_PER_EPOCH
