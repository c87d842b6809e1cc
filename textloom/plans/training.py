"""Training data preparation, training, evaluation and model storage
(SURVEY M6, M7, M8, S11; uses W3-W7, A11-A16, J3, M4).

The reference fine-tunes a transformer on GPUs; its weights are not
available, so training is re-aimed at a softmax layer over hashed basic tokens
(P15), trained by synchronous distributed steps (``operators.softmax``). An
epoch passes over all training rows once, in ``iters_per_epoch`` global
batches; warm-up, clipping, weight decay and gradient accumulation are
step rules, and the epoch history, best-model saving, periodic checkpoints,
early stopping and resume keep their meaning.
"""

from __future__ import annotations

import json
import os
import time
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.scores import argmax, row_cross_entropy, softmax
from textloom.functions.text import strip_text
from textloom.operators import history as H
from textloom.operators import labels as L
from textloom.operators import metrics as MT
from textloom.operators import softmax as SM
from textloom.operators.clean import drop_blank_text, drop_null_rows
from textloom.operators.encode import MAX_LENGTH, VOCAB_SIZE, build_vocab, encode_fixed_length
from textloom.operators.split import TRAIN, VALIDATION, assign_batches, stratified_split
from textloom.plans.evaluation import evaluation_report, write_classification_report, write_confusion, \
    write_metrics_json
from textloom.session import cut_lineage, local_table, work_path
from textloom.sources.corpus import LABEL, ROW_ID, TEXT

# ---------------------------------------------------------------------------
# Fixed values (defaults of the reference's trainers, v2 unless noted)
# ---------------------------------------------------------------------------
TEST_SIZE, SEED = 0.1, 41
BATCH_SIZE = 64
EPOCHS = 15
PATIENCE, MIN_DELTA = 3, 0.001
CHECKPOINT_EVERY = 1
# ---------------------------------------------------------------------------
NUM_FEATURES = 1 << 14
ITERS_PER_EPOCH = 10      # global batches of an epoch


class Prepared(NamedTuple):
    data: DataFrame         # row_id, summary, label, code, split
    dictionary: DataFrame   # code, label


def prepare_training(df: DataFrame, test_size: float = TEST_SIZE, seed: int = SEED,
                     materialize: bool = True) -> Prepared:
    """M6: drop nulls and blank texts, strip the texts, build the
    dictionary, encode labels, split exactly by class. The result is written
    once, in one folder a split, so each later step (vocabulary, features, both
    splits) reads only its files."""
    clean = drop_blank_text(drop_null_rows(df)).withColumn(TEXT, strip_text(F.col(TEXT)))
    dictionary = L.label_dictionary(clean, materialize=materialize)
    coded = L.encode_labels(clean, dictionary)
    split = stratified_split(coded, test_size, seed, materialize=materialize)
    if materialize:
        path = work_path(df.sparkSession, "prepared")
        split = read_by_split(df.sparkSession, write_by_split(split, path), split.schema)
    return Prepared(split, dictionary)


def write_by_split(df: DataFrame, path: str) -> str:
    """M6: a table with a ``split`` column as Parquet, a folder a split."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)
    return path


def read_by_split(spark: SparkSession, path: str, schema=None, split: str | None = None) -> DataFrame:
    """M6: the table back; with ``split`` only that folder's files are listed."""
    reader = spark.read.option("basePath", path)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path if split is None else os.path.join(path, f"split={split}"))


def encoded_examples(prepared: Prepared, vocab_size: int = VOCAB_SIZE, max_length: int = MAX_LENGTH,
                     path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """M6 + A17 + M4: ``row_id, code, input_ids, attention_mask, split`` of every
    prepared row, with the vocabulary built on the training split only; with
    ``path`` written there in one folder a split."""
    vocab = build_vocab(prepared.data.where(F.col("split") == TRAIN), vocab_size)
    enc = encode_fixed_length(prepared.data, vocab, max_length, keep=(ROW_ID, "code", "split"))
    enc = enc.select(ROW_ID, "code", "input_ids", "attention_mask", "split")
    if path is not None:
        spark = enc.sparkSession
        enc = read_by_split(spark, write_by_split(enc, path), enc.schema)
    return enc, vocab


def score_rows(model: SM.Softmax, df: DataFrame, text_col: str = TEXT) -> DataFrame:
    """Model output as arrays: ``logits``, ``probs``, ``y_pred``; from the
    text, or from ``idx, val`` of a featurized table."""
    spark = df.sparkSession
    if "idx" in df.columns:
        z = SM.logits(model, spark, F.col("idx"), F.col("val"))
    else:
        z = SM.logits(model, spark, SM.token_buckets(F.col(text_col), model.num_features, model.max_length))
    return df.withColumn("logits", z).withColumns({"probs": softmax("logits"), "y_pred": argmax("logits")})


def summarize_pairs(pairs: DataFrame, batch_size: int = BATCH_SIZE, shuffle: bool = False,
                    epoch: int = 1, seed: int = SEED) -> DataFrame:
    """Batch-mean loss (W6 batches, A15) and accuracy (A14) of rows
    ``row_id, y_true, y_pred, loss``: one summary row."""
    loss = MT.batch_mean_loss(assign_batches(pairs, batch_size, seed=seed, epoch=epoch, shuffle=shuffle))
    return loss.select("mean_loss", "n_batches").withColumn("accuracy", MT.accuracy(pairs).scalar())


def summarize_scored(scored: DataFrame, batch_size: int = BATCH_SIZE, shuffle: bool = False,
                     epoch: int = 1, seed: int = SEED) -> DataFrame:
    """``summarize_pairs`` of scored rows (``row_id, code, y_pred, logits``),
    with P13 a row."""
    rows = scored.select(ROW_ID, F.col("code").alias("y_true"), "y_pred", row_cross_entropy("logits", "code").alias("loss"))
    return summarize_pairs(rows, batch_size, shuffle, epoch, seed)


def evaluate(model, df: DataFrame, batch_size: int = BATCH_SIZE,
             shuffle: bool = False, epoch: int = 1, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """M8: predictions, per-row loss, batch-mean loss and accuracy over texts
    or a featurized table. Returns (pairs, one-row summary)."""
    scored = score_rows(model, df)
    pairs = scored.select(ROW_ID, F.col("code").alias("y_true"), "y_pred",
                          row_cross_entropy("logits", "code").alias("loss"))
    return pairs, summarize_pairs(pairs, batch_size, shuffle, epoch, seed)


class Fitted(NamedTuple):
    model: SM.Softmax
    history: DataFrame      # epoch, train_loss, train_acc, val_loss, val_acc
    best_epoch: int
    best_accuracy: float
    stopped_at: int | None


def save_model(model: SM.Softmax, path: str, dictionary: DataFrame, params: dict | None = None) -> str:
    """The model (weights in blocks, a row a class and block, and its
    parameters), its class dictionary (list form, beside the model) and one row of
    run parameters."""
    spark = dictionary.sparkSession
    _write_text(spark, os.path.join(path, "manifest"), None)      # a full model replaces a pointer
    n_classes, width = model.weights.shape
    at = [(c, a) for c in range(n_classes) for a in range(0, width, SM.BLOCK)]
    spark.createDataFrame(pa.table({
        "code": pa.array([c for c, _ in at], pa.int32()), "first": pa.array([a for _, a in at], pa.int32()),
        "weights": pa.array([model.weights[c, a:a + SM.BLOCK] for c, a in at], pa.list_(pa.float64()))})) \
        .write.mode("overwrite").parquet(os.path.join(path, "model"))
    shape = {"n_classes": n_classes, "num_features": model.num_features, "max_length": model.max_length}
    _write_text(spark, os.path.join(path, "model_config"), json.dumps(shape, sort_keys=True))
    L.write_label_dict(dictionary, os.path.join(path, "label_encoder"), "list")
    if params is not None:
        _write_text(spark, os.path.join(path, "run_config"), json.dumps(params, sort_keys=True))
    return path


def point_best_to(spark: SparkSession, best_path: str, target: str, params: dict) -> str:
    """Mark an already saved checkpoint as the best model (a one-line
    manifest instead of a second copy of the same model)."""
    doc = json.dumps(dict(params, target=os.path.relpath(target, best_path)), sort_keys=True)
    _write_text(spark, os.path.join(best_path, "manifest"), doc)
    return best_path


def _write_text(spark: SparkSession, path: str, doc: str | None) -> None:
    """One-line text table; ``None`` writes an empty one over an existing."""
    rows = [] if doc is None else [(doc,)]
    local_table(spark, rows, "value STRING").write.mode("overwrite").text(path)


def _resolve(spark: SparkSession, path: str) -> str:
    """The folder a non-empty manifest points at (relative to ``path``)."""
    try:
        doc = spark.read.text(os.path.join(path, "manifest")).first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return path
    return os.path.normpath(os.path.join(path, json.loads(doc[0])["target"])) if doc else path


def load_model(spark: SparkSession, path: str) -> tuple[SM.Softmax, DataFrame]:
    """Load a model folder written by ``save_model`` (or a best-model
    manifest pointing at one)."""
    path = _resolve(spark, path)
    shape = json.loads(spark.read.text(os.path.join(path, "model_config")).first()[0])
    weights = np.zeros((shape["n_classes"], shape["num_features"] + 1))
    blocks = spark.read.parquet(os.path.join(path, "model")).toArrow()
    for code, first, block in zip(blocks["code"].to_pylist(), blocks["first"].to_pylist(), blocks["weights"], strict=True):
        weights[code, first:first + len(block)] = block.values.to_numpy()
    return SM.Softmax(weights, shape["max_length"]), L.read_label_dict(spark, os.path.join(path, "label_encoder"), "list")


def fit_text_classifier(train: DataFrame, val: DataFrame, dictionary: DataFrame, out_dir: str,
                        epochs: int = EPOCHS, patience: int = PATIENCE, min_delta: float = MIN_DELTA,
                        batch_size: int = BATCH_SIZE, checkpoint_every: int = CHECKPOINT_EVERY,
                        num_features: int = NUM_FEATURES, iters_per_epoch: int = ITERS_PER_EPOCH,
                        resume_from: str | None = None, seed: int = SEED, log=None,
                        max_length: int | None = None, rules: SM.Rules | None = None) -> Fitted:
    """M7: epoch loop with validation, history, best model (strictly higher
    validation accuracy, from 0), periodic checkpoints and early stopping
    (``min_delta`` gain within ``patience`` epochs).

    Texts are tokenised and hashed once into feature tables in the shared
    folder, the training rows in one folder a global batch; an epoch reads each
    once. Its training loss and accuracy are those its steps met. ``rules`` are
    the step rules (rate, warm-up, clipping, decay, accumulation); ``resume_from``
    takes up a saved model's weights. Rows with a null code are not for training."""
    spark = train.sparkSession
    n_classes = dictionary.count()
    say = log or (lambda *_: None)
    t0 = time.time()
    train_path, val_path = work_path(spark, "train-features"), work_path(spark, "val-features")
    train_f = SM.featurize(train, num_features, train_path, iters_per_epoch, seed, max_length=max_length)
    val_f = SM.featurize(val, num_features, val_path, max_length=max_length)
    weights = None
    if resume_from:
        weights = load_model(spark, resume_from)[0].weights
    trainer = SM.Trainer(train_f, train_path, n_classes, num_features, epochs, rules, weights, seed)
    say("featurize", time.time() - t0)
    rows, best_acc, best_epoch, stopped, model = [], 0.0, 0, None, None
    for epoch in range(1, epochs + 1):
        t0 = time.time()
        train_loss, train_acc = trainer.epoch(epoch)
        model = SM.Softmax(trainer.weights, max_length)
        say("fit", time.time() - t0)
        t0 = time.time()
        # narrow (id, codes, loss): the summary and the report both read it
        pairs = cut_lineage(score_rows(model, val_f).select(
            ROW_ID, F.col("code").alias("y_true"), "y_pred", row_cross_entropy("logits", "code").alias("loss")))
        v = summarize_pairs(pairs, batch_size).first()
        say("evaluate", time.time() - t0)
        rows.append((epoch, train_loss, train_acc, float(v["mean_loss"]), float(v["accuracy"])))
        t0 = time.time()
        ckpt = os.path.join(out_dir, f"checkpoint-epoch-{epoch}")
        if epoch % checkpoint_every == 0:                 # F6 rule
            save_model(model, ckpt, dictionary)
        if v["accuracy"] > best_acc:                      # W4 rule
            best_acc, best_epoch = float(v["accuracy"]), epoch
            params = {"epoch": epoch, "val_acc": best_acc, "num_features": num_features}
            if epoch % checkpoint_every == 0:
                point_best_to(spark, os.path.join(out_dir, "best"), ckpt, params)
            else:
                save_model(model, os.path.join(out_dir, "best"), dictionary, params)
            ev = evaluation_report(pairs, dictionary)
            write_classification_report(ev.per_class, os.path.join(out_dir, "classification_report"),
                                        epoch, best_acc)
            write_metrics_json(ev.per_class, os.path.join(out_dir, "detailed_metrics"))
            write_confusion(ev.confusion, os.path.join(out_dir, "confusion_matrix"), wide=True)
        say("save", time.time() - t0)
        hist = local_table(spark, [(r[0], r[4]) for r in rows], "epoch INT, score DOUBLE") \
            .withColumn("run", F.lit("fit"))
        stop = H.early_stopping(hist, patience, min_delta).first()["stop_epoch"]   # W5 rule
        if stop is not None:
            stopped = int(stop)
            break
    history = local_table(
        spark, rows, "epoch INT, train_loss DOUBLE, train_acc DOUBLE, val_loss DOUBLE, val_acc DOUBLE")
    metrics = ["train_loss", "train_acc", "val_loss", "val_acc"]
    H.write_history(history.withColumn("run", F.lit("fit")), os.path.join(out_dir, "training_history"),
                    metrics, form="columns")                           # one array per metric (v2)
    H.write_history(history, os.path.join(out_dir, "training_stats"), metrics, form="rows")  # per epoch (v0)
    return Fitted(model, history, best_epoch, best_acc, stopped)


def split_frames(prepared: Prepared) -> tuple[DataFrame, DataFrame]:
    d = prepared.data
    return d.where(F.col("split") == TRAIN), d.where(F.col("split") == VALIDATION)


__all__ = ["prepare_training", "encoded_examples", "fit_text_classifier", "run_training", "evaluate",
           "summarize_scored", "save_model", "load_model", "point_best_to", "score_rows", "split_frames"]


def run_training(spark: SparkSession, input_path: str, out_dir: str, fmt: str = "csv",
                 text_col: str = TEXT, label_col: str = LABEL, row_id_col: str | None = None,
                 test_size: float = TEST_SIZE, seed: int = SEED, **fit_args) -> Fitted:
    """M6 + M7 end to end: read the cleaned corpus, prepare, train, and
    write the run configuration (parameters, class count, split sizes,
    best accuracy) as one JSON row beside the models."""
    from textloom.sources.corpus import normalize_na, read_corpus
    raw = normalize_na(read_corpus(spark, input_path, fmt, text_col, label_col, row_id_col))
    prep = prepare_training(raw, test_size, seed)
    train, val = split_frames(prep)
    fitted = fit_text_classifier(train, val, prep.dictionary, out_dir, seed=seed, **fit_args)
    L.write_label_dict(prep.dictionary, os.path.join(out_dir, "label_mapping"), "map")
    sizes = {r["split"]: r["n"] for r in prep.data.groupBy("split").count().withColumnRenamed("count", "n").collect()}
    config = dict(fit_args, test_size=test_size, seed=seed, num_labels=prep.dictionary.count(),
                  train_samples=sizes.get(TRAIN, 0), val_samples=sizes.get(VALIDATION, 0),
                  best_accuracy=fitted.best_accuracy, best_epoch=fitted.best_epoch,
                  stopped_at=fitted.stopped_at)
    local_table(spark, [(json.dumps(config, sort_keys=True),)], "value STRING") \
        .write.mode("overwrite").text(os.path.join(out_dir, "training_config"))
    return fitted
