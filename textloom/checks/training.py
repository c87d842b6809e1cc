"""Registered queries + oracles: vocabulary, encoding, training data,
training, scoring, model storage and streaming scoring."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from textloom.checks.sqlfrag import strip, tokens
from textloom.checks.splitting import SPLIT_SQL
from textloom.functions import basic_tokens
from textloom.operators import encode as EN
from textloom.operators import split as SP
from textloom.operators.clean import drop_blank_text
from textloom.plans import training as TR
from textloom.plans.scoring import score_top5
from textloom.session import work_path
from textloom.sources.tables import labelled_documents, table
from textloom.streaming.scoring import score_stream

QUERIES: dict = {}
ORACLES: dict = {}


def reg(key, sql=None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return deco


VOCAB_SIZE = EN.VOCAB_SIZE

def vocab_sql(docs: str) -> str:
    """Vocabulary of ``docs`` and the encoding of all documents by it."""
    return f"""toks AS (SELECT doc_id, {tokens('text')} AS t FROM documents),
cnt AS (SELECT token, count(*) AS n FROM (SELECT unnest(t) AS token FROM toks WHERE {docs}) GROUP BY token),
top AS (SELECT token, row_number() OVER (ORDER BY n DESC, token) AS r FROM cnt QUALIFY r <= {VOCAB_SIZE}),
vocab AS (SELECT token, CAST(CASE WHEN r < 100 THEN r ELSE r + 4 END AS INTEGER) AS id FROM top
  UNION ALL SELECT * FROM (VALUES ('[PAD]', 0), ('[UNK]', 100), ('[CLS]', 101), ('[SEP]', 102), ('[MASK]', 103))
  v(token, id)),
ex AS (SELECT doc_id, unnest(t) AS token, generate_subscripts(t, 1) AS pos FROM toks),
ids AS (SELECT d.doc_id AS row_id,
  coalesce(list(coalesce(v.id, 100) ORDER BY ex.pos) FILTER (WHERE ex.token IS NOT NULL), []) AS ids
  FROM documents d LEFT JOIN ex ON d.doc_id = ex.doc_id LEFT JOIN vocab v ON ex.token = v.token GROUP BY d.doc_id),
enc AS (SELECT row_id, list_concat([101], ids[1:126], [102], list_transform(range(126 - least(126, len(ids))), lambda x: 0)) AS input_ids,
  CAST(least(126, len(ids)) + 2 AS INTEGER) AS mask_sum FROM ids)"""


VOCAB_SQL = vocab_sql("TRUE")


def _vocab(spark, sf):
    docs = labelled_documents(spark, sf)
    return EN.build_vocab(docs, VOCAB_SIZE)


def _encoded(spark, sf):
    docs = labelled_documents(spark, sf)
    return EN.encode_fixed_length(docs, _vocab(spark, sf), 128)


@reg("build_vocab", f"WITH {VOCAB_SQL} SELECT token, id FROM vocab")
def q_build_vocab(spark, sf):
    return _vocab(spark, sf)


@reg("ids_by_vocab", f"WITH {VOCAB_SQL} SELECT row_id, array_to_string(ids, ' ') AS ids FROM ids")
def q_ids_by_vocab(spark, sf):
    docs = labelled_documents(spark, sf)
    ids = EN.ids_by_vocab(docs, _vocab(spark, sf), basic_tokens("summary"))
    return ids.select("row_id", F.array_join("ids", " ").alias("ids"))


@reg("encode_fixed_length", f"""WITH {VOCAB_SQL}
SELECT row_id, array_to_string(input_ids, ' ') AS input_ids, mask_sum, CAST(len(input_ids) AS INTEGER) AS n_ids FROM enc""")
def q_encode_fixed_length(spark, sf):
    e = _encoded(spark, sf)
    return e.select("row_id", F.array_join("input_ids", " ").alias("input_ids"),
                    F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("mask_sum"),
                    F.size("input_ids").alias("n_ids"))


@reg("decode_ids", f"""WITH {VOCAB_SQL},
ex2 AS (SELECT row_id, unnest(input_ids) AS id, generate_subscripts(input_ids, 1) AS pos FROM enc)
SELECT row_id, array_to_string(list(coalesce(v.token, '[UNK]') ORDER BY pos), ' ') AS tokens
FROM ex2 LEFT JOIN vocab v ON ex2.id = v.id GROUP BY row_id""")
def q_decode_ids(spark, sf):
    vocab = _vocab(spark, sf)
    d = EN.decode_ids(EN.encode_fixed_length(labelled_documents(spark, sf), vocab, 128), vocab)
    return d.select("row_id", F.array_join("tokens", " ").alias("tokens"))


@reg("prepare_training", f"""WITH {SPLIT_SQL.format(ts=0.2, seed=42)},
dict AS (SELECT CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS code, label
  FROM (SELECT DISTINCT label FROM docs))
SELECT s.row_id, s.label, dict.code, s.split FROM split s JOIN dict ON s.label = dict.label""")
def q_prepare_training(spark, sf):
    p = TR.prepare_training(labelled_documents(spark, sf), 0.2, 42)
    return p.data.select("row_id", "label", "code", "split")


@reg("encoded_examples", f"""WITH {SPLIT_SQL.format(ts=0.2, seed=42)},
dict AS (SELECT CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS code, label
  FROM (SELECT DISTINCT label FROM docs)),
{vocab_sql("doc_id IN (SELECT row_id FROM split WHERE split = 'train')")}
SELECT s.row_id, dict.code, s.split, array_to_string(enc.input_ids, ' ') AS input_ids, enc.mask_sum
FROM split s JOIN dict ON s.label = dict.label JOIN enc ON enc.row_id = s.row_id""")
def q_encoded_examples(spark, sf):
    """Both splits read back from their own folders."""
    prep = TR.prepare_training(labelled_documents(spark, sf), 0.2, 42)
    path = work_path(spark, "examples")
    enc, _ = TR.encoded_examples(prep, VOCAB_SIZE, 128, path)
    train, val = (TR.read_by_split(spark, path, enc.schema, s) for s in (SP.TRAIN, SP.VALIDATION))
    return train.unionByName(val).select(
        "row_id", "code", "split", F.array_join("input_ids", " ").alias("input_ids"),
        F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("mask_sum"))


# -- training, evaluation, scoring ----------------------------------------------
# A trained model's numbers are not SQL. The oracles state which rows come out
# and that each property, computed here from the model's output, holds.
EPOCHS = 5              # fixed value: the first trainer's epochs

VAL_SQL = f"""{SPLIT_SQL.format(ts=0.2, seed=42)},
dict AS (SELECT CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS code, label
  FROM (SELECT DISTINCT label FROM docs)),
val AS (SELECT s.row_id, dict.code FROM split s JOIN dict ON s.label = dict.label WHERE s.split = 'validation')"""
RANKS = "CAST(unnest(range(1, least(5, (SELECT count(*) FROM dict)) + 1)) AS INTEGER) AS rank"

_FITS: dict = {}


def _fit(spark, sf):
    key = (spark.sparkContext.applicationId, sf)
    if key not in _FITS:
        prep = TR.prepare_training(labelled_documents(spark, sf), 0.2, 42)
        train, val = TR.split_frames(prep)
        out = work_path(spark, "fit")
        fitted = TR.fit_text_classifier(train, val, prep.dictionary, out, epochs=EPOCHS, num_features=TR.NUM_FEATURES,
                                        iters_per_epoch=TR.ITERS_PER_EPOCH, seed=42)
        _FITS[key] = (prep, fitted, out, val)
    return _FITS[key]


@reg("fit_text_classifier", f"""WITH {VAL_SQL},
sizes AS (SELECT count(*) FILTER (WHERE split = 'train') AS n_train, count(*) FILTER (WHERE split = 'validation') AS n_val FROM split)
SELECT CAST(e AS INTEGER) AS epoch, n_train, n_val, CAST(ceil(n_train / {TR.BATCH_SIZE}) AS BIGINT) AS train_batches,
  CAST(ceil(n_val / {TR.BATCH_SIZE}) AS BIGINT) AS val_batches, TRUE AS finite, TRUE AS best_agrees
FROM (SELECT n_train, n_val, unnest(range(1, {EPOCHS} + 1)) AS e FROM sizes)""")
def q_fit_text_classifier(spark, sf):
    prep, fitted, _, _ = _fit(spark, sf)
    sizes = SP.batch_counts(prep.data, TR.BATCH_SIZE)
    parts = {f"{name}_{c}": sizes.where(F.col("split") == split).select(c)
             for name, split in (("train", SP.TRAIN), ("val", SP.VALIDATION)) for c in ("n", "n_batches")}
    best = fitted.history.select(F.min_by("epoch", F.struct(-F.col("val_acc"), F.col("epoch"))))
    finite = F.lit(True)
    for c in ("train_loss", "train_acc", "val_loss", "val_acc"):
        finite = finite & ~F.isnan(c) & (F.abs(c) < float("inf"))
    return fitted.history.select(
        "epoch", parts["train_n"].scalar().alias("n_train"), parts["val_n"].scalar().alias("n_val"),
        parts["train_n_batches"].scalar().alias("train_batches"), parts["val_n_batches"].scalar().alias("val_batches"),
        finite.alias("finite"), (best.scalar() == F.lit(fitted.best_epoch)).alias("best_agrees"))


@reg("evaluate", f"WITH {VAL_SQL} SELECT row_id, code AS y_true, TRUE AS loss_ok, TRUE AS argmax_ok FROM val")
def q_evaluate(spark, sf):
    _, fitted, _, val = _fit(spark, sf)
    pairs, _ = TR.evaluate(fitted.model, val.withColumn("label_idx", F.col("code").cast("double")))
    # against the model's own probabilities, where the logarithm still has its digits
    p = F.get("probs", F.col("y_true"))
    scored = TR.score_rows(fitted.model, val).select("row_id", "probs", "logits")
    return pairs.join(scored, "row_id").select(
        "row_id", "y_true",
        (~F.isnan("loss") & F.when(p > 1e-9, F.abs(F.col("loss") + F.log(p)) < 1e-5).otherwise(F.col("loss") > 20)).alias("loss_ok"),
        (F.get("logits", F.col("y_pred")) == F.array_max("logits")).alias("argmax_ok"))


def _rank_flags(ranked, dictionary):
    w = Window.partitionBy("row_id")
    named = dictionary.select("code", F.col("label").alias("class"), F.lit(True).alias("known"))
    return ranked.join(named, ["code", "class"], "left").withColumns({
        "descending": F.col("probability") <= F.coalesce(F.lag("probability").over(w.orderBy("rank")), F.lit(1.0)),
        "sum_ok": F.sum("probability").over(w) <= 1 + 1e-6,
        "known_class": F.coalesce("known", F.lit(False))})


@reg("score_top5", f"WITH {VAL_SQL} SELECT row_id, {RANKS}, TRUE AS descending, TRUE AS sum_ok, TRUE AS known_class FROM val")
def q_score_top5(spark, sf):
    prep, fitted, _, val = _fit(spark, sf)
    t = _rank_flags(score_top5(fitted.model, val, prep.dictionary), prep.dictionary)
    return t.select("row_id", "rank", "descending", "sum_ok", "known_class")


@reg("save_model", f"WITH {VAL_SQL} SELECT row_id, TRUE AS dictionary_ok, TRUE AS reload_agrees FROM val")
def q_save_model(spark, sf):
    """The last model, saved and loaded again, against the one in memory."""
    prep, fitted, _, val = _fit(spark, sf)
    path = TR.save_model(fitted.model, work_path(spark, "saved_model"), prep.dictionary)
    model, dictionary = TR.load_model(spark, path)
    held = TR.score_rows(fitted.model, val).select("row_id", "code", "label", F.col("probs").alias("held"))
    again = TR.score_rows(model, val).select("row_id", "probs")
    named = dictionary.select("code", F.col("label").alias("name"))
    return held.join(again, "row_id").join(named, "code", "left").select(
        "row_id", F.coalesce(F.col("name") == F.col("label"), F.lit(False)).alias("dictionary_ok"),
        (F.col("held") == F.col("probs")).alias("reload_agrees"))


@reg("score_stream", f"""WITH {VAL_SQL}
SELECT doc_id AS row_id, {RANKS}, TRUE AS descending, TRUE AS sum_ok, TRUE AS known_class, TRUE AS batch_agrees
FROM documents WHERE {strip('text')} <> ''""")
def q_score_stream(spark, sf):
    prep, fitted, _, _ = _fit(spark, sf)
    src = work_path(spark, "stream_in")
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("row_id"), F.col("text").alias("summary"))
    docs.repartition(4).write.parquet(src)
    sink, ckpt = work_path(spark, "stream_out"), work_path(spark, "stream_ckpt")
    q = score_stream(spark, fitted.model, prep.dictionary, src, sink, ckpt)
    q.awaitTermination()
    batch = score_top5(fitted.model, drop_blank_text(docs.where("summary is not null")), prep.dictionary).select(
        "row_id", "rank", F.col("code").alias("b_code"), F.col("probability").alias("b_probability"))
    t = _rank_flags(spark.read.parquet(sink), prep.dictionary).join(batch, ["row_id", "rank"], "left")
    agrees = (F.col("code") == F.col("b_code")) & (F.abs(F.col("probability") - F.col("b_probability")) < 1e-9)
    return t.select("row_id", "rank", "descending", "sum_ok", "known_class", F.coalesce(agrees, F.lit(False)).alias("batch_agrees"))


__all__ = ["QUERIES", "ORACLES"]
