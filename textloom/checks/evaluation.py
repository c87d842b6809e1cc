"""Registered queries + oracles: scores, metrics, top-k, epoch history."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from textloom.functions import argmax, row_cross_entropy, softmax
from textloom.operators import history as H
from textloom.operators import labels as L
from textloom.operators import metrics as MT
from textloom.plans import evaluation as EV
from textloom.session import work_path
from textloom.sources.reports import read_lines
from textloom.sources.tables import history_from_events, logits_from_embeddings, pairs_from_labels, table

QUERIES: dict = {}
ORACLES: dict = {}


def reg(key, sql=None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return deco


def r6(c):
    return F.round(c, 6)


# -- inputs ------------------------------------------------------------------
def _scored(spark, sf):
    z = logits_from_embeddings(spark, sf)
    return z.select("row_id", "logits", "y_true", argmax("logits").alias("y_pred"),
                    row_cross_entropy("logits", "y_true").alias("loss"), softmax("logits").alias("probs"))


def _class_dict(spark, sf):
    """Dictionary of the logits' classes: code = place, name ``class_<place>``."""
    d = table(spark, sf, "embeddings").select(F.posexplode("embedding")).select(
        F.concat(F.lit("class_"), F.lpad(F.col("pos").cast("string"), 3, "0")).alias("label"))
    return L.label_dictionary(d)


Z = """z AS (SELECT vec_id AS row_id, CAST(embedding AS DOUBLE[]) AS z, CAST(label AS INTEGER) AS y_true
  FROM embeddings),
zm AS (SELECT *, list_max(z) AS m, list_transform(z, lambda x: exp(x - list_max(z))) AS e FROM z),
s AS (SELECT row_id, y_true, CAST(list_position(z, m) - 1 AS INTEGER) AS y_pred,
  ln(list_sum(e)) + m - z[y_true + 1] AS loss,
  list_transform(e, lambda x: x / list_sum(e)) AS probs FROM zm)"""

CDICT = """cdict AS (SELECT CAST(row_number() OVER (ORDER BY name) - 1 AS INTEGER) AS code, name AS label
  FROM (SELECT DISTINCT 'class_' || lpad(CAST(i AS VARCHAR), 3, '0') AS name
    FROM (SELECT unnest(generate_series(0, len(embedding) - 1)) AS i FROM embeddings)))"""

PAIRS = "pairs AS (SELECT doc_id AS row_id, CAST(quality AS INTEGER) AS y_true, CAST(toxic AS INTEGER) AS y_pred FROM labels)"

LDICT = """ldict AS (SELECT CAST(row_number() OVER (ORDER BY lang) - 1 AS INTEGER) AS code, lang AS label
  FROM (SELECT DISTINCT lang FROM documents))"""


def per_class_sql(pairs: str, dict_: str) -> str:
    return f"""cells AS (SELECT y_true, y_pred, count(*) AS n FROM {pairs} GROUP BY ALL),
tot AS (SELECT code, sum(tp)::BIGINT AS tp, sum(sup)::BIGINT AS support, sum(pred)::BIGINT AS predicted FROM (
  SELECT y_true AS code, CASE WHEN y_true = y_pred THEN n ELSE 0 END AS tp, n AS sup, 0 AS pred FROM cells
  UNION ALL SELECT y_pred, 0, 0, n FROM cells) GROUP BY code),
pc AS (SELECT d.code, d.label, coalesce(t.tp, 0) AS tp, coalesce(t.support, 0) AS support,
  coalesce(t.predicted, 0) AS predicted FROM {dict_} d LEFT JOIN tot t ON d.code = t.code),
pcm AS (SELECT code, label,
  CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
  CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall,
  CASE WHEN support + predicted > 0 THEN 2 * tp / (support + predicted) ELSE 0.0 END AS f1_score,
  support, predicted, tp FROM pc)"""


def _per_class_out(df):
    return df.select("code", "label", r6("precision").alias("precision"), r6("recall").alias("recall"),
                     r6("f1_score").alias("f1_score"), "support", "predicted", "tp")


PER_CLASS_SELECT = """SELECT code, label, round(precision, 6) AS precision, round(recall, 6) AS recall,
  round(f1_score, 6) AS f1_score, support, predicted, tp FROM pcm"""


# -- scalar scores -------------------------------------------------------------
@reg("softmax", f"""WITH {Z}
SELECT row_id, round(list_sum(probs), 6) AS p_sum, round(list_max(probs), 6) AS p_max,
  round(probs[y_true + 1], 6) AS p_true FROM s""")
def q_softmax(spark, sf):
    s = _scored(spark, sf)
    p = F.col("probs")
    return s.select("row_id", r6(F.aggregate(p, F.lit(0.0), lambda a, x: a + x)).alias("p_sum"),
                    r6(F.array_max(p)).alias("p_max"), r6(F.element_at(p, F.col("y_true") + 1)).alias("p_true"))


@reg("argmax", f"WITH {Z} SELECT row_id, y_pred FROM s")
def q_argmax(spark, sf):
    return _scored(spark, sf).select("row_id", "y_pred")


@reg("row_cross_entropy", f"WITH {Z} SELECT row_id, round(loss, 6) AS loss FROM s")
def q_row_cross_entropy(spark, sf):
    return _scored(spark, sf).select("row_id", r6("loss").alias("loss"))


@reg("accuracy", f"WITH {Z} SELECT round(avg(CASE WHEN y_true = y_pred THEN 1 ELSE 0 END), 6) AS accuracy FROM s")
def q_accuracy(spark, sf):
    return MT.accuracy(_scored(spark, sf)).select(r6("accuracy").alias("accuracy"))


@reg("confusion_matrix", f"WITH {PAIRS} SELECT y_true, y_pred, count(*) AS n FROM pairs GROUP BY ALL")
def q_confusion_matrix(spark, sf):
    return MT.confusion_matrix(pairs_from_labels(spark, sf))


@reg("per_class_metrics", f"WITH {Z}, {CDICT}, {per_class_sql('s', 'cdict')} {PER_CLASS_SELECT}")
def q_per_class_metrics(spark, sf):
    conf = MT.confusion_matrix(_scored(spark, sf))
    return _per_class_out(MT.per_class_metrics(conf, _class_dict(spark, sf)))


@reg("align_metrics", f"WITH {PAIRS}, {LDICT}, {per_class_sql('pairs', 'ldict')} {PER_CLASS_SELECT}")
def q_align_metrics(spark, sf):
    d = L.label_dictionary(table(spark, sf, "documents").select(F.col("lang").alias("label")))
    conf = MT.confusion_matrix(pairs_from_labels(spark, sf))
    return _per_class_out(MT.per_class_metrics(conf, d))


OVERALL_SQL = """SELECT round(sum(tp) / sum(support), 6) AS accuracy,
  round(avg(precision) FILTER (WHERE support + predicted > 0), 6) AS macro_precision,
  round(sum(precision * support) / sum(support), 6) AS weighted_precision,
  round(avg(recall) FILTER (WHERE support + predicted > 0), 6) AS macro_recall,
  round(sum(recall * support) / sum(support), 6) AS weighted_recall,
  round(avg(f1_score) FILTER (WHERE support + predicted > 0), 6) AS macro_f1_score,
  round(sum(f1_score * support) / sum(support), 6) AS weighted_f1_score,
  sum(support)::BIGINT AS support FROM pcm"""


def _overall_out(df):
    cols = ["accuracy", "macro_precision", "weighted_precision", "macro_recall", "weighted_recall",
            "macro_f1_score", "weighted_f1_score"]
    return df.select(*[r6(c).alias(c) for c in cols], "support")


@reg("overall_metrics", f"WITH {Z}, {CDICT}, {per_class_sql('s', 'cdict')} {OVERALL_SQL}")
def q_overall_metrics(spark, sf):
    per = MT.per_class_metrics(MT.confusion_matrix(_scored(spark, sf)), _class_dict(spark, sf))
    return _overall_out(MT.overall_metrics(per))


REPORT_SQL = """SELECT 1 AS kind, CAST(code AS BIGINT) AS code, label AS name, round(precision, 6) AS precision,
  round(recall, 6) AS recall, round(f1_score, 6) AS f1_score, support FROM pcm
UNION ALL SELECT 2, NULL, 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 6), sum(support)::BIGINT FROM pcm
UNION ALL SELECT 3, NULL, 'macro avg', round(avg(precision) FILTER (WHERE support + predicted > 0), 6),
  round(avg(recall) FILTER (WHERE support + predicted > 0), 6),
  round(avg(f1_score) FILTER (WHERE support + predicted > 0), 6), sum(support)::BIGINT FROM pcm
UNION ALL SELECT 4, NULL, 'weighted avg', round(sum(precision * support) / sum(support), 6),
  round(sum(recall * support) / sum(support), 6), round(sum(f1_score * support) / sum(support), 6),
  sum(support)::BIGINT FROM pcm"""


def _report_out(df):
    return df.select("kind", "code", "name", r6("precision").alias("precision"), r6("recall").alias("recall"),
                     r6("f1_score").alias("f1_score"), "support")


@reg("evaluation_report", f"WITH {Z}, {CDICT}, {per_class_sql('s', 'cdict')} {REPORT_SQL}")
def q_evaluation_report(spark, sf):
    ev = EV.evaluation_report(_scored(spark, sf), _class_dict(spark, sf))
    return _report_out(EV.report_rows(ev.per_class))


@reg("write_classification_report", f"""WITH {Z}, {CDICT}, {per_class_sql('s', 'cdict')},
w AS (SELECT CAST(greatest(12, 4, max(length(label))) AS INTEGER) AS width FROM pcm),
o AS (SELECT sum(tp) / sum(support) AS acc, avg(precision) FILTER (WHERE support + predicted > 0) AS mp,
  avg(recall) FILTER (WHERE support + predicted > 0) AS mr, avg(f1_score) FILTER (WHERE support + predicted > 0) AS mf,
  sum(precision * support) / sum(support) AS wp, sum(recall * support) / sum(support) AS wr,
  sum(f1_score * support) / sum(support) AS wf, sum(support) AS n FROM pcm),
report AS (SELECT * FROM (
SELECT 0 AS block, 0 AS ord, 'Best Epoch: 3' AS line UNION ALL SELECT 0, 1, 'Validation Accuracy: 0.9120' UNION ALL SELECT 0, 2, ''
UNION ALL SELECT 1, 0,
  repeat(' ', width) || ' ' || ' precision    recall  f1-score   support'  FROM w
UNION ALL SELECT 1, 1, ''
UNION ALL SELECT 3, 0, ''
UNION ALL SELECT 2, code + 1, lpad(label, (SELECT width FROM w), ' ') || '  ' || printf('%9.4f', precision) || ' '
  || printf('%9.4f', recall) || ' ' || printf('%9.4f', f1_score) || ' ' || printf('%9d', support) FROM pcm
UNION ALL SELECT 4, 2, lpad('accuracy', (SELECT width FROM w), ' ') || ' ' || repeat(' ', 20) || ' ' || printf('%9.4f', acc) || ' '
  || printf('%9d', n) FROM o
UNION ALL SELECT 4, 3, lpad('macro avg', (SELECT width FROM w), ' ') || '  ' || printf('%9.4f', mp) || ' ' || printf('%9.4f', mr)
  || ' ' || printf('%9.4f', mf) || ' ' || printf('%9d', n) FROM o
UNION ALL SELECT 4, 4, lpad('weighted avg', (SELECT width FROM w), ' ') || '  ' || printf('%9.4f', wp) || ' ' || printf('%9.4f', wr)
  || ' ' || printf('%9.4f', wf) || ' ' || printf('%9d', n) FROM o))
SELECT row_number() OVER (ORDER BY block, ord) AS line_no, line FROM report""")
def q_write_classification_report(spark, sf):
    """Lines as the written file holds them, with the header of a best epoch."""
    ev = EV.evaluation_report(_scored(spark, sf), _class_dict(spark, sf))
    return read_lines(spark, EV.write_classification_report(ev.per_class, work_path(spark, "classification_report"), 3, 0.912))


@reg("write_metrics_json", f"""WITH {Z}, {CDICT}, {per_class_sql('s', 'cdict')},
o AS (SELECT sum(tp) / sum(support) AS acc, avg(precision) FILTER (WHERE support + predicted > 0) AS mp,
  avg(recall) FILTER (WHERE support + predicted > 0) AS mr, avg(f1_score) FILTER (WHERE support + predicted > 0) AS mf,
  sum(precision * support) / sum(support) AS wp, sum(recall * support) / sum(support) AS wr,
  sum(f1_score * support) / sum(support) AS wf FROM pcm)
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1_score, 6) AS f1_score,
  CAST(support AS INTEGER) AS support, round(acc, 6) AS accuracy, round(mp, 6) AS macro_precision, round(mr, 6) AS macro_recall,
  round(mf, 6) AS macro_f1, round(wp, 6) AS weighted_precision, round(wr, 6) AS weighted_recall, round(wf, 6) AS weighted_f1
FROM pcm, o""")
def q_write_metrics_json(spark, sf):
    """Classes and all averages as the written document holds them."""
    ev = EV.evaluation_report(_scored(spark, sf), _class_dict(spark, sf))
    path = EV.write_metrics_json(ev.per_class, work_path(spark, "metrics_json"))
    mean = "struct<precision: double, recall: double, f1_score: double>"
    schema = ("struct<per_class: map<string, struct<precision: double, recall: double, f1_score: double, "
              f"support: int>>, overall: struct<accuracy: double, macro_avg: {mean}, weighted_avg: {mean}>>")
    doc = spark.read.text(path).select(F.from_json("value", schema).alias("d"))
    averages = [r6(f"o.{avg}_avg.{key}").alias(f"{avg}_{name}") for avg in ("macro", "weighted")
                for key, name in (("precision", "precision"), ("recall", "recall"), ("f1_score", "f1"))]
    return (doc.select(F.explode("d.per_class").alias("label", "m"), F.col("d.overall").alias("o"))
            .select("label", r6("m.precision").alias("precision"), r6("m.recall").alias("recall"),
                    r6("m.f1_score").alias("f1_score"), F.col("m.support").alias("support"),
                    r6("o.accuracy").alias("accuracy"), *averages))


@reg("write_confusion", f"WITH {Z} SELECT y_true, y_pred, count(*) AS n FROM s GROUP BY ALL")
def q_write_confusion(spark, sf):
    conf = MT.confusion_matrix(_scored(spark, sf))
    return spark.read.parquet(EV.write_confusion(conf, work_path(spark, "confusion")))


@reg("write_confusion_wide", f"""WITH {Z}, {CDICT}
SELECT a.code AS y_true, b.code AS y_pred, count(s.row_id) AS n FROM cdict a JOIN cdict b ON TRUE
LEFT JOIN s ON s.y_true = a.code AND s.y_pred = b.code GROUP BY ALL""")
def q_write_confusion_wide(spark, sf):
    """All cells of the square matrix, read back from its column blocks."""
    conf = MT.confusion_matrix(_scored(spark, sf))
    path = EV.write_confusion(conf, work_path(spark, "confusion_wide"), wide=True, dictionary=_class_dict(spark, sf))
    return EV.read_confusion_wide(spark, path)


@reg("batch_mean_loss", f"""WITH {Z},
b AS (SELECT *, (row_number() OVER (ORDER BY row_id) - 1) AS pos FROM s),
r AS (SELECT pos // 64 AS batch, (pos % 64) // 16 AS replica, avg(loss) AS loss FROM b GROUP BY ALL),
bl AS (SELECT batch, avg(loss) AS batch_loss FROM r GROUP BY batch)
SELECT round(avg(batch_loss), 6) AS mean_loss, count(*) AS n_batches FROM bl""")
def q_batch_mean_loss(spark, sf):
    from textloom.operators.split import assign_batches
    b = assign_batches(_scored(spark, sf), 64, shuffle=False)
    b = b.withColumn("replica", F.floor((F.col("pos") % 64) / 16))
    out = MT.batch_mean_loss(b, replica_col="replica")
    return out.select(r6("mean_loss").alias("mean_loss"), "n_batches")


@reg("topk_classes", f"""WITH {Z}, {CDICT},
u AS (SELECT row_id, unnest(probs) AS p, CAST(generate_subscripts(probs, 1) - 1 AS INTEGER) AS code FROM s),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY row_id ORDER BY p DESC, code) AS INTEGER) AS rank FROM u)
SELECT r.row_id, r.rank, r.code, round(r.p, 6) AS probability, round(r.p * 100, 6) AS percentage, d.label AS class
FROM r LEFT JOIN cdict d ON r.code = d.code WHERE r.rank <= 5""")
def q_topk_classes(spark, sf):
    t = MT.topk_classes(_scored(spark, sf), "probs", 5, _class_dict(spark, sf))
    return t.select("row_id", "rank", "code", r6("probability").alias("probability"),
                    r6("percentage").alias("percentage"), "class")


# -- epoch history -----------------------------------------------------------------
HIST = """hist AS (SELECT event_type AS run, CAST(day(ts) AS INTEGER) AS epoch, round(avg(value) / 100, 6) AS score
  FROM events GROUP BY ALL)"""


@reg("best_so_far", f"""WITH {HIST}
SELECT run, epoch, score, max(bar) OVER w AS prev_best, score > max(bar) OVER w AS is_best
FROM (SELECT *, greatest(0.0, lag(score) OVER (PARTITION BY run ORDER BY epoch)) AS bar FROM hist)
WINDOW w AS (PARTITION BY run ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def q_best_so_far(spark, sf):
    return H.best_so_far(history_from_events(spark, sf))


@reg("early_stopping", f"""WITH RECURSIVE {HIST},
h AS (SELECT run, epoch, score, row_number() OVER (PARTITION BY run ORDER BY epoch) AS i FROM hist),
es(run, i, best, best_epoch, counter, stop_epoch) AS (
  SELECT run, i, score, epoch, 0, CAST(NULL AS INTEGER) FROM h WHERE i = 1
  UNION ALL
  SELECT h.run, h.i,
    CASE WHEN es.stop_epoch IS NULL AND h.score > es.best + 0.001 THEN h.score ELSE es.best END,
    CASE WHEN es.stop_epoch IS NULL AND h.score > es.best + 0.001 THEN h.epoch ELSE es.best_epoch END,
    CASE WHEN es.stop_epoch IS NOT NULL THEN es.counter WHEN h.score > es.best + 0.001 THEN 0 ELSE es.counter + 1 END,
    CASE WHEN es.stop_epoch IS NOT NULL THEN es.stop_epoch
         WHEN NOT (h.score > es.best + 0.001) AND es.counter + 1 >= 3 THEN h.epoch END
  FROM es JOIN h ON h.run = es.run AND h.i = es.i + 1)
SELECT es.run, es.best AS best_score, CAST(es.best_epoch AS INTEGER) AS best_epoch,
  CAST(es.stop_epoch AS INTEGER) AS stop_epoch
FROM es JOIN (SELECT run, max(i) AS i FROM h GROUP BY run) last ON es.run = last.run AND es.i = last.i""")
def q_early_stopping(spark, sf):
    return H.early_stopping(history_from_events(spark, sf), patience=3, min_delta=0.001)


W3_SQL = f"""WITH {Z},
b AS (SELECT *, (row_number() OVER (ORDER BY row_id) - 1) // 64 AS batch FROM s),
per AS (SELECT batch, count(*) AS n, sum(CASE WHEN y_true = y_pred THEN 1 ELSE 0 END)::BIGINT AS n_correct,
  avg(loss) AS batch_loss FROM b GROUP BY batch)
SELECT 'eval' AS run, 1 AS epoch, batch, n, n_correct, round(batch_loss, 6) AS batch_loss,
  round(sum(n_correct) OVER (ORDER BY batch) / sum(n) OVER (ORDER BY batch), 6) AS running_acc FROM per"""


def _w3(spark, sf):
    from textloom.operators.split import assign_batches
    b = assign_batches(_scored(spark, sf), 64, shuffle=False)
    rows = b.select(F.lit("eval").alias("run"), F.lit(1).alias("epoch"), "batch",
                    (F.col("y_true") == F.col("y_pred")).alias("correct"), "loss")
    return H.running_train_metrics(rows)


@reg("running_train_metrics", W3_SQL)
def q_running_train_metrics(spark, sf):
    return _w3(spark, sf).select("run", "epoch", "batch", "n", "n_correct", r6("batch_loss").alias("batch_loss"),
                                 r6("running_acc").alias("running_acc"))


@reg("every_nth", f"WITH {HIST} SELECT run, epoch, score FROM hist WHERE epoch % 7 = 0")
def q_every_nth(spark, sf):
    return H.every_nth(history_from_events(spark, sf), 7, col="epoch", one_based=True)


@reg("write_history", f"""WITH {HIST}
SELECT run, CAST(row_number() OVER (PARTITION BY run ORDER BY epoch) - 1 AS INTEGER) AS pos, score FROM hist""")
def q_write_history(spark, sf):
    hist = history_from_events(spark, sf)
    H.write_history(hist, work_path(spark, "history_rows"), ["score"], form="rows")
    path = H.write_history(hist, work_path(spark, "history_cols"), ["score"], form="columns")
    back = spark.read.schema("run string, score array<double>").json(path)
    return back.select("run", F.posexplode("score").alias("pos", "score"))


__all__ = ["QUERIES", "ORACLES", "Window"]


@reg("confusion_wide", f"""WITH {Z}, {CDICT}
SELECT code AS y_true, {", ".join(f'CAST(sum(CASE WHEN y_pred = {i} THEN 1 ELSE 0 END) AS BIGINT) AS "{i}"' for i in range(64))}
FROM cdict LEFT JOIN s ON s.y_true = cdict.code GROUP BY code""")
def q_confusion_wide(spark, sf):
    conf = MT.confusion_matrix(_scored(spark, sf))
    return MT.confusion_wide(conf, _class_dict(spark, sf))
