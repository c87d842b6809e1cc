"""Registered queries + oracles: label dictionary, encoding, split, batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.functions import argmax
from textloom.operators import labels as L
from textloom.operators import split as SP
from textloom.session import work_path
from textloom.sources.tables import labelled_documents, logits_from_embeddings, table

QUERIES: dict = {}
ORACLES: dict = {}


def reg(key, sql=None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return deco


def _source_dict(spark, sf):
    d = table(spark, sf, "documents").select(F.col("source").alias("label"))
    return L.label_dictionary(d)


DICT_SQL = """dict AS (SELECT CAST(row_number() OVER (ORDER BY source) - 1 AS INTEGER) AS code, source AS label
  FROM (SELECT DISTINCT source FROM documents))"""


@reg("label_dictionary", f"WITH {DICT_SQL} SELECT code, label FROM dict")
def q_label_dictionary(spark, sf):
    return _source_dict(spark, sf)


@reg("encode_labels", f"""WITH {DICT_SQL}
SELECT d.doc_id AS row_id, d.source AS label, dict.code FROM documents d JOIN dict ON d.source = dict.label""")
def q_encode_labels(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("row_id"), F.col("source").alias("label"))
    return L.encode_labels(docs, _source_dict(spark, sf))


@reg("decode_labels", f"""WITH {DICT_SQL},
z AS (SELECT vec_id AS row_id, CAST(list_position(e, list_max(e)) - 1 AS INTEGER) AS code
      FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings))
SELECT z.row_id, z.code, dict.label FROM z LEFT JOIN dict ON z.code = dict.code""")
def q_decode_labels(spark, sf):
    z = logits_from_embeddings(spark, sf).select("row_id", argmax("logits").alias("code"))
    return L.decode_labels(z, _source_dict(spark, sf))


@reg("write_label_dict", f"WITH {DICT_SQL} SELECT code, label, code AS code_list FROM dict")
def q_write_label_dict(spark, sf):
    d = _source_dict(spark, sf)
    pm = L.write_label_dict(d, work_path(spark, "label_map"), "map")
    pl = L.write_label_dict(d, work_path(spark, "label_list"), "list")
    back_map = L.read_label_dict(spark, pm, "map")
    back_list = L.read_label_dict(spark, pl, "list").select(F.col("code").alias("code_list"), "label")
    return back_map.join(back_list, "label", "full")


SPLIT_SQL = """docs AS (SELECT doc_id AS row_id, lang AS label FROM documents),
counts AS (SELECT label, count(*) AS n FROM docs GROUP BY label),
tot AS (SELECT sum(n)::BIGINT AS n_total, (sum(n) - ceil(CAST({ts} AS DOUBLE) * sum(n)))::BIGINT AS n_train FROM counts),
base AS (SELECT label, n, (n * (SELECT n_train FROM tot)) // (SELECT n_total FROM tot) AS q_floor,
  (n * (SELECT n_train FROM tot)) % (SELECT n_total FROM tot) AS rem, (SELECT n_train FROM tot) AS n_train FROM counts),
seats AS (SELECT max(n_train) - sum(q_floor) AS seats FROM base),
q AS (SELECT label, q_floor + CASE WHEN row_number() OVER (ORDER BY rem DESC, label) <= (SELECT seats FROM seats)
      THEN 1 ELSE 0 END AS quota FROM base),
split AS (SELECT d.row_id, d.label,
  CASE WHEN row_number() OVER (PARTITION BY d.label ORDER BY md5('{seed}|' || d.row_id), d.row_id) <= q.quota
       THEN 'train' ELSE 'validation' END AS split
  FROM docs d JOIN q ON d.label = q.label)"""


def _split(spark, sf, test_size=0.2, seed=42, rows_per_bucket=SP.ROWS_PER_BUCKET):
    return SP.stratified_split(labelled_documents(spark, sf).select("row_id", "label"), test_size, seed,
                               rows_per_bucket=rows_per_bucket)


@reg("stratified_split", f"WITH {SPLIT_SQL.format(ts=0.2, seed=42)} SELECT row_id, label, split FROM split")
def q_stratified_split(spark, sf):
    return _split(spark, sf)


@reg("stratified_split_bucketed", f"WITH {SPLIT_SQL.format(ts=0.1, seed=41)} SELECT row_id, label, split FROM split")
def q_stratified_split_bucketed(spark, sf):
    # Same operator with small buckets: every class is cut into many
    # hash-range buckets, exercising the skew-safe path on the whole table.
    return _split(spark, sf, 0.1, 41, rows_per_bucket=37)


@reg("split_sizes", f"""WITH {SPLIT_SQL.format(ts=0.2, seed=42)}
SELECT split, label, count(*) AS n FROM split GROUP BY split, label""")
def q_split_sizes(spark, sf):
    return SP.split_sizes(_split(spark, sf), by_label=True)


@reg("batch_counts", f"""WITH {SPLIT_SQL.format(ts=0.2, seed=42)}
SELECT split, count(*) AS n, CAST(ceil(count(*) / 64) AS BIGINT) AS n_batches FROM split GROUP BY split""")
def q_batch_counts(spark, sf):
    return SP.batch_counts(_split(spark, sf), 64)


@reg("split_is_partition", f"""WITH {SPLIT_SQL.format(ts=0.2, seed=42)}
SELECT (SELECT count(*) FROM docs WHERE row_id NOT IN (SELECT row_id FROM split)) AS n_missing,
  (SELECT count(*) - count(DISTINCT row_id) FROM split) AS n_extra,
  (SELECT count(*) FROM (SELECT row_id FROM split WHERE split = 'train'
                         INTERSECT SELECT row_id FROM split WHERE split = 'validation')) AS n_overlap""")
def q_split_is_partition(spark, sf):
    docs = labelled_documents(spark, sf).select("row_id", "label")
    return SP.split_is_partition(docs, _split(spark, sf))


@reg("assign_batches", """SELECT doc_id AS row_id, lang AS label,
  row_number() OVER (ORDER BY md5('42|1|' || doc_id), doc_id) - 1 AS pos,
  (row_number() OVER (ORDER BY md5('42|1|' || doc_id), doc_id) - 1) // 64 AS batch FROM documents""")
def q_assign_batches(spark, sf):
    docs = labelled_documents(spark, sf).select("row_id", "label")
    return SP.assign_batches(docs, 64, seed=42, epoch=1, shuffle=True, rows_per_bucket=97)


@reg("assign_batches_ordered", """SELECT doc_id AS row_id, lang AS label,
  row_number() OVER (ORDER BY doc_id) - 1 AS pos, (row_number() OVER (ORDER BY doc_id) - 1) // 64 AS batch
FROM documents""")
def q_assign_batches_ordered(spark, sf):
    docs = labelled_documents(spark, sf).select("row_id", "label")
    return SP.assign_batches(docs, 64, shuffle=False, rows_per_bucket=97)


__all__ = ["QUERIES", "ORACLES"]
