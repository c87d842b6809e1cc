"""Registered queries + oracles: scans, label projections, cleaning (M1, M2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.checks.sqlfrag import CORPUS, THRESHOLD, first_label, first_label_ascii, q, strip
from textloom.functions import first_label as fl
from textloom.functions import first_label_ascii as fla
from textloom.functions import keep_flag, strip_text, to_text
from textloom.operators import clean as C
from textloom.plans.cleaning import clean_corpus, clean_corpus_two_stage
from textloom.session import work_path
from textloom.sources import corpus as S
from textloom.sources.reports import read_lines, write_stats_report
from textloom.sources.tables import corpus_from_documents, rare_threshold, table

QUERIES: dict = {}
ORACLES: dict = {}


def reg(key, sql=None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return deco


def _threshold(spark, sf):
    return rare_threshold(table(spark, sf, "documents").count())


def _m1(spark, sf):
    return clean_corpus(corpus_from_documents(spark, sf), _threshold(spark, sf))


def _m2(spark, sf):
    return clean_corpus_two_stage(corpus_from_documents(spark, sf), _threshold(spark, sf))


PREPARED = f"""WITH {CORPUS},
prepared AS (SELECT row_id, summary, {first_label('label')} AS label, source FROM corpus),
counts AS (SELECT label, count(*) AS n FROM prepared
           WHERE summary IS NOT NULL AND label IS NOT NULL GROUP BY label)"""

PREPARED_OLD = f"""WITH {CORPUS},
stage1 AS (SELECT row_id, summary, {first_label_ascii('label', literal_nan=True)} AS label, source FROM corpus),
prepared AS (SELECT row_id,
    CASE WHEN summary IN ('', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND',
      '1.#QNAN', '<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null') THEN NULL ELSE summary END AS summary,
    CASE WHEN label IN ('', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND',
      '1.#QNAN', '<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null') THEN NULL ELSE label END AS label,
    source FROM stage1),
counts AS (SELECT label, count(*) AS n FROM prepared
           WHERE summary IS NOT NULL AND label IS NOT NULL GROUP BY label)"""


# -- M1 flagship and its audit tables ---------------------------------------
@reg("clean_corpus", f"""{PREPARED}
SELECT p.row_id, p.summary, p.label, p.source FROM prepared p JOIN counts c ON p.label = c.label
WHERE p.summary IS NOT NULL AND c.n >= {THRESHOLD}""")
def q_clean_corpus(spark, sf):
    return _m1(spark, sf).corpus


STATS_SQL = """SELECT
  (SELECT count(*) FROM prepared) AS n_input,
  (SELECT count(*) FROM prepared WHERE summary IS NULL OR label IS NULL) AS n_null_dropped,
  (SELECT count(*) FROM prepared WHERE summary IS NOT NULL AND label IS NOT NULL) AS n_after_null,
  coalesce((SELECT sum(n) FROM counts WHERE n < {t}), 0)::BIGINT AS n_rare_dropped,
  coalesce((SELECT sum(n) FROM counts WHERE n >= {t}), 0)::BIGINT AS n_output,
  (SELECT count(*) FROM counts) AS n_classes_before,
  (SELECT count(*) FROM counts WHERE n >= {t}) AS n_classes_after,
  (SELECT count(*) FROM counts WHERE n < {t}) AS n_classes_deleted,
  {t}::BIGINT AS min_samples""".format(t=THRESHOLD)


@reg("cleaning_stats", f"{PREPARED}\n{STATS_SQL}")
def q_cleaning_stats(spark, sf):
    return _m1(spark, sf).stats


CLASSES_SQL = f"""SELECT label, n,
  CASE WHEN n >= {THRESHOLD} THEN 'kept' ELSE 'deleted' END AS section,
  CASE WHEN n >= {THRESHOLD} THEN '保留' ELSE '删除' END AS status,
  row_number() OVER (PARTITION BY n >= {THRESHOLD} ORDER BY n DESC, label)::INTEGER AS rank
FROM counts"""


@reg("cleaning_classes", f"{PREPARED}\n{CLASSES_SQL}")
def q_cleaning_classes(spark, sf):
    return _m1(spark, sf).classes


@reg("label_rank", f"{PREPARED}\n{CLASSES_SQL}")
def q_label_rank(spark, sf):
    counts = _m1(spark, sf).counts
    t = _threshold(spark, sf)
    sec = F.when(F.col("n") >= t, "kept").otherwise("deleted")
    return C.label_rank(counts.withColumn("section", sec).withColumn("status", keep_flag("n", t)), "section")


@reg("keep_flag", f"""{PREPARED}
SELECT label, n, CASE WHEN n >= {THRESHOLD} THEN '保留' ELSE '删除' END AS status FROM counts""")
def q_keep_flag(spark, sf):
    t = _threshold(spark, sf)
    return _m1(spark, sf).counts.select("label", "n", keep_flag("n", t).alias("status"))


@reg("clean_corpus_two_stage", f"""{PREPARED_OLD}
SELECT p.row_id, p.summary, p.label, p.source FROM prepared p JOIN counts c ON p.label = c.label
WHERE p.summary IS NOT NULL AND c.n >= {THRESHOLD}""")
def q_clean_two_stage(spark, sf):
    return _m2(spark, sf).corpus


@reg("label_counts", f"""{PREPARED}
SELECT label, n FROM counts""")
def q_label_counts(spark, sf):
    prepared = corpus_from_documents(spark, sf).withColumn("label", fl("label"))
    return C.label_counts(C.drop_null_rows(prepared), ordered=True)


@reg("row_count", f"""{PREPARED}
SELECT count(*) AS n_rows FROM prepared WHERE summary IS NOT NULL AND label IS NOT NULL""")
def q_row_count(spark, sf):
    prepared = corpus_from_documents(spark, sf).withColumn("label", fl("label"))
    return C.row_count(C.drop_null_rows(prepared))


@reg("n_classes", f"""{PREPARED}
SELECT count(DISTINCT label) AS n_classes FROM prepared WHERE summary IS NOT NULL""")
def q_n_classes(spark, sf):
    prepared = corpus_from_documents(spark, sf).withColumn("label", fl("label"))
    return C.n_classes(C.drop_null_rows(prepared))


@reg("drop_null_rows", f"""{PREPARED}
SELECT row_id, summary, label, source FROM prepared WHERE summary IS NOT NULL AND label IS NOT NULL""")
def q_drop_null_rows(spark, sf):
    return C.drop_null_rows(corpus_from_documents(spark, sf).withColumn("label", fl("label")))


@reg("filter_rare_classes", f"""{PREPARED}
SELECT p.row_id, p.summary, p.label, p.source FROM prepared p
WHERE p.summary IS NOT NULL AND p.label IN (SELECT label FROM counts WHERE n >= {THRESHOLD})""")
def q_filter_rare(spark, sf):
    rows = C.drop_null_rows(corpus_from_documents(spark, sf).withColumn("label", fl("label")))
    return C.filter_rare_classes(rows, _threshold(spark, sf))


@reg("rare_rows", f"""{PREPARED}
SELECT p.row_id, p.summary, p.label, p.source FROM prepared p
WHERE p.summary IS NOT NULL AND p.label IS NOT NULL
  AND p.label NOT IN (SELECT label FROM counts WHERE n >= {THRESHOLD})""")
def q_rare_rows(spark, sf):
    rows = C.drop_null_rows(corpus_from_documents(spark, sf).withColumn("label", fl("label")))
    return C.rare_rows(rows, _threshold(spark, sf))


# -- label projections --------------------------------------------------------
@reg("first_label", f"""WITH {CORPUS}
SELECT row_id, label AS label_raw, {first_label('label')} AS label FROM corpus""")
def q_first_label(spark, sf):
    c = corpus_from_documents(spark, sf)
    return c.select("row_id", F.col("label").alias("label_raw"), fl("label").alias("label"))


@reg("first_label_ascii", f"""WITH {CORPUS}
SELECT row_id, label AS label_raw, {first_label_ascii('label', literal_nan=True)} AS label FROM corpus""")
def q_first_label_ascii(spark, sf):
    c = corpus_from_documents(spark, sf)
    return c.select("row_id", F.col("label").alias("label_raw"), fla("label", "literal_nan").alias("label"))


@reg("to_text", f"""WITH {CORPUS}
SELECT row_id, coalesce(CAST(label AS VARCHAR), 'nan') AS label_text, CAST(summary AS VARCHAR) AS summary FROM corpus""")
def q_to_text(spark, sf):
    c = corpus_from_documents(spark, sf)
    return c.select("row_id", to_text("label", "literal_nan").alias("label_text"), to_text("summary").alias("summary"))


@reg("strip_text", f"""SELECT doc_id AS row_id, {strip("concat(chr(12288), ' ', text, chr(9), chr(160))")} AS stripped,
  length({strip('text')}) = length(text) AS unchanged FROM documents""")
def q_strip_text(spark, sf):
    d = table(spark, sf, "documents")
    padded = F.concat(F.lit("　 "), F.col("text"), F.lit("\t "))
    return d.select(F.col("doc_id").alias("row_id"), strip_text(padded).alias("stripped"),
                    (F.length(strip_text("text")) == F.length("text")).alias("unchanged"))


# -- sources -------------------------------------------------------------------
@reg("read_corpus", """SELECT doc_id AS row_id, text AS summary, lang AS label, source, n_chars
FROM documents""")
def q_read_corpus(spark, sf):
    return S.read_corpus(spark, f"{sf}/documents.parquet", fmt="parquet", text_col="text",
                         label_col="lang", row_id_col="doc_id").drop("doc_id")


NA_LABEL = ("CASE WHEN doc_id % 13 = 0 THEN 'nan' WHEN doc_id % 17 = 0 THEN 'NA' "
            "WHEN doc_id % 19 = 0 THEN '' ELSE lang END")


@reg("normalize_na", f"""SELECT doc_id AS row_id, text AS summary,
  CASE WHEN lbl IN ('', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND',
      '1.#QNAN', '<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null') THEN NULL ELSE lbl END AS label
FROM (SELECT *, {NA_LABEL} AS lbl FROM documents)""")
def q_normalize_na(spark, sf):
    d = table(spark, sf, "documents")
    lbl = F.expr(NA_LABEL)
    return S.normalize_na(d.select(F.col("doc_id").alias("row_id"), F.col("text").alias("summary"),
                                   lbl.alias("label")))


@reg("preview", """SELECT doc_id AS row_id, text AS summary, lang AS label FROM documents ORDER BY doc_id LIMIT 5""")
def q_preview(spark, sf):
    d = S.read_corpus(spark, f"{sf}/documents.parquet", fmt="parquet", text_col="text",
                      label_col="lang", row_id_col="doc_id")
    return S.preview(d.select("row_id", "summary", "label"))


@reg("drop_blank_text", f"""WITH {CORPUS}
SELECT row_id, summary FROM (SELECT row_id, CASE WHEN row_id % 7 = 0 THEN concat(chr(12288), ' ') ELSE summary END
  AS summary FROM corpus) WHERE length({strip('summary')}) > 0""")
def q_drop_blank(spark, sf):
    c = corpus_from_documents(spark, sf)
    c = c.select("row_id", F.when(F.col("row_id") % 7 == 0, F.lit("\u3000 ")).otherwise(F.col("summary")).alias("summary"))
    return C.drop_blank_text(c)


__all__ = ["QUERIES", "ORACLES", "q"]


# -- sinks ---------------------------------------------------------------------
@reg("write_corpus", f"""{PREPARED}
SELECT p.row_id, p.summary, p.label, p.source FROM prepared p JOIN counts c ON p.label = c.label
WHERE p.summary IS NOT NULL AND c.n >= {THRESHOLD}""")
def q_write_corpus(spark, sf):
    path = S.write_corpus(_m1(spark, sf).corpus, work_path(spark, "clean_corpus_csv"), "csv")
    return S.read_corpus(spark, path, "csv", row_id_col="row_id").select("row_id", "summary", "label", "source")


REPORT_SQL = f"""{PREPARED},
st AS ({STATS_SQL}),
cls AS ({CLASSES_SQL})
SELECT row_number() OVER (ORDER BY block, ord) AS line_no, line FROM (
  SELECT 0 AS block, 0 AS ord, repeat('=', 60) AS line
  UNION ALL SELECT 0, 1, '数据处理统计信息'
  UNION ALL SELECT 0, 2, repeat('=', 60)
  UNION ALL SELECT 0, 3, '原始样本数: ' || n_input FROM st
  UNION ALL SELECT 0, 4, '处理后样本数: ' || n_output FROM st
  UNION ALL SELECT 0, 5, '删除样本数: ' || n_rare_dropped FROM st
  UNION ALL SELECT 0, 6, '原始类别数: ' || n_classes_before FROM st
  UNION ALL SELECT 0, 7, '处理后类别数: ' || n_classes_after FROM st
  UNION ALL SELECT 0, 8, '删除类别数: ' || n_classes_deleted FROM st
  UNION ALL SELECT 0, 9, '最小样本数标准: ' || min_samples FROM st
  UNION ALL SELECT 0, 10, ''
  UNION ALL SELECT 1, 0, '删除的类别:' FROM st WHERE n_classes_deleted > 0
  UNION ALL SELECT 1, 1, repeat('-', 60) FROM st WHERE n_classes_deleted > 0
  UNION ALL SELECT 2, rank, label || ': ' || n || ' 样本' FROM cls WHERE section = 'deleted'
  UNION ALL SELECT 3, 0, ''
  UNION ALL SELECT 3, 1, '保留的类别分布:'
  UNION ALL SELECT 3, 2, repeat('-', 60)
  UNION ALL SELECT 4, rank, label || ': ' || n || ' 样本' FROM cls WHERE section = 'kept')"""


@reg("write_stats_report", REPORT_SQL)
def q_write_stats_report(spark, sf):
    """Lines as the written file holds them."""
    m = _m1(spark, sf)
    return read_lines(spark, write_stats_report(m.stats, m.classes, work_path(spark, "stats_report")))


@reg("pct_of_total", f"""{PREPARED}
SELECT label, n, round(100.0 * n / sum(n) OVER (), 6) AS pct FROM counts""")
def q_pct_of_total(spark, sf):
    counts = _m1(spark, sf).counts
    return C.pct_of_total(counts).select("label", "n", F.round("pct", 6).alias("pct"))


OLD_REPORT_SQL = f"""{PREPARED_OLD},
st AS ({STATS_SQL}),
cls AS ({CLASSES_SQL})
SELECT row_number() OVER (ORDER BY block, ord) AS line_no, line FROM (
  SELECT 0 AS block, 0 AS ord, repeat('=', 60) AS line
  UNION ALL SELECT 0, 1, '数据清洗统计信息'
  UNION ALL SELECT 0, 2, repeat('=', 60)
  UNION ALL SELECT 0, 3, '原始样本数: ' || n_after_null FROM st
  UNION ALL SELECT 0, 4, '清洗后样本数: ' || n_output FROM st
  UNION ALL SELECT 0, 5, '删除样本数: ' || n_rare_dropped FROM st
  UNION ALL SELECT 0, 6, '原始类别数: ' || n_classes_before FROM st
  UNION ALL SELECT 0, 7, '清洗后类别数: ' || n_classes_after FROM st
  UNION ALL SELECT 0, 8, '删除类别数: ' || n_classes_deleted FROM st
  UNION ALL SELECT 0, 9, '最小样本数标准: ' || min_samples FROM st
  UNION ALL SELECT 0, 10, ''
  UNION ALL SELECT 1, 0, '删除的类别:' FROM st WHERE n_classes_deleted > 0
  UNION ALL SELECT 1, 1, repeat('-', 60) FROM st WHERE n_classes_deleted > 0
  UNION ALL SELECT 2, rank, label || ': ' || n || ' 样本' FROM cls WHERE section = 'deleted'
  UNION ALL SELECT 3, 0, ''
  UNION ALL SELECT 3, 1, '保留的类别分布:'
  UNION ALL SELECT 3, 2, repeat('-', 60)
  UNION ALL SELECT 4, rank, label || ': ' || n || ' 样本' FROM cls WHERE section = 'kept')"""


@reg("write_stats_report_two_stage", OLD_REPORT_SQL)
def q_write_stats_report_two_stage(spark, sf):
    """Lines as the written file holds them."""
    m = _m2(spark, sf)
    return read_lines(spark, write_stats_report(m.stats, m.classes, work_path(spark, "stats_report"), style="old"))
