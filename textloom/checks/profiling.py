"""Registered queries + oracles: tokens and the length profile (M3 family)."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.checks.sqlfrag import LENGTHS, q, tokens
from textloom.functions import (
    basic_tokens, length_bin, strip_accents, text_preview, token_preview,
    truncation_excess,
)
from textloom.operators import profile as P
from textloom.plans.profiling import profile_lengths, profile_metrics
from textloom.session import work_path
from textloom.sources.reports import read_lines, write_length_report
from textloom.sources.tables import labelled_documents, table

QUERIES: dict = {}
ORACLES: dict = {}


def reg(key, sql=None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return deco


def _lens(spark, sf, keep_text=False):
    return P.length_table(labelled_documents(spark, sf), keep_text=keep_text)


def _freq(spark, sf):
    return P.length_frequencies(_lens(spark, sf))


W = f"WITH {LENGTHS}"
FREQ = f"{W}, freq AS (SELECT len, count(*) AS n FROM lens GROUP BY len)"
PCTS = (50, 75, 80, 85, 90, 95, 99)
LIMITS = (64, 128, 192, 256, 384, 512)


def _per_limit(expr: str) -> str:
    return "[" + ", ".join(expr.format(L=L) for L in LIMITS) + "]"


# One pass over the lengths: per-limit counts as lists, unnested into one
# row per limit (no limits x rows pairs).
COV = f"""covagg AS (SELECT count(*) AS total,
    {_per_limit('count(*) FILTER (WHERE len <= {L})')} AS within,
    {_per_limit('count(*) FILTER (WHERE len > {L})')} AS over,
    {_per_limit('sum(len - {L}) FILTER (WHERE len > {L})')} AS s_over,
    {_per_limit('max(len - {L}) FILTER (WHERE len > {L})')} AS m_over FROM lens),
cov AS (SELECT unnest({list(LIMITS)}) AS "limit", unnest(within) AS n_within, unnest(over) AS n_over,
    unnest(s_over) AS s_over, unnest(m_over) AS m_over, total FROM covagg)"""


def r6(c):
    return F.round(c, 6)


# -- per-row projections -------------------------------------------------------
@reg("basic_tokens", f"""SELECT doc_id AS row_id, array_to_string({tokens('text')}, ' ') AS tokens,
  CAST(len({tokens('text')}) AS INTEGER) AS n_tokens FROM documents""")
def q_basic_tokens(spark, sf):
    d = table(spark, sf, "documents")
    t = basic_tokens("text")
    return d.select(F.col("doc_id").alias("row_id"), F.array_join(t, " ").alias("tokens"),
                    F.size(t).alias("n_tokens"))


@reg("token_length", f"{W} SELECT row_id, len FROM lens")
def q_token_length(spark, sf):
    return _lens(spark, sf)


@reg("strip_accents", "SELECT doc_id AS row_id, strip_accents(text) AS text FROM documents")
def q_strip_accents(spark, sf):
    d = table(spark, sf, "documents")
    return d.select(F.col("doc_id").alias("row_id"), strip_accents("text").alias("text"))


@reg("text_preview", """SELECT doc_id AS row_id, substring(text, 1, 100) AS preview,
  concat(substring(text, 1, 100), '...') AS preview_ellipsis FROM documents""")
def q_text_preview(spark, sf):
    d = table(spark, sf, "documents")
    return d.select(F.col("doc_id").alias("row_id"), text_preview("text").alias("preview"),
                    text_preview("text", ellipsis=True).alias("preview_ellipsis"))


@reg("token_preview", f"""SELECT doc_id AS row_id, array_to_string({tokens('text')}[1:20], ' ') AS tokens20
FROM documents""")
def q_token_preview(spark, sf):
    d = table(spark, sf, "documents")
    return d.select(F.col("doc_id").alias("row_id"),
                    F.array_join(token_preview(basic_tokens("text")), " ").alias("tokens20"))


BIN_CASE = """CASE WHEN len > 512 THEN '512+' WHEN len > 384 THEN '384-512' WHEN len > 256 THEN '256-384'
  WHEN len > 192 THEN '192-256' WHEN len > 128 THEN '128-192' WHEN len > 64 THEN '64-128'
  WHEN len > 32 THEN '32-64' WHEN len > 0 THEN '0-32' END"""


@reg("length_bin", f"{W} SELECT row_id, len, {BIN_CASE} AS bin FROM lens")
def q_length_bin(spark, sf):
    return _lens(spark, sf).select("row_id", "len", length_bin("len").alias("bin"))


@reg("truncation_excess", f"""{W} SELECT row_id, greatest(len - 128, 0) AS excess_128,
  greatest(len - 512, 0) AS excess_512 FROM lens""")
def q_truncation_excess(spark, sf):
    return _lens(spark, sf).select("row_id", truncation_excess("len", 128).alias("excess_128"),
                                   truncation_excess("len", 512).alias("excess_512"))


@reg("over_length", f"{W} SELECT row_id, len FROM lens WHERE len > 512")
def q_over_length(spark, sf):
    return P.over_length(_lens(spark, sf), 512)


# -- aggregates on the frequency table ----------------------------------------
@reg("length_summary", f"""{W} SELECT count(*) AS n, min(len) AS min_len, max(len) AS max_len,
  round(avg(len), 6) AS mean_len, round(median(len), 6) AS median_len, round(stddev_samp(len), 6) AS std_len
FROM lens""")
def q_length_summary(spark, sf):
    lens = _lens(spark, sf)
    s = P.length_summary(lens, P.length_frequencies(lens))
    return s.select("n", "min_len", "max_len", r6("mean_len").alias("mean_len"),
                    r6("median_len").alias("median_len"), r6("std_len").alias("std_len"))


@reg("length_percentiles", f"""{W} SELECT unnest({list(PCTS)}) AS p,
  round(unnest(quantile_cont(len, {[p / 100 for p in PCTS]})), 6) AS value FROM lens""")
def q_length_percentiles(spark, sf):
    return P.length_percentiles(_freq(spark, sf)).select("p", r6("value").alias("value"))


@reg("recommend_max_length", f"""{W} SELECT unnest([90, 95, 99]) AS p,
  CAST(trunc(unnest(quantile_cont(len, [0.9, 0.95, 0.99]))) AS INTEGER) AS max_length FROM lens""")
def q_recommend(spark, sf):
    return P.recommend_max_length(_freq(spark, sf))


COVERAGE_SQL = f"""{W}, {COV}
SELECT "limit", round(100.0 * n_within / total, 6) AS coverage_pct, n_over AS n_truncated FROM cov"""


@reg("length_coverage", COVERAGE_SQL)
def q_length_coverage(spark, sf):
    c = P.length_coverage(_freq(spark, sf))
    return c.select("limit", r6("coverage_pct").alias("coverage_pct"), "n_truncated")


@reg("coverage_by_limit", COVERAGE_SQL)
def q_coverage_by_limit(spark, sf):
    c = P.coverage_by_limit(_freq(spark, sf))
    return c.select("limit", r6("coverage_pct").alias("coverage_pct"), "n_truncated")


@reg("truncation_loss", f"""{W}, {COV}
SELECT "limit", round(s_over / n_over, 6) AS mean_loss, CAST(m_over AS INTEGER) AS max_loss FROM cov""")
def q_truncation_loss(spark, sf):
    t = P.truncation_loss(_freq(spark, sf))
    return t.select("limit", r6("mean_loss").alias("mean_loss"), "max_loss")


BINS_SQL = """bins AS (SELECT * FROM (VALUES (1, '0-32'), (2, '32-64'), (3, '64-128'), (4, '128-192'),
  (5, '192-256'), (6, '256-384'), (7, '384-512'), (8, '512+')) t(bin_ord, bin))"""


def dist_sql(lens_cte: str) -> str:
    return f"""WITH {lens_cte}, {BINS_SQL},
per AS (SELECT {BIN_CASE} AS bin, count(*) AS n FROM lens GROUP BY 1)
SELECT b.bin_ord, b.bin, coalesce(p.n, 0) AS n,
  round(100.0 * coalesce(p.n, 0) / (SELECT count(*) FROM lens), 6) AS pct
FROM bins b LEFT JOIN per p ON b.bin = p.bin"""


@reg("length_distribution", dist_sql(LENGTHS))
def q_length_distribution(spark, sf):
    d = P.length_distribution(_freq(spark, sf))
    return d.select("bin_ord", "bin", "n", r6("pct").alias("pct"))


BENCH_LENS = f"""lens AS (SELECT item_id AS row_id, CAST(len({tokens('text')}) + 2 AS INTEGER) AS len
  FROM benchmark)"""


@reg("bins_left_join", dist_sql(BENCH_LENS))
def q_bins_left_join(spark, sf):
    b = table(spark, sf, "benchmark").select(F.col("item_id").alias("row_id"), "text")
    lens = P.length_table(b, "text")
    d = P.length_distribution(P.length_frequencies(lens))
    return d.select("bin_ord", "bin", "n", r6("pct").alias("pct"))


@reg("length_histogram", f"""{FREQ},
rng AS (SELECT CASE WHEN min(len) = max(len) THEN min(len) - 0.5 ELSE min(len) END::DOUBLE AS lo,
               CASE WHEN min(len) = max(len) THEN max(len) + 0.5 ELSE max(len) END::DOUBLE AS hi FROM freq),
ids AS (SELECT CAST(range AS INTEGER) AS bin FROM range(50)),
per AS (SELECT CAST(least(floor((len - (SELECT lo FROM rng)) * 50 / ((SELECT hi FROM rng) - (SELECT lo FROM rng))),
                          49) AS INTEGER) AS bin, sum(n)::BIGINT AS n FROM freq GROUP BY 1)
SELECT ids.bin,
  round((SELECT lo FROM rng) + ids.bin * (((SELECT hi FROM rng) - (SELECT lo FROM rng)) / 50), 6) AS lo_edge,
  round((SELECT lo FROM rng) + (ids.bin + 1) * (((SELECT hi FROM rng) - (SELECT lo FROM rng)) / 50), 6) AS hi_edge,
  coalesce(per.n, 0)::BIGINT AS n
FROM ids LEFT JOIN per ON ids.bin = per.bin""")
def q_length_histogram(spark, sf):
    h = P.length_histogram(_freq(spark, sf))
    return h.select("bin", r6("lo_edge").alias("lo_edge"), r6("hi_edge").alias("hi_edge"), "n")


@reg("length_cdf", f"""{FREQ}
SELECT len, n, sum(n) OVER (ORDER BY len ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS cum_n,
  round(100.0 * sum(n) OVER (ORDER BY len ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
        / sum(n) OVER (), 6) AS cum_pct FROM freq""")
def q_length_cdf(spark, sf):
    c = P.length_cdf(_freq(spark, sf))
    return c.select("len", "n", "cum_n", r6("cum_pct").alias("cum_pct"))


def extremes_sql(order: str, ellipsis: bool) -> str:
    preview = "concat(substring(text, 1, 100), '...')" if ellipsis else "substring(text, 1, 100)"
    return f"""{W}
SELECT CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS rank, row_id, len, {preview} AS text_preview,
  array_to_string(list_concat(['[CLS]'], {tokens('text')}, ['[SEP]'])[1:20], ' ') AS token_preview
FROM (SELECT * FROM lens ORDER BY {order} LIMIT 3)"""


def _ext(df):
    return df.select("rank", "row_id", "len", "text_preview",
                     F.array_join("token_preview", " ").alias("token_preview"))


@reg("shortest_k", extremes_sql("len, row_id", False))
def q_shortest_k(spark, sf):
    return _ext(P.shortest_k(_lens(spark, sf, keep_text=True)))


@reg("longest_k", extremes_sql("len DESC, row_id", True))
def q_longest_k(spark, sf):
    corpus = labelled_documents(spark, sf)
    return _ext(P.longest_k(_lens(spark, sf), corpus=corpus))


# -- the whole profile and its report -----------------------------------------
@reg("profile_lengths", f"""{W},
summary AS (SELECT * FROM (VALUES ('n', ''), ('min', ''), ('max', ''), ('mean', ''), ('median', ''), ('std', ''))
  t(metric, key)),
s AS (SELECT count(*)::DOUBLE AS n, min(len)::DOUBLE AS mn, max(len)::DOUBLE AS mx, avg(len) AS mean,
  median(len)::DOUBLE AS med, stddev_samp(len) AS std FROM lens),
{COV}
SELECT metric, key, round(CASE metric WHEN 'n' THEN (SELECT n FROM s) WHEN 'min' THEN (SELECT mn FROM s)
  WHEN 'max' THEN (SELECT mx FROM s) WHEN 'mean' THEN (SELECT mean FROM s) WHEN 'median' THEN (SELECT med FROM s)
  ELSE (SELECT std FROM s) END, 6) AS value FROM summary
UNION ALL
SELECT 'percentile', CAST(unnest({list(PCTS)}) AS VARCHAR),
  round(unnest(quantile_cont(len, {[p / 100 for p in PCTS]})), 6) FROM lens
UNION ALL
SELECT 'coverage_pct', CAST("limit" AS VARCHAR), round(100.0 * n_within / total, 6) FROM cov
UNION ALL
SELECT 'n_truncated', CAST("limit" AS VARCHAR), n_over::DOUBLE FROM cov
UNION ALL
SELECT 'mean_loss', CAST("limit" AS VARCHAR), round(s_over / n_over, 6) FROM cov""")
def q_profile_lengths(spark, sf):
    p = profile_lengths(labelled_documents(spark, sf))
    return profile_metrics(p).select("metric", "key", r6("value").alias("value"))


@reg("write_length_report", f"""{W},
s AS (SELECT count(*) AS n, min(len) AS mn, max(len) AS mx, avg(len) AS mean, median(len) AS med,
  stddev_samp(len) AS std FROM lens),
{COV}
SELECT row_number() OVER (ORDER BY block, ord) AS line_no, line FROM (
SELECT * FROM (VALUES (0, 0, 'Summary Token长度统计'), (0, 1, repeat('=', 60)), (0, 8, '')) t(block, ord, line)
UNION ALL SELECT 0, 2, '总样本数: ' || n FROM s
UNION ALL SELECT 0, 3, '最小token长度: ' || mn FROM s
UNION ALL SELECT 0, 4, '最大token长度: ' || mx FROM s
UNION ALL SELECT 0, 5, '平均token长度: ' || printf('%.2f', mean) FROM s
UNION ALL SELECT 0, 6, '中位数token长度: ' || printf('%.2f', med) FROM s
UNION ALL SELECT 0, 7, '标准差: ' || printf('%.2f', std) FROM s
UNION ALL SELECT 1, "limit", 'MAX_LENGTH=' || "limit" || ': 覆盖 '
  || printf('%.2f', 100.0 * n_within / total) || '% 的数据' FROM cov)""")
def q_write_length_report(spark, sf):
    p = profile_lengths(labelled_documents(spark, sf))
    return read_lines(spark, write_length_report(p.summary, p.coverage, work_path(spark, "length_report")))


__all__ = ["QUERIES", "ORACLES", "q"]
