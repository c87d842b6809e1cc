"""Physical-plan properties the scale design relies on."""

from textloom.operators import profile as P
from textloom.plans.cleaning import clean_corpus
from textloom.sources import corpus as S


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def corpus(spark, sf):
    return S.read_corpus(spark, f"{sf}/documents.parquet", "parquet", text_col="text", label_col="lang",
                         row_id_col="doc_id")


def test_clean_output_is_broadcast_semi_join_without_corpus_shuffle(spark, sf0001):
    res = clean_corpus(corpus(spark, sf0001), 40)
    p = plan(res.corpus)
    assert "BroadcastHashJoin" in p and "LeftSemi" in p
    assert "SortMergeJoin" not in p and "Exchange hashpartitioning" not in p


def test_label_counts_use_partial_aggregation(spark, sf0001):
    from textloom.operators.clean import label_counts
    p = plan(label_counts(corpus(spark, sf0001)))
    assert "partial_count" in p


def test_null_filter_and_pruning_reach_the_scan(spark, sf0001):
    from textloom.operators.clean import drop_null_rows
    df = drop_null_rows(corpus(spark, sf0001)).select("row_id", "label")
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(text), IsNotNull(lang)]" in p or "IsNotNull(text)" in p
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string>" in p


def test_profile_statistics_run_on_frequency_table(spark, sf0001):
    lens = P.length_table(corpus(spark, sf0001))
    freq = P.length_frequencies(lens)
    p = plan(P.length_percentiles(freq))
    assert "percentile" in p.lower() and "partial_count" in p


def test_no_cartesian_products(spark, sf0001):
    from textloom.checks import QUERIES
    for key in ("length_distribution", "length_histogram", "coverage_by_limit", "pct_of_total",
                "per_class_metrics", "cleaning_stats"):
        p = plan(QUERIES[key](spark, sf0001))
        assert "CartesianProduct" not in p, key
