"""Literal edge rows (FIXTURES.md section 4) for single operators."""

import math
import os
import tempfile

import pytest

from textloom.functions import basic_tokens, first_label, first_label_ascii, length_bin, strip_text
from textloom.operators import clean as C
from textloom.operators import history as H
from textloom.operators import labels as L
from textloom.operators import metrics as MT
from textloom.operators import profile as P
from textloom.operators import split as SP
from textloom.plans.cleaning import clean_corpus
from textloom.sources import corpus as S
from textloom.sources.reports import cleaning_report_lines


def one(spark, values, schema="x string"):
    return spark.createDataFrame([(v,) for v in values], schema)


def test_first_label_comma_rules(spark):
    df = one(spark, ["a,b，c", "q, z", "，x", None, "  solo  "])
    got = [r[0] for r in df.select(first_label("x")).collect()]
    assert got == ["a,b", "q", "", None, "solo"]
    lit = [r[0] for r in df.select(first_label("x", "literal_nan")).collect()]
    assert lit[3] == "nan"


def test_first_label_ascii_ignores_fullwidth(spark):
    df = one(spark, [" a，b,c ", None])
    assert [r[0] for r in df.select(first_label_ascii("x", "literal_nan")).collect()] == ["a，b", "nan"]


@pytest.mark.parametrize("ws", ["\u3000", "\u00a0", "\u0085", "\u001c", "\t", " \n "])
def test_strip_unicode_whitespace(spark, ws):
    df = one(spark, [f"{ws}x{ws}"])
    assert df.select(strip_text("x")).first()[0] == "x"


@pytest.mark.parametrize("ch", ["\u200b", "\ufeff"])
def test_strip_keeps_zero_width(spark, ch):
    df = one(spark, [f"{ch}x{ch}"])
    assert df.select(strip_text("x")).first()[0] == f"{ch}x{ch}"


def test_normalize_na_tokens(spark):
    df = spark.createDataFrame([("nan", "NA"), ("", "ok")], "summary string, label string")
    out = S.normalize_na(df).collect()
    assert out[0]["summary"] is None and out[0]["label"] is None
    assert out[1]["summary"] is None and out[1]["label"] == "ok"


def test_csv_quoting_round_trip(spark):
    d = tempfile.mkdtemp(prefix="tl-csv-", dir="/tmp")
    p = os.path.join(d, "c.csv")
    with open(p, "w", encoding="utf-8") as f:
        f.write('summary,label,extra\n"line1\nline2, q""q""",lab,e1\nplain,lab2,e2\n')
    df = S.read_corpus(spark, p, "csv")
    rows = sorted(df.collect(), key=lambda r: r["label"])
    assert rows[0]["summary"] == 'line1\nline2, q"q"'
    assert rows[0]["extra"] == "e1" and df.columns[:3] == ["row_id", "summary", "label"]
    with pytest.raises(ValueError):
        S.read_corpus(spark, p, "csv", label_col="nope")


def test_threshold_inclusive_and_all_large_report(spark):
    rows = [(i, "t", "big") for i in range(5)] + [(10 + i, "t", "edge") for i in range(3)]
    df = spark.createDataFrame(rows, "row_id bigint, summary string, label string")
    res = clean_corpus(df, min_samples=3, materialize=False)
    assert res.corpus.count() == 8
    st = res.stats.first()
    assert st["n_rare_dropped"] == 0 and st["n_classes_deleted"] == 0
    lines = [r["line"] for r in cleaning_report_lines(res.stats, res.classes).orderBy("block", "ord").collect()]
    assert "删除的类别:" not in lines
    assert lines[9] == "最小样本数标准: 3" and lines[10] == "" and lines[11] == ""
    assert lines[12] == "保留的类别分布:" and lines[-1] == "edge: 3 样本"


def test_null_label_literal_nan_is_a_class(spark):
    df = spark.createDataFrame([(1, "t", None), (2, "t", None), (3, "t", "a")],
                               "row_id bigint, summary string, label string")
    res = clean_corpus(df, min_samples=1, null_label="literal_nan", materialize=False)
    assert {r["label"]: r["n"] for r in res.counts.collect()} == {"nan": 2, "a": 1}
    dropped = clean_corpus(df, min_samples=1, materialize=False).stats.first()
    assert dropped["n_null_dropped"] == 2 and dropped["n_input"] == 3


def test_length_bins(spark):
    df = spark.createDataFrame([(v,) for v in (0, 1, 32, 33, 512, 513)], "n int")
    assert [r[0] for r in df.select(length_bin("n")).collect()] == [None, "0-32", "0-32", "32-64", "384-512", "512+"]


def test_tokens_pattern(spark):
    text = "Hello, \u4e16\u754c! foo_bar don't Stra\u00dfe \u00e9\u3000a\u00a0b"
    toks = one(spark, [text]).select(basic_tokens("x")).first()[0]
    assert toks == ["hello", ",", "\u4e16", "\u754c", "!", "foo", "_", "bar", "don", "'", "t", "stra\u00dfe", "e", "a", "b"]


def test_topk_tie_order(spark):
    df = spark.createDataFrame([(1, [0.1, 2.0, 2.0, -1.0])], "row_id bigint, probs array<double>")
    out = MT.topk_classes(df, "probs", 5).orderBy("rank").collect()
    assert [r["code"] for r in out] == [1, 2, 0, 3]


def test_early_stopping_numeric_row(spark):
    scores = [.5, .6, .6005, .6011, .6009, .6010, .6, .7]
    hist = spark.createDataFrame([("r", i + 1, s) for i, s in enumerate(scores)], "run string, epoch int, score double")
    r = H.early_stopping(hist, patience=3, min_delta=0.001).first()
    assert r["best_score"] == pytest.approx(.6011) and r["best_epoch"] == 4 and r["stop_epoch"] == 7


def test_nan_score_is_no_improvement(spark):
    hist = spark.createDataFrame([("r", 1, 0.5), ("r", 2, float("nan")), ("r", 3, 0.4), ("r", 4, 0.6)],
                                 "run string, epoch int, score double")
    flags = [r["is_best"] for r in H.best_so_far(hist).orderBy("epoch").collect()]
    assert flags == [True, False, False, True]
    es = H.early_stopping(hist, patience=2, min_delta=0.0).first()
    assert es["best_epoch"] == 1 and es["stop_epoch"] == 3


def test_short_last_batch_weighting(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 1.0), (0, 1.0), (1, 4.0)], "batch bigint, loss double")
    assert MT.batch_mean_loss(df).first()["mean_loss"] == pytest.approx(2.5)


def test_absent_class_keeps_zero_row(spark):
    pairs = spark.createDataFrame([(0, 0), (0, 1), (1, 1)], "y_true int, y_pred int")
    d = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "code int, label string")
    per = {r["label"]: r for r in MT.per_class_metrics(MT.confusion_matrix(pairs), d).collect()}
    assert per["c"]["support"] == 0 and per["c"]["precision"] == 0.0 and per["c"]["f1_score"] == 0.0
    ov = MT.overall_metrics(MT.per_class_metrics(MT.confusion_matrix(pairs), d)).first()
    assert ov["macro_recall"] == pytest.approx((0.5 + 1.0) / 2)   # absent class not in the macro mean


def test_single_member_class_raises(spark):
    df = spark.createDataFrame([(i, "a") for i in range(10)] + [(99, "b")], "row_id bigint, label string")
    with pytest.raises(ValueError):
        SP.stratified_split(df, 0.2, 42, materialize=False)


def test_histogram_of_constant(spark):
    freq = spark.createDataFrame([(7, 5)], "len int, n bigint")
    h = P.length_histogram(freq).where("n > 0").collect()
    assert len(h) == 1 and h[0]["n"] == 5 and h[0]["lo_edge"] <= 7 < h[0]["hi_edge"]


def test_label_dict_round_trip_both_shapes(spark):
    d = L.label_dictionary(spark.createDataFrame([("b",), ("a",), ("é",), ("a",)], "label string"),
                           materialize=False)
    from textloom.session import work_path
    for shape in ("map", "list", "rows"):
        p = L.write_label_dict(d, work_path(spark, f"dict_{shape}"), shape)
        back = sorted((r["code"], r["label"]) for r in L.read_label_dict(spark, p, shape).collect())
        assert back == [(0, "a"), (1, "b"), (2, "é")]
    doc = L.dictionary_map_json(d).first()[0]
    assert doc == '{"0":"a","1":"b","2":"é"}'


def test_softmax_sums_to_one(spark):
    from textloom.functions import softmax
    df = spark.createDataFrame([([1000.0, 1000.0, -5.0],)], "z array<double>")
    p = df.select(softmax("z")).first()[0]
    assert math.isclose(sum(p), 1.0) and p[0] == pytest.approx(0.5)


def test_drop_blank_text(spark):
    df = spark.createDataFrame([(1, "　 "), (2, " x "), (3, None)], "row_id bigint, summary string")
    assert [r[0] for r in C.drop_blank_text(df).collect()] == [2]


def test_old_report_is_empty_without_deleted_classes(spark):
    rows = [(i, "t", "big") for i in range(5)]
    df = spark.createDataFrame(rows, "row_id bigint, summary string, label string")
    from textloom.plans.cleaning import clean_corpus_two_stage
    res = clean_corpus_two_stage(df, min_samples=3, materialize=False)
    assert cleaning_report_lines(res.stats, res.classes, style="old").count() == 0
    assert cleaning_report_lines(res.stats, res.classes, style="new").count() > 0


def test_process_dataset_end_to_end(spark):
    from textloom.plans.cleaning import process_dataset
    from textloom.session import work_path
    src = work_path(spark, "raw_csv")
    rows = ([(i, f"text {i}", "a，b") for i in range(6)] + [(10 + i, f"t{i}", " c ") for i in range(2)]
            + [(20, None, "a")])
    spark.createDataFrame(rows, "id bigint, summary string, label string").write.option("header", True).csv(src)
    out = work_path(spark, "clean_csv")
    res = process_dataset(spark, src, out, min_samples=3, row_id_col="id")
    back = S.read_corpus(spark, out, "csv", row_id_col="row_id")
    assert sorted(r["label"] for r in back.collect()) == ["a"] * 6
    report = [r[0] for r in spark.read.text(out + "_stats").collect()]
    assert "原始样本数: 9" in report and "删除样本数: 2" in report and "c: 2 样本" in report
    assert res.stats.first()["n_null_dropped"] == 1


def test_null_text_measured_as_nan(spark):
    df = spark.createDataFrame([(1, None), (2, "a b")], "row_id bigint, summary string")
    assert sorted(r["len"] for r in P.length_table(df).collect()) == [3, 4]


def test_confusion_wide_is_square_over_seen_classes(spark):
    pairs = spark.createDataFrame([(0, 0), (0, 2), (1, 1)], "y_true int, y_pred int")
    wide = MT.confusion_wide(MT.confusion_matrix(pairs)).orderBy("y_true").collect()
    assert [r["y_true"] for r in wide] == [0, 1, 2]
    assert [tuple(r[c] for c in ("0", "1", "2")) for r in wide] == [(1, 0, 1), (0, 1, 0), (0, 0, 0)]


def test_early_stopping_min_mode(spark):
    hist = spark.createDataFrame([("r", i + 1, s) for i, s in enumerate([1.0, 0.8, 0.85, 0.9, 0.95])],
                                 "run string, epoch int, score double")
    r = H.early_stopping(hist, patience=3, min_delta=0.01, mode="min").first()
    assert (r["best_epoch"], r["stop_epoch"]) == (2, 5) and r["best_score"] == pytest.approx(0.8)


def test_tokens_without_accents(spark):
    toks = one(spark, ["Café Ñandú straße"]).select(basic_tokens("x", accents=False)).first()[0]
    assert toks == ["cafe", "nandu", "straße"]


def test_tokens_drop_controls_and_accents(spark):
    rows = ["Café", "a ​ b", "a\u0000b", "﻿x", "été", "o\tn\ne"]
    got = [r[0] for r in one(spark, rows).select(basic_tokens("x")).collect()]
    assert got == [["cafe"], ["a", "b"], ["ab"], ["x"], ["ete"], ["o", "n", "e"]]


def test_strip_of_many_inner_spaces_is_linear(spark):
    import time

    from textloom.functions.text import strip_text
    df = one(spark, [" x" + " " * 40_000 + "y 　"])
    t0 = time.time()
    assert df.select(strip_text("x")).first()[0] == "x" + " " * 40_000 + "y"
    assert time.time() - t0 < 10


def test_csv_sink_keeps_outer_white_space(spark, tmp_path):
    from textloom.sources.corpus import read_corpus, write_corpus
    rows = [(1, "  lead and trail \n", "a"), (2, "\tx", "b"), (3, 'q "x", y', " c ")]
    path = write_corpus(spark.createDataFrame(rows, "row_id long, summary string, label string"), str(tmp_path / "c"))
    assert sorted(tuple(r) for r in read_corpus(spark, path).collect()) == rows


def test_read_corpus_raises_on_a_clash(spark, tmp_path):
    from textloom.sources.corpus import read_corpus
    path = str(tmp_path / "p")
    spark.createDataFrame([(5, "t", "s", "l")], "row_id long, text string, summary string, label string").write.parquet(path)
    with pytest.raises(ValueError, match="summary"):
        read_corpus(spark, path, "parquet", text_col="text")
    assert read_corpus(spark, path, "parquet").first()["row_id"] == 5


def test_best_so_far_starts_at_zero(spark):
    from textloom.operators.history import best_so_far
    df = spark.createDataFrame([("r", 1, -0.5), ("r", 2, -0.2), ("r", 3, 0.1)], "run string, epoch int, score double")
    assert [r["is_best"] for r in best_so_far(df).orderBy("epoch").collect()] == [False, False, True]


def test_matrix_of_more_than_ten_thousand_classes_is_written(spark, tmp_path):
    from textloom.plans.evaluation import write_confusion
    pairs = spark.range(10_050).selectExpr("cast(id as int) y_true", "cast(id as int) y_pred")
    path = write_confusion(MT.confusion_matrix(pairs), str(tmp_path / "m"))
    assert spark.read.parquet(path).count() == 10_050


def test_end_to_end_cleaning_drops_null_words(spark, tmp_path):
    from textloom.plans.cleaning import process_dataset
    from textloom.sources.corpus import write_corpus
    rows = [(i, f"text {i}", "a") for i in range(5)] + [(5, "NA", "a"), (6, "x", "null")]
    src = write_corpus(spark.createDataFrame(rows, "row_id long, summary string, label string"), str(tmp_path / "in"))
    assert process_dataset(spark, src, str(tmp_path / "out"), min_samples=1).corpus.count() == 5
    keep = process_dataset(spark, src, str(tmp_path / "out2"), min_samples=1, null_label="literal_nan")
    assert keep.corpus.filter("label = 'nan'").count() == 1


def test_best_model_pointer_follows_the_last_write(spark, tmp_path):
    from textloom.plans.training import _resolve, _write_text, point_best_to
    best = str(tmp_path / "run" / "best")
    point_best_to(spark, best, str(tmp_path / "run" / "checkpoint-epoch-2"), {"epoch": 2})
    assert _resolve(spark, best) == str(tmp_path / "run" / "checkpoint-epoch-2")
    _write_text(spark, f"{best}/manifest", None)
    assert _resolve(spark, best) == best
    assert _resolve(spark, str(tmp_path / "none")) == str(tmp_path / "none")
