"""Split, batch, encode and file operators: plans and rows the oracles do not see."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from textloom.operators import encode as EN
from textloom.operators import metrics as MT
from textloom.operators import split as SP
from textloom.plans import evaluation as EV
from textloom.plans import training as TR
from textloom.session import work_path
from textloom.sources import corpus as S
from textloom.sources.positions import with_positions
from textloom.sources.reports import read_lines, write_lines


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> list[str]:
    return re.findall(r"Exchange (\w+partitioning|SinglePartition)", plan(df))


def scan(spark, sf):
    return S.read_corpus(spark, f"{sf}/documents.parquet", "parquet", text_col="text", label_col="lang", row_id_col="doc_id")


# -- W7 ------------------------------------------------------------------------
def test_split_compares_rows_in_one_scan(spark, sf0001):
    out = SP.stratified_split(scan(spark, sf0001), 0.2, 42)
    assert exchanges(out) == [] and "BroadcastHashJoin" in plan(out) and "Window" not in plan(out)


@pytest.mark.parametrize("rows_per_bucket", [1, 3, 10**6])
def test_split_equals_ranks(spark, rows_per_bucket):
    from hashlib import md5

    ids = [(i * 7919, "a" if i % 3 else "b") for i in range(400)]
    df = spark.createDataFrame([*ids, (10**12, None)], "row_id long, label string").repartition(5)
    got = {r["row_id"]: r["split"] for r in SP.stratified_split(df, 0.25, 9, rows_per_bucket=rows_per_bucket).collect()}
    quota = {r["label"]: r["quota"] for r in SP.split_quotas(df.where("label is not null").groupBy("label").agg(F.count("*").alias("n")), 0.25).collect()}
    for label in "ab":
        order = sorted((i for i, x in ids if x == label), key=lambda i: (md5(f"9|{i}".encode()).hexdigest(), i))
        assert [got[i] for i in order] == ["train"] * quota[label] + ["validation"] * (len(order) - quota[label])
    assert len(got) == 400


def test_split_keeps_a_repeated_id_together(spark):
    df = spark.createDataFrame([(1, "a")] * 300 + [(i, "a") for i in range(2, 202)] + [(i, "b") for i in range(500)], "row_id long, label string")
    out = SP.stratified_split(df, 0.3, 1, rows_per_bucket=10)
    assert out.count() == 1000
    assert out.where("row_id = 1 and label = 'a'").select("split").distinct().count() == 1


# -- W6 ------------------------------------------------------------------------
@pytest.mark.parametrize("shuffle", [True, False])
def test_batches_take_one_exchange(spark, sf0001, shuffle):
    out = SP.assign_batches(scan(spark, sf0001), 16, shuffle=shuffle, rows_per_bucket=20)
    assert exchanges(out) == ["hashpartitioning"]


def test_ordered_batches_with_sparse_and_null_ids(spark):
    ids = [None, -5, 3, 10**17, 10**17 + 1, *range(1000, 1400), -(10**18)]
    df = spark.createDataFrame([(i,) for i in ids], "row_id long").repartition(4)
    got = [r["row_id"] for r in SP.assign_batches(df, 10, shuffle=False, rows_per_bucket=30).orderBy("pos").collect()]
    assert got == sorted(ids, key=lambda i: (i is not None, i or 0))


# -- U2 ------------------------------------------------------------------------
def test_partition_check_counts_repeats(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (3,)], "row_id long")
    s = spark.createDataFrame([(1, "train"), (1, "validation"), (2, "train"), (4, "train")], "row_id long, split string")
    out = SP.split_is_partition(df, s)
    assert exchanges(out).count("hashpartitioning") == 1
    assert tuple(out.first()) == (2, 2, 1)      # one 2 and the 3; a second 1 and the 4; id 1
    assert tuple(SP.split_is_partition(df.limit(0), s.limit(0)).first()) == (0, 0, 0)


# -- J8, M4, M5 ------------------------------------------------------------------
def test_encoding_has_no_exchange_and_keeps_repeated_ids(spark):
    df = spark.createDataFrame([(1, "b a zz"), (1, "a"), (2, None), (3, ""), (4, "a " * 50)], "row_id long, summary string")
    vocab = EN.build_vocab(df, 2)
    enc = EN.encode_fixed_length(df, vocab, 8)
    assert exchanges(enc) == []
    ids = {(r["row_id"], tuple(r["input_ids"])) for r in enc.collect()}
    a, b = (vocab.where(F.col("token") == t).first()["id"] for t in "ab")
    assert ids == {(1, (101, b, a, 100, 102, 0, 0, 0)), (1, (101, a, 102, 0, 0, 0, 0, 0)), (2, (101, 102, 0, 0, 0, 0, 0, 0)),
                   (3, (101, 102, 0, 0, 0, 0, 0, 0)), (4, (101, a, a, a, a, a, a, 102))}
    back = EN.decode_ids(enc.unionByName(spark.createDataFrame([(9, [5000, -1], [1, 1]), (10, None, None)], enc.schema)), vocab)
    assert exchanges(back) == []
    texts = {r["row_id"]: r["tokens"] for r in back.collect() if r["row_id"] in (2, 9, 10)}
    assert texts == {2: ["[CLS]", "[SEP]"] + ["[PAD]"] * 6, 9: ["[UNK]", "[UNK]"], 10: []}


# -- M6 ------------------------------------------------------------------------
def test_one_split_lists_only_its_files(spark, sf0001):
    prep = TR.prepare_training(scan(spark, sf0001), 0.2, 42)
    path = work_path(spark, "t-examples")
    enc, vocab = TR.encoded_examples(prep, 500, 16, path)
    val = TR.read_by_split(spark, path, enc.schema, SP.VALIDATION)
    assert val.inputFiles() and all("split=validation" in f for f in val.inputFiles())
    assert val.columns == enc.columns and val.select("split").distinct().collect()[0][0] == "validation"
    assert val.count() + TR.read_by_split(spark, path, enc.schema, SP.TRAIN).count() == prep.data.count()
    assert "PartitionFilters: [isnotnull(split" in plan(prep.data.where("split = 'train'"))


# -- S1 ------------------------------------------------------------------------
@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_row_ids_do_not_depend_on_splits(spark, tmp_path, fmt):
    src = str(tmp_path / fmt)
    rows = spark.createDataFrame([(f"text {i} {'x' * (i % 50)}", f"l{i % 3}") for i in range(3000)], "summary string, label string")
    w = rows.repartition(3).write
    (w.option("header", True) if fmt == "csv" else w).format(fmt).save(src)
    seen, conf = [], "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(conf)
    try:
        for size in ("128m", "7k"):
            spark.conf.set(conf, size)
            df = S.read_corpus(spark, src, fmt, multiline=False)
            assert size == "128m" or fmt == "parquet" or spark.read.text(src).rdd.getNumPartitions() > 3
            ids = [(r["row_id"], r["summary"]) for r in df.collect()]
            split = {(r["row_id"], r["split"]) for r in SP.stratified_split(S.read_corpus(spark, src, fmt, multiline=False), 0.2, 5).collect()}
            seen.append((sorted(ids), split))
    finally:
        spark.conf.set(conf, old)
    assert seen[0] == seen[1]
    by_file = Counter(i >> 40 for i, _ in seen[0][0])
    assert sorted(by_file) == [0, 1, 2] and all({i & ((1 << 40) - 1) for i, _ in seen[0][0] if i >> 40 == f} == set(range(n)) for f, n in by_file.items())


def test_multiline_csv_rows_are_numbered_in_order(spark, tmp_path):
    src = S.write_corpus(spark.createDataFrame([(f"a\nb {i}", "l") for i in range(50)], "summary string, label string").coalesce(1), str(tmp_path / "c"))
    got = [r["summary"] for r in S.read_corpus(spark, src).orderBy("row_id").collect()]
    assert got == [f"a\nb {i}" for i in range(50)]


# -- S4, S9, S10, S8 ---------------------------------------------------------------
def test_report_lines_come_back_in_order(spark):
    lines = spark.createDataFrame([(b, i, f"{b}-{i}") for b in range(4) for i in range(300)], "block int, ord bigint, line string").repartition(7)
    path = write_lines(lines, work_path(spark, "t-lines"))
    assert [(r["line_no"], r["line"]) for r in read_lines(spark, path).orderBy("line_no").collect()] == [
        (b * 300 + i + 1, f"{b}-{i}") for b in range(4) for i in range(300)]
    assert with_positions(spark.read.text(path), "at").count() == 1200


def test_wide_matrix_of_many_classes(spark):
    n = 1500
    cells = {(i, (i * 7) % n): i + 1 for i in range(0, n, 3)}
    conf = spark.createDataFrame([(a, b, c) for (a, b), c in cells.items()], "y_true int, y_pred int, n long")
    codes = spark.range(n).select(F.col("id").cast("int").alias("code"), F.col("id").cast("string").alias("label"))
    path = EV.write_confusion(conf, work_path(spark, "t-wide"), wide=True, dictionary=codes)
    written = spark.read.parquet(path)
    assert written.columns == ["y_true", "first", "codes", "n"] and written.agg(F.max(F.size("n"))).first()[0] == MT.BLOCK_COLUMNS
    back = EV.read_confusion_wide(spark, path)
    assert back.count() == n * n
    assert {(r["y_true"], r["y_pred"]): r["n"] for r in back.where("n > 0").collect()} == cells
    small = spark.createDataFrame([(5, 9, 2)], "y_true int, y_pred int, n long")
    got = EV.read_confusion_wide(spark, EV.write_confusion(small, work_path(spark, "t-wide"), wide=True)).collect()
    assert sorted(tuple(r) for r in got) == [(5, 5, 0), (5, 9, 2), (9, 5, 0), (9, 9, 0)]


# -- texts measured once (length profile), plain texts matched by a short pattern -------
@pytest.mark.parametrize("key", ["length_distribution", "length_histogram", "coverage_by_limit"])
def test_length_statistics_measure_texts_once(spark, sf0001, key):
    from textloom.checks import QUERIES
    p = plan(QUERIES[key](spark, sf0001))
    assert p.count("FileScan parquet") == 1 and "DataFilters: []" in p and "Filter CASE" not in p


def test_length_bins_and_limits_of_odd_lengths(spark):
    from textloom.operators import profile as P
    none = spark.createDataFrame([], "len INT, n BIGINT")
    assert {(r["n"], r["pct"]) for r in P.length_distribution(none).collect()} == {(0, None)}
    assert {(r["n_truncated"], r["coverage_pct"]) for r in P.coverage_by_limit(none).collect()} == {(0, None)}
    few = spark.createDataFrame([(0, 1), (2, 2), (40, 1)], "len INT, n BIGINT")
    assert [r["n"] for r in P.length_distribution(few).collect()] == [2, 1, 0, 0, 0, 0, 0, 0]
    assert {r["pct"] for r in P.length_distribution(few).where("n = 2").collect()} == {50.0}
    assert {(r["n_truncated"], r["coverage_pct"]) for r in P.coverage_by_limit(few).collect()} == {(0, 100.0)}
    assert [(r["bin"], r["n"], r["lo_edge"], r["hi_edge"]) for r in P.length_histogram(few, 2).orderBy("bin").collect()] == [
        (0, 3, 0.0, 20.0), (1, 1, 20.0, 40.0)]


def test_plain_pattern_gives_the_same_tokens(spark):
    from textloom.functions import text as T
    points = spark.range(1, 0x30000).where("id NOT BETWEEN 55296 AND 57343").select(
        F.expr("decode(unhex(lpad(hex(id), 8, '0')), 'UTF-32')").alias("c"))
    texts = points.select(F.concat(F.lit("aB"), "c", F.lit("9c"), "c", "c", F.lit(" "), "c", F.lit(", x"), "c").alias("t")).union(
        spark.createDataFrame([(None,), ("",), (" \t\n",)], "t STRING"))
    whole = F.regexp_extract_all(T.strip_accents(F.lower(T.clean_controls("t"))), F.lit(T.TOKEN_PATTERN), 0)
    counted = F.size(F.regexp_extract_all(T.clean_controls("t", marks=True), F.lit(T.TOKEN_PATTERN), 0))
    got = texts.select("t", T.basic_tokens("t").alias("tokens"), T.token_count("t").alias("n"))
    assert T.PLAIN_TOKEN_PATTERN in plan(got)
    assert got.where(~F.col("tokens").eqNullSafe(whole) | ~F.col("n").eqNullSafe(counted)).count() == 0


# -- memory of Python workers --------------------------------------------------
def test_lookups_work_a_piece_at_a_time(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(EN, "PIECE", 3)
    sizes = []

    def look(flat):
        sizes.append(len(flat))
        return pa.array([10 * x for x in flat.to_pylist()], pa.int32())
    lists = pa.array([[9], [1, 2], [], [3, 4, 5, 6, 7]], pa.list_(pa.int32())).slice(1)
    assert EN._looked_up(lists, look, pa.int32()).to_pylist() == [[10, 20], [], [30, 40, 50, 60, 70]]
    assert max(sizes) <= 3 and sum(sizes) == 7
    assert EN._looked_up(lists.slice(1, 1), look, pa.int32()).to_pylist() == [[]]


def test_small_tables_start_no_python_workers(spark):
    from textloom.session import local_table
    for df in (EN.special_tokens(spark), local_table(spark, [], "value STRING"), local_table(spark, [(None, 1.5)], "a INT, b DOUBLE")):
        assert "LocalTableScan" in plan(df)
    assert [tuple(r) for r in local_table(spark, [(None, 1.5), (2, None)], "a INT, b DOUBLE").collect()] == [(None, 1.5), (2, None)]
