"""The distributed softmax layer (M7): gradients, step rules, partitions, tokens."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.functions import basic_tokens, row_cross_entropy, softmax
from textloom.operators import softmax as SM
from textloom.plans import training as TR
from textloom.session import work_path

TEXTS = ["alpha beta beta", "gamma", "", None, "beta gamma delta " * 40, "Café a​b 天气 ok", "delta"]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(i, TEXTS[i % len(TEXTS)], i % 3) for i in range(60)], "row_id long, summary string, code int")


def dense(spark, df, n):
    """Features by hand: buckets from Spark's hash, values in Python."""
    out = []
    for r in df.select("row_id", "code", SM.token_buckets("summary", n).alias("ids")).collect():
        x = np.zeros(n + 1)
        for b, k in Counter(r["ids"]).items():
            x[b] = 1 + math.log(k)
        norm = np.sqrt((x * x).sum())
        x = x / norm if norm else x
        x[-1] = 1
        out.append((r["row_id"], r["code"], x))
    return out


def test_gradient_and_scores_match_dense_arithmetic(spark, rows):
    n = 32
    weights = np.random.default_rng(2).normal(size=(3, n + 1))
    feats = SM.featurize(rows, n, work_path(spark, "t-feat"))
    hand = dense(spark, rows, n)
    want, loss, hits = np.zeros_like(weights), 0.0, 0
    logits = {}
    for rid, code, x in hand:
        z = weights @ x
        logits[rid] = z
        p = np.exp(z - z.max())
        p /= p.sum()
        loss -= math.log(p[code])
        hits += int(z.argmax()) == code
        want += np.outer(p - np.eye(3)[code], x)
    for many in (False, True):
        got, stats = SM.gradient(feats, weights, many)
        assert np.allclose(got, want / len(hand), atol=1e-12) and np.allclose(stats, [len(hand), loss, hits])
    model = SM.Softmax(weights)
    for scored in (TR.score_rows(model, rows), TR.score_rows(model, feats)):
        for r in scored.select("row_id", "logits", "probs", "y_pred").collect():
            assert np.allclose(r["logits"], logits[r["row_id"]]) and abs(sum(r["probs"]) - 1) < 1e-12
            assert r["y_pred"] == int(np.argmax(r["logits"]))


def test_partitions_do_not_change_the_result(spark, rows):
    got = []
    for parts in (1, 16):
        path = work_path(spark, "t-parts")
        feats = SM.featurize(rows.repartition(parts), 64, path, steps=4, seed=3)
        t = SM.Trainer(feats, path, 3, 64, epochs=3, rules=SM.Rules(decay=0.01), seed=3)
        losses = [t.epoch(e) for e in (1, 2, 3)]
        got.append((t.weights, losses))
    assert np.abs(got[0][0] - got[1][0]).max() < 1e-9
    assert np.allclose(got[0][1], got[1][1], atol=1e-9) and got[0][1][2][0] < got[0][1][0][0]


def test_step_rules():
    rules = SM.Rules(rate=1.0, warmup=0.25, clip=1.0)
    o = SM.Optimizer((1, 3), rules, 8)
    assert [round(o.rate(t), 6) for t in range(1, 9)] == [0.5, 1.0] + [round((8 - t + 1) / 6, 6) for t in range(3, 9)]
    o.step(np.zeros((1, 3)), np.array([[30.0, 40.0, 0.0]]))
    assert np.allclose(o.m, 0.1 * np.array([[0.6, 0.8, 0.0]]))              # clipped to norm 1
    w = SM.Optimizer((1, 3), SM.Rules(rate=1.0, warmup=0, decay=0.5, clip=None), 1).step(np.ones((1, 3)), np.zeros((1, 3)))
    assert w.tolist() == [[0.5, 0.5, 1.0]]                                   # the bias does not decay


def test_accumulated_batches_make_one_step(spark, rows):
    path = work_path(spark, "t-acc")
    feats = SM.featurize(rows, 64, path, steps=4, seed=3)
    t = SM.Trainer(feats, path, 3, 64, epochs=1, rules=SM.Rules(accumulate=2), seed=3)
    t.epoch(1)
    assert t.optimizer.t == -(-len(t.steps) // 2) == t.optimizer.total


def test_a_loss_that_is_not_finite_is_an_error(spark, rows):
    path = work_path(spark, "t-inf")
    feats = SM.featurize(rows, 64, path, steps=1)
    t = SM.Trainer(feats, path, 3, 64, epochs=1, weights=np.full((3, 65), np.nan))
    with pytest.raises(ArithmeticError):
        t.epoch(1)


def test_classifier_tokens_are_the_basic_tokens(spark):
    df = spark.createDataFrame([("Café",), ("a​b",), ("天气x!",), ("A\tb́",)], "summary string")
    n = 1 << 14
    same = F.transform(basic_tokens("summary"), lambda t: F.pmod(F.xxhash64(t), F.lit(n)).cast("int"))
    for r in df.select(SM.token_buckets("summary", n).alias("a"), same.alias("b"), basic_tokens("summary").alias("t")).collect():
        assert r["a"] == r["b"] and len(r["t"]) > 0
    tokens = [r["t"] for r in df.select(basic_tokens("summary").alias("t")).collect()]
    assert tokens == [["cafe"], ["ab"], ["天", "气", "x", "!"], ["a", "b"]]


def test_plain_and_special_texts_count_alike(spark):
    from textloom.functions.text import token_count

    texts = ["plain text, ok", "tab\tand\nline", "café", "a​b c\x00d", "", None, "A" * 50 + "é"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    for r in df.select(F.size(basic_tokens("s")).alias("a"), token_count("s").alias("b")).collect():
        assert r["a"] == r["b"]


def test_softmax_is_linear_in_classes(spark):
    z = [0.5, -1.0, 3.0, 800.0, None]
    df = spark.createDataFrame([(z[:4], 2), (None, 1)], "z array<double>, y int")
    r = df.select(softmax("z").alias("p"), row_cross_entropy("z", "y").alias("loss")).collect()
    assert r[0]["p"][3] == 1.0 and abs(r[0]["loss"] - 797.0) < 1e-9 and r[1]["p"] is None
    once = df.select(softmax("z").alias("p"))._jdf.queryExecution().optimizedPlan().toString()
    assert once.count("array_max") == once.count("aggregate(") == 1


def test_saved_model_is_the_model(spark, tmp_path):
    model = SM.Softmax(np.random.default_rng(1).normal(size=(3, 5001)), 128)
    d = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "code int, label string")
    path = TR.save_model(model, str(tmp_path / "m"), d)
    back, names = TR.load_model(spark, path)
    assert (back.weights == model.weights).all() and back.max_length == 128 and names.count() == 3
