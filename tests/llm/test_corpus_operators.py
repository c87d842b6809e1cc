"""Importance resampling, phrase mining and sharding against brute force."""

import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction
from hashlib import md5, sha256

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textloom.llm import importance as I
from textloom.llm import phrases as P
from textloom.llm import sharding as S


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


# -- importance resampling ---------------------------------------------------
def test_crc_matrices_equal_zlib():
    r = random.Random(1)
    words = [b"", b"a", "größe".encode(), b"x" * 3000] + [r.randbytes(r.randrange(1, 20)) for _ in range(2000)]
    assert I.crc32s(words).tolist() == [zlib.crc32(w) for w in words]
    assert I.crc32s([]).tolist() == []


def brute_resample(docs, target, percent, run, buckets, seed, min_words):
    def features(text):
        w = re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text))
        return len(w), [zlib.crc32(" ".join(w[i:i + k]).encode()) % buckets for k in range(1, run + 1) for i in range(len(w) - k + 1)]
    feats = [features(t) for _, t in docs]
    s = Counter(b for _, f in feats for b in f)
    t = Counter(b for x in target for b in features(x)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in s}
    rows = []
    for (doc, _), (words, f) in zip(docs, feats, strict=True):
        w = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        rows.append([doc, words, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    able = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for i, r in enumerate(able[:percent * len(able) // 100]):
        r[5] = i + 1
    return rows


@pytest.mark.parametrize("run,percent", [(1, 10), (2, 35), (3, 100)])
def test_resample_matches_brute_force(spark, run, percent):
    r = random.Random(run)
    vocab = [f"w{i}" for i in range(200)] + ["Größe", "ÀB", "x_y", "a-b"]
    docs = [(i, " ".join(r.choice(vocab) for _ in range(r.randrange(0, 60)))) for i in range(300)]
    docs += [(301, None), (302, ""), (303, "... !"), (None, "aa bb " * 20), (5, docs[5][1]), (5, docs[5][1])]
    target = ["w1 w2 w3 w4", None, "Größe w1"]
    got = I.resample(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame([(t,) for t in target], "text string"),
                     percent, run, buckets=500, seed=7, min_words=20)
    def key(x):
        return [(v is None, v) for v in x]
    rows = sorted([list(x) for x in got.collect()], key=key)
    assert rows == sorted(brute_resample(docs, target, percent, run, 500, 7, 20), key=key)


def test_resample_long_text_in_pieces(spark, monkeypatch):
    text = " ".join(f"w{i % 71}" for i in range(500))
    want = list(I._hashed([_batch([(1, text), (2, None)])], 3, 1000))
    monkeypatch.setattr(I, "CHUNK", 64)
    got = list(I._hashed([_batch([(1, text), (2, None)])], 3, 1000))
    counts = [Counter(np.frombuffer(b["buckets"][0].as_py(), "<u2").tolist()) for b in (want[0], got[0])]
    assert counts[0] == counts[1] and got[0]["n_words"][0].as_py() == 500


def _batch(rows):
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows])], ["a", "b"])


def test_resample_edge_rows(spark, docs, no_docs):
    got = I.resample(docs, docs)
    assert got.count() == docs.count() and got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert I.resample(no_docs, docs).count() == 0
    assert I.resample(docs, no_docs).filter("n_features = 0 and weight <> 0").count() == 0


# -- phrases -----------------------------------------------------------------
def brute_phrases(docs, min_count, depth, top):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + k])) for k in range(1, depth + 1) for i in range(len(w) - k + 1))
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= min_count}
    out = []
    for (lang, p), a in cand.items():
        if any(x == lang and len(q) > len(p) and 100 * b >= 80 * a and any(q[i:i + len(p)] == p for i in range(len(q))) for (x, q), b in cand.items()):
            continue
        cuts = [(2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.append((lang, " ".join(p), a, f[lang, p[:k]], f[lang, p[k:]], n[lang], score))
    rows = []
    for lang in {x[0] for x in out}:
        best = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))[:top]
        rows += [(lang, i + 1, *x[1:]) for i, x in enumerate(best)]
    return sorted(rows)


@pytest.mark.parametrize("shard_words,depth", [(1 << 20, 4), (50, 4), (50, 5), (200, 2), (200, 3)])
def test_phrases_match_brute_force(spark, shard_words, depth):
    r = random.Random(depth)
    vocab = [f"w{i}" for i in range(25)] + ["Ä", "ß", "the", "\x1c", "x.y"]
    fixed = ["New York City hall", "a b c d e", "in the the the the", "à la carte"]
    docs = []
    for _ in range(150):
        words = [r.choice(fixed) if r.random() < .2 else r.choice(vocab) for _ in range(r.randrange(0, 40))]
        docs.append((r.choice(["en", "en", "de", None]), " ".join(x + r.choice(["", "", "", ". ", "\t", "\n", ", "]) for x in words)))
    docs += [("en", None), ("fr", ""), ("fr", "... \n\n"), docs[0], docs[0]]
    got = P.collocations(spark.createDataFrame(docs, "lang string, text string").repartition(3), min_count=5, depth=depth, top=60,
                         shard_words=shard_words)
    assert sorted(tuple(x) for x in got.collect()) == brute_phrases(docs, 5, depth, 60)


def test_index_counts_every_phrase():
    r = np.random.default_rng(3)
    ids = np.concatenate([[0], r.integers(0, 6, 400), [0]]).astype(np.int32)
    full = np.full(P.FILTER_BITS // 8, 255, np.uint8)
    words = pa.array([".", *"abcde"])
    for k in range(2, 7):
        w, phrase, size = P.levels("en", words, ids, [full] * (k - 1))
        got = {tuple(int(p[i]) + 1 for p in phrase): int(size[i]) for i in range(len(size))}
        want = Counter(t for i in range(len(ids) - k + 1) if 0 not in (t := tuple(ids[i:i + k].tolist())))
        assert got == want and w.to_pylist() == list("abcde")


def test_sort_of_wide_keys_is_stable():
    key = np.random.default_rng(1).integers(0, 9, 1000) << 55
    assert P._sorted(key, 9 << 55)[0].tolist() == np.argsort(key, kind="stable").tolist() == P._sorted(key >> 55, 9)[0].tolist()


def test_phrase_score_passes_64_bits(spark):
    a = 9_000_000_000_000
    got = spark.range(1).select(F.expr(f"(cast({P.SCALE} as decimal(18,0)) * cast({a}L as decimal(19,0))) div cast({a + 7}L as decimal(19,0))")).first()[0]
    assert got == P.SCALE * a // (a + 7)


def test_phrases_edge_rows(spark, docs, no_docs):
    assert P.collocations(no_docs).count() == 0
    got = P.collocations(docs).collect()
    assert [(x["phrase"], x["a"], x["n"] > 3000) for x in got] == [("same same same same", 2997, True)]


# -- sharding ----------------------------------------------------------------
def brute_shards(docs, shards):
    rows = [(md5((t or "").encode()).hexdigest()[:15], d is None, d or 0, len((t or "").encode()) + 8, t) for d, t in docs]
    rows.sort(key=lambda x: x[:3])
    total, below, held, out = sum(x[3] for x in rows), 0, Counter(), []
    for _, none, d, size, t in rows:
        shard = min(shards - 1, int(Fraction(shards * (2 * below + size), 2 * total)))
        out.append((None if none else d, size, zlib.crc32((t or "").encode()), shard, held[shard]))
        held[shard] += 1
        below += size
    return sorted(out, key=str)


@pytest.mark.parametrize("shards", [1, 2, 7, 24])
def test_shards_match_brute_force(spark, shards):
    r = random.Random(shards)
    docs = [(r.choice([i, -i, i << 40]), "é" * r.randrange(0, 200)) for i in range(300)]
    docs += [(1000 + i, "hot text " * 9) for i in range(200)] + [(None, "hot text " * 9), (None, None), (1, None), (2, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    assert sorted((tuple(x) for x in S.assign(df, shards).collect()), key=str) == brute_shards(docs, shards)


def test_shard_of_repeated_rows_is_cut(spark):
    df = spark.createDataFrame([(7, "same")] * 1000, "doc_id long, text string").repartition(4)
    got = S.assign(df, 24).groupBy("shard").agg(F.count("*").alias("n"), F.max("slot").alias("top")).collect()
    assert len(got) == 24 and all(x["n"] in (41, 42) and x["top"] == x["n"] - 1 for x in got)


def test_shards_within_tolerance(spark, sf0001):
    df = spark.read.parquet(f"{sf0001}/documents.parquet")
    for tolerance in (0.2, 0.01):
        sizes = [x["b"] for x in S.assign(df, 8, tolerance).groupBy("shard").agg(F.sum("size").alias("b")).collect()]
        widest = df.agg(F.max(F.octet_length("text"))).first()[0] + 8
        assert all(abs(x - sum(sizes) / 8) <= max(widest, 2 * tolerance * sum(sizes) / 8) for x in sizes)


def test_write_shards_keeps_rows(spark, docs, tmp_path):
    back = spark.read.parquet(S.write_shards(docs, str(tmp_path / "out"), 3))
    assert back.select(*docs.columns).exceptAll(docs).count() == 0 and back.count() == docs.count()
    with pytest.raises(ValueError):
        S.with_shards(docs.withColumn("shard", F.lit(1)))


def test_sharding_edge_rows(spark, docs, no_docs):
    assert S.assign(no_docs).count() == 0
    assert S.assign(docs, 24).count() == docs.count()


def test_sharding_has_no_python(spark, sf0001):
    plan = S.op13_histogram_sort(spark, sf0001)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
