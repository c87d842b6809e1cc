"""URL filters, HTML extraction, LM scoring, mixing and the pipeline."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textloom.llm import html_extract as H
from textloom.llm import maxent_lm as M
from textloom.llm import mixing as X
from textloom.llm import url_filter as U


def test_cascade_is_exact_on_its_universe(spark):
    listed = spark.createDataFrame([(f"k{i}",) for i in range(0, 5000, 50)], "key string")
    universe = spark.createDataFrame([(f"k{i}",) for i in range(5000)], "key string")
    # a size that is far too small forces false positives, so several levels
    levels = U.build_cascade(listed, universe, size=50)
    assert len(levels) > 2
    rows = U._hashed(universe).collect()
    h1, h2 = (np.array([r[c] for r in rows], np.int64).view(np.uint64) for c in ("h1", "h2"))
    assert U.member(h1, h2, levels).tolist() == [int(r["key"][1:]) % 50 == 0 for r in rows]


def test_urls_edge_rows(spark):
    rows = [(1, None), (2, "no scheme.com/"), (3, "http://EXAMPLE.com/en/x?y#z"), (4, "http://www.example.com/en/"), (5, "https://a.net"),
            (6, "https://a.net/fr/x"), (7, "x://badexample.com/en/"), (8, "http://"), (8, "http://"), (9, "http://com")]
    got = sorted((r["page_id"], r["host"], r["rule"], r["verdict"]) for r in U.filter_urls(spark.createDataFrame(rows, "page_id long, url string")).fillna("-", ["rule"]).collect())
    assert got == [(1, "", "-", "allow"), (2, "", "-", "allow"), (3, "example.com", "example.com/en/", "block"),
                   (4, "www.example.com", "www.example.com/en/", "allow"), (5, "a.net", "-", "allow"), (6, "a.net", "net/fr/", "block"),
                   (7, "badexample.com", "com/", "allow"), (8, "", "-", "allow"), (8, "", "-", "allow"), (9, "com", "-", "allow")]
    assert U.filter_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_blocks_and_labeller(spark, sf0001):
    b = H.blocks("<p>a <b>b</b>c<p>x &amp; y&nbsp; z<script>no<p></script><ul><li>one<li>two</ul><!-- no --> tail <a href='q>r'>link</a>")
    assert [t for _, t, _ in b] == ["a bc", "x & y z", "one", "two", "tail link"]
    assert H.blocks(None) == [] and H.blocks("") == [] and H.blocks("plain") == [((), "plain", 0)]
    pages = spark.read.parquet(f"{sf0001}/pages.parquet")
    model = H.train(pages, limit=60)
    rows = H.extract(pages, model).collect()
    right = sum(r["text"] == " ".join(t for p, t, _ in H.blocks(r["html"]) if any(x == "article" for x, _ in p)) for r in rows)
    assert right >= 0.95 * len(rows)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "<div" * 1000), (4, "<p>" * 5000)], "page_id long, html string")
    assert [r["text"] for r in H.extract(odd, model).orderBy("page_id").collect()][:2] == ["", ""]


def test_lstm_gradients():
    r = np.random.default_rng(0)
    m = H.BiLstm(5, 3)
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    x, y = r.standard_normal((2, 4, 5)), r.integers(0, 2, (2, 4)).astype(float)
    mask = np.array([[1, 1, 1, 1], [1, 1, 0, 0]], float)

    def loss():
        p = H._sigmoid(m.scores(x, mask))
        return -((y * np.log(p) + (1 - y) * np.log(1 - p)) * mask).sum() / mask.sum()
    for k, g in m.gradients(x, mask, y).items():
        i = np.unravel_index(np.abs(g).argmax(), g.shape)
        e = np.zeros_like(m.p[k])
        e[i] = 1e-3
        keep = m.p[k]
        m.p[k] = keep + e
        up = loss()
        m.p[k] = keep - e
        assert g[i] == pytest.approx((up - loss()) / 2e-3, rel=0.02, abs=1e-4), k
        m.p[k] = keep


def _log10(m, c, toks):
    """The model's log10 probability of one text, token by token: sums of
    weights, a softmax a level, the word's share of its leaf."""
    prev, total = [M.START, M.START], 0.0
    for t in toks:
        i = m.ids.get(t, M.HEAD + zlib.crc32(t) % m.leaves)
        for k, at, rows, hit in m.levels(np.array([i]), np.array([prev[-1]], np.uint64), np.array([prev[-2]], np.uint64)):
            if len(hit):
                z = sum(m.w[k][int(r[0])].astype(float) for r in rows)
                total += math.log10(math.exp(z[hit[0]] - z.max()) / np.exp(z - z.max()).sum())
        if i >= M.HEAD:
            total += math.log10(c[t] + 0.1) - m.log_mass[i - M.HEAD]
        prev.append(zlib.crc32(t))
    return total


def test_lm_scores(spark, sf0001):
    rows = M.with_split(spark.read.parquet(f"{sf0001}/documents.parquet").unionByName(
        spark.createDataFrame([(9001, None, "en", "s", 0), (9002, "", "en", "s", 0), (9002, "", "en", "s", 0), (9004, "w\u00c4x " * 30_000, "en", "s", 0)],
                              "doc_id long, text string, lang string, source string, n_chars long")))
    model, common, n, v, counts = M.train(rows)
    kept = rows.collect()
    held = {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0 for r in kept}
    texts = {r["doc_id"]: r["text"] for r in kept}
    c = Counter(t for r in kept if not held[r["doc_id"]] for t in M.tokens(r["text"]))
    assert (n, v) == (sum(c.values()), len(c))
    leaf = Counter()
    for t in c:
        if t not in model.ids:
            leaf[zlib.crc32(t) % model.leaves] += c[t] + 0.1
    assert 10 ** model.log_mass == pytest.approx([leaf[i] + 0.1 for i in range(model.leaves)])
    # a short broadcast list sends most tokens through the join
    got = M.score(rows, (model, dict(list(common.items())[:M.HEAD]), n, v, counts)).collect()
    assert len(got) == len(kept)
    base = total = 0.0
    for r in got:
        t = M.tokens(texts[r["doc_id"]])
        assert r["held_out"] == held[r["doc_id"]] and r["n_tokens"] == len(t) and r["n_known"] == sum(c[x] > 0 for x in t)
        assert r["base_score"] == pytest.approx(sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in t))
        if len(t) < 400:
            assert r["score"] == pytest.approx(_log10(model, c, t), rel=1e-4)
        if r["held_out"]:
            base, total = base + r["base_score"], total + r["score"]
    assert total > 0.98 * base
    whole = {(r["doc_id"], round(r["score"], 3)) for r in M.score(rows, (model, common, n, v, counts)).collect()}
    assert whole == {(r["doc_id"], round(r["score"], 3)) for r in got}


def test_lm_does_not_depend_on_partitions(spark, sf0001):
    rows = M.with_split(spark.read.parquet(f"{sf0001}/documents.parquet"))
    one, many = (M.train(rows.repartition(k))[0] for k in (1, 16))
    for a, b in zip(one.w, many.w, strict=True):
        assert np.abs(a - b).max() < 1e-3
    empty = M.train(rows.filter("doc_id < 0"))
    assert empty[2:4] == (0, 0) and M.score(rows.filter("doc_id < 0"), empty).count() == 0


def test_lm_learns_a_rare_words_history():
    """A word far below the head is expected after its only predecessor."""
    top = [(f"t{i}".encode(), 1000 - i) for i in range(M.HEAD)]
    m = M.Model(top, np.full(M.HEAD * 4, 5.0))
    docs = [[b"t1", b"rare-a", b"rare-b", b"t2"]] * 50 + [[b"t1", b"t2", b"t3"]] * 200
    seen = m.zeros()
    _, _, y, one, two = m.encode(docs)
    m.observe(y, one, two, seen)
    before = m.log10(y, one, two)[2]
    m.first_step([s.astype(float) for s in seen])
    after = m.log10(y, one, two)[2]
    grad = m.zeros()
    m.gradient(y, one, two, grad)
    m.step(grad, 1.0)
    assert before + 1 < after < m.log10(y, one, two)[2]


def test_lm_is_a_distribution():
    m = M.Model([(f"t{i}".encode(), 900 - i) for i in range(600)], np.linspace(0.1, 9, M.HEAD * 8))
    rng = np.random.default_rng(2)
    for k, w in enumerate(m.w):
        m.w[k] = w + rng.normal(0, 0.3, w.shape).astype(np.float32)
    y = np.arange(M.HEAD + m.leaves)
    p = m.log10(y, np.full(len(y), 3, np.uint64), np.full(len(y), 9, np.uint64))
    p[M.HEAD:] += m.log_mass        # all words of a leaf share its probability
    assert (10 ** p).sum() == pytest.approx(1, abs=1e-3)


def test_lm_encodes_many_texts_by_distinct_words(monkeypatch):
    """Tokens, ranks and entries are those of each text by itself, but a word that
    comes often in a piece is looked up once."""
    odd = "".join(f"A{chr(i)}" for i in [*range(256), 0x2028, 0x3000])
    texts = [None, "", "  ", " a  b ", "\x1c", odd, "Same " * 5000, "\n\n", "a\u00c4 \x00 B", "same a"] * 3
    want = [M.tokens(x) for x in texts]
    for limit in (1, 100, 1 << 20):
        monkeypatch.setattr(M, "PIECE", limit)
        got = []
        for part in M.pieces(pa.record_batch([pa.array(texts)], ["text"]).slice(1), 0):
            words, ids, size = M.encoded(part.column(0))
            flat = [M.as_list(words)[i] for i in ids]
            got += [flat[b - n:b] for b, n in zip(np.cumsum(size), size, strict=True)]
        assert got == want[1:]
    assert not list(M.pieces(pa.record_batch([pa.array([], pa.string())], ["text"]), 0))

    class Ranks(dict):
        asked = 0

        def get(self, *key):
            Ranks.asked += 1
            return super().get(*key)
    m = M.Model([(b"same", 9), (b"a", 8)], np.full(M.HEAD * 4, 5.0))
    words, ids, size = M.encoded(pa.array(texts))
    ranks = Ranks({b"same": 0, b"a": 1, b"b": 7})
    placed = m.place(M.as_list(words), ids, size, ranks)
    assert Ranks.asked <= len(words) < len(ids) / 100
    for a, b in zip(placed, m.encode(want, dict(ranks))[1:], strict=True):
        assert np.array_equal(a, b)
    assert placed[0].tolist() == [ranks.get(x, -1) for d in want for x in d]
    prev = [zlib.crc32(x) for x in want[5]]
    at = sum(map(len, want[:5]))
    assert placed[2][at:at + len(prev)].tolist() == [M.START, *prev[:-1]]
    assert placed[3][at:at + len(prev)].tolist() == [M.START, M.START, *prev[:-2]]


def test_lm_choices_and_sums_are_those_of_a_softmax():
    """Also where rows agree on nothing, so that products of their odds vanish."""
    rng = np.random.default_rng(5)
    m = M.Model([(f"t{i}".encode(), 900 - i) for i in range(600)], np.linspace(0.1, 9, M.HEAD * 8))
    for k, w in enumerate(m.w):
        m.w[k] = (w + rng.normal(0, 1, w.shape)).astype(np.float32)
        m.w[k][:M.BUCKETS, 0] += 60
        m.w[k][M.BUCKETS:2 * M.BUCKETS, 1] += 70
        m.w[k][2 * M.BUCKETS:3 * M.BUCKETS:2, 2] += 80
    y, one, two = rng.integers(0, M.HEAD + m.leaves, 400), *rng.integers(0, 1 << 32, (2, 400), np.uint64)
    seen, grad, want, total = m.zeros(), m.zeros(), m.zeros(), np.zeros(400)
    m.observe(y, one, two, seen)
    m.gradient(y, one, two, grad)
    low = 0
    for k, at, rows, hit in m.levels(y, one, two):
        z = sum(m.w[k][r].astype(float) for r in rows)
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        q, s = m.choices(k, rows)
        low += (m.odds[k][rows[0]] * m.odds[k][rows[1]] * m.odds[k][rows[2]]).sum(1).min() < 1e-20
        assert np.allclose(q / s[:, None], p, rtol=1e-4, atol=1e-20)
        total[at] += np.log10(np.maximum(p[np.arange(len(hit)), hit], 1e-30))
        taken = np.eye(p.shape[1])[hit]
        for r in rows:
            np.add.at(want[k], r, taken)
        assert np.array_equal(seen[k], want[k])
        want[k][:] = 0
        for r in rows:
            np.add.at(want[k], r, (taken - p).astype(np.float32))
        assert np.allclose(grad[k], want[k], atol=1e-3)
    assert low and np.allclose(m.log10(y, one, two) + np.where(y >= M.HEAD, m.log_mass[np.maximum(y - M.HEAD, 0)], 0), total, rtol=1e-5)


def test_add_rows_is_a_sum_by_row():
    rng = np.random.default_rng(3)
    for high in (1, 40, 9000):
        rows, p = rng.integers(0, high, 3000), rng.random((3000, 8), np.float32)
        got, want = np.zeros((high, 8), np.float32), np.zeros((high, 8))
        M.add_rows(got, rows, p)
        np.add.at(want, rows, p)
        assert np.allclose(got, want, rtol=1e-4)


def test_rates_reach_reachable_targets(spark, sf0001, docs, no_docs):
    r = np.random.default_rng(4)
    p = r.dirichlet([0.4] * 4, 400)
    rows = [(i, [float(x) for x in p[i]], int(r.integers(1, 500))) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, p array<double>, n_tokens long")
    out = df.withColumn("rate", X._rate(X.fit_rates(df, (0.4, 0.1, 0.3, 0.2)))).collect()
    total = sum(x["n_tokens"] for x in out)
    got = np.sum([np.array(x["p"]) * x["n_tokens"] * x["rate"] for x in out], 0) / total
    assert min(x["rate"] for x in out) >= 0 and got == pytest.approx([0.4, 0.1, 0.3, 0.2], abs=1e-4)
    labels = spark.read.parquet(f"{sf0001}/labels.parquet")
    for d in (docs, no_docs):
        assert X.mix(d, labels).count() == d.count()
    assert X.mix(docs, labels.limit(0)).count() == docs.count()


def test_pipeline_stages(spark, sf0001):
    import corpus_pipeline as cp
    from textloom.llm.common import stored, table

    d = table(spark, sf0001, "documents")
    cols, ids = d.columns, {r[0] for r in d.select("doc_id").collect()}
    for name, stage in cp.STAGES:
        d = stored(stage(spark, d, sf0001), "t-" + name)
        now = {r[0] for r in d.select("doc_id").collect()}
        assert now <= ids and len(now) == d.count()
        ids = now
        if name != cp.STAGES[-1][0]:
            assert d.columns == cols
    assert d.filter(F.col("rate") < 0).count() == 0


def test_posteriors_stream_in_small_batches(spark, docs, monkeypatch):
    """A worker turns few texts into Python objects at once; columns come through
    with their order, types and names, repeats and nulls included."""
    import pyarrow as pa

    model, kinds = X.Softmax(len(X.DOMAINS)), {}
    model.w[:] = np.random.default_rng(3).normal(size=model.w.shape)
    wide = docs.withColumns({"p": F.lit("old"), "_p": F.lit(1.5), "_n": F.array("doc_id"), "at": F.lit("2024-05-06 07:08:09").cast("timestamp")})

    def held(self, run, schema):
        kinds["run"] = run
        return plain(self, run, schema)
    plain = type(wide).mapInArrow
    monkeypatch.setattr(type(wide), "mapInArrow", held)
    out = X.with_posteriors(wide, model)
    assert out.columns == [*wide.columns, "n_tokens"]
    rows = out.collect()
    assert sorted(map(repr, (r[:5] + r[6:-1] for r in rows))) == sorted(map(repr, (r[:5] + r[6:] for r in wide.collect())))
    for r in rows:
        f, n = X.features(r["text"])
        assert r["n_tokens"] == n and np.allclose(r["p"], model.posterior(f))
    assert X.with_posteriors(wide, model, ["doc_id"]).columns == ["doc_id", "p", "n_tokens"]
    assert X.with_posteriors(wide, model, []).count() == docs.count()
    X.with_posteriors(docs, model, [])
    many = pa.RecordBatch.from_arrays([pa.array([f"w{i} some words" for i in range(1000)])], ["text"])
    seen = [b.num_rows for b in kinds["run"](iter([many]))]
    assert sum(seen) == 1000 and max(seen) <= X.ROWS


def test_workers_get_texts_in_small_batches(spark, docs, monkeypatch):
    """Tables written from texts are written with bounded Arrow batches, mixed rows
    do not go through Arrow, and the session's own settings stay."""
    import pyarrow as pa

    from textloom.llm import common as C
    from textloom.llm import spans as P

    key = "spark.sql.execution.arrow.maxBytesPerBatch"

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "size"])
    wide = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("x"), 2000).alias("text")).mapInArrow(sizes, "n long, size long")
    assert spark.conf.get(key, None) is None
    with C.small_batches(spark):
        got = wide.collect()
    assert sum(r["n"] for r in got) == 3000 and len(got) > 3 and max(r["size"] for r in got) < 1.5 * C.BATCH_BYTES
    with pytest.raises(ZeroDivisionError), C.small_batches(spark):
        1 / 0
    assert spark.conf.get(key, None) is None
    spark.conf.set(key, "12345")
    try:
        with C.small_batches(spark):
            assert spark.conf.get(key) == "12345"
        assert spark.conf.get(key) == "12345"
    finally:
        spark.conf.unset(key)

    bounds = {}

    def recorded(df, name, *a):
        bounds[name] = spark.conf.get(key, None)
        return C_stored(df, name, *a)
    C_stored = C.stored
    for module in (C, X, P):
        monkeypatch.setattr(module, "stored", recorded)
    labels = spark.createDataFrame([(i, i % 2, i // 2 % 2) for i in range(10)], "doc_id long, quality int, toxic int")
    mixed = X.mix(docs, labels)
    P.dedup_spans(docs)
    C.without_rows(docs.withColumn("row", F.lit(1)), "row", docs.select("doc_id").limit(0))
    small = str(C.BATCH_BYTES)
    assert [bounds[n] for n in ("mix-posteriors", "span-runs", "gone-rows")] == [small] * 3
    assert spark.conf.get(key, None) is None
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and "Arrow" not in plan
    model = X.train(docs, labels)
    assert mixed.columns == [*docs.columns, "p", "n_tokens", "rate"]
    assert sorted(map(repr, mixed.drop("rate").collect())) == sorted(map(repr, X.with_posteriors(docs, model, docs.columns).collect()))
