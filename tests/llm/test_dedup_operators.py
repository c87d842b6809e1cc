"""SimHash, sentence spans and decontamination against brute force."""

import itertools
import random

from textloom.llm import decontam as D
from textloom.llm import simhash as S
from textloom.llm import spans as P


def brute_components(fps, bits=2):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in itertools.combinations(fps, 2):
        if bin((a ^ b) & (1 << 64) - 1).count("1") <= bits:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {f: find(f) for f in fps}


def test_links_find_every_component(spark):
    r = random.Random(3)
    fps = {r.getrandbits(64) - (1 << 63) for _ in range(300)}
    for f in list(fps)[:60]:            # crowded neighbourhoods, and chains
        x = f
        for _ in range(4):
            x ^= (1 << r.randrange(63)) | (1 << r.randrange(63))
            fps.add(x)
    hub = next(iter(fps))
    fps |= {hub ^ (1 << i) for i in range(63)}
    want = brute_components(fps)
    for bucket in (2, S.BUCKET):
        got = {x["node"]: x["root"] for x in S.components(S.links(spark.createDataFrame([(f,) for f in fps], "fp long"), bucket=bucket)).collect()}
        assert all(got.get(f, f) == w for f, w in want.items())


def test_thresholds_cover_every_pair_within_reach():
    import numpy as np

    r = np.random.default_rng(1)
    x = r.integers(0, 2, (500, 64))
    for n in (100, 10**6, 10**11):
        parts = S.plan((x.T @ x).astype(float) * n / 500, n, 2)
        for bits in itertools.combinations(range(64), 2):
            assert any(len(set(bits) & set(g)) <= t for g, t in parts)


def test_near_duplicates_edge_rows(spark, docs, no_docs):
    got = [(r["doc_id"], r["component_id"]) for r in S.near_duplicates(docs).collect()]
    assert len(got) == docs.count()
    assert {c for d, c in got if d in (6, 7)} == {6}
    kept = S.keep_first(docs)
    assert kept.columns == docs.columns and kept.filter("doc_id = 7").count() == 0 and kept.filter("doc_id = 6").count() == 1
    assert S.near_duplicates(no_docs).count() == 0


def brute_spans(rows):
    first, out = {}, {}
    for d, t in rows:
        for i, j, hi, lo in P.runs(t):
            first.setdefault((hi, lo), (d, i))
    for d, t in rows:
        gone = {k for i, j, hi, lo in P.runs(t) if first[hi, lo] != (d, i) for k in range(i, j + 1)}
        out[d] = "".join(x for k, x in enumerate(P.pieces(t)) if k not in gone)
    return out


def test_spans_match_brute_force(spark):
    r = random.Random(5)
    words = [f"w{i}" for i in range(500)]
    passage = " ".join(r.choice(words) for _ in range(60)) + "."
    rows = []
    for i in range(30):
        s = [" ".join(r.choice(words) for _ in range(r.randrange(1, 30))) + r.choice([". ", "\n", "! "]) for _ in range(8)]
        if i % 3 == 0:
            s.insert(4, "\n" + passage + "\n")
        rows.append((i, "".join(s)))
    rows.append((30, rows[1][1]))
    for _, t in rows:
        assert "".join(P.pieces(t)) == t
    got = {x["doc_id"]: x["text"] for x in P.dedup_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_spans(rows)
    assert passage in got[0] and not any(passage in got[i] for i in range(3, 30, 3))


def removed_words(rows):
    """Per text, in order: whether each word is covered, by the module's pieces and runs."""
    first, out = {}, []
    for d, t in rows:
        found = list(P.runs(t))
        for i, j, hi, lo in found:
            first.setdefault((hi, lo), (d, i))
        gone = {k for i, j, hi, lo in found if first[hi, lo] != (d, i) for k in range(i, j + 1)}
        out.append([(w, k in gone) for k, p in enumerate(P.pieces(t)) for w in p.encode().lower().split()])
    return out


def seen_windows(words_of, n=50):
    """Per text, the ranges of words in windows of ``n`` that stood before."""
    seen, out = set(), []
    for words in words_of:
        hit = [False] * len(words)
        for i in range(len(words) - n + 1):
            w = tuple(words[i:i + n])
            if w in seen:
                hit[i:i + n] = [True] * n
            seen.add(w)
        out.append(hit)
    return out


def least_cover(rows):
    """Of the texts that repeat windows: the least covered share of their repeated words."""
    marked = removed_words(rows)
    shares = [sum(c for (_, c), h in zip(m, hit, strict=True) if h) / sum(hit)
              for m, hit in zip(marked, seen_windows([[w for w, _ in m] for m in marked]), strict=True) if any(hit)]
    return len(shares), min(shares)


def test_short_sentences_are_covered():
    r = random.Random(7)
    passages = ["".join(r.choice(["{}. ", "{} {}\n", "{}! ", "{} {} {}. "]).format(*r.choices(range(10**6), k=3)) for _ in range(60))
                for _ in range(20)]
    rows = []
    for i in range(40):
        own = [" ".join(f"o{r.randrange(10**9)}" for _ in range(9)) + ". " for _ in range(6)]
        rows.append((i, "".join(own[:3]) + passages[i % 20] + "".join(own[3:])))
    assert least_cover(rows) == (20, 1.0)


def test_passages_inside_long_sentences_are_covered():
    r = random.Random(11)
    passages = [[f"p{r.randrange(10**6)}" for _ in range(r.randrange(60, 200))] for _ in range(40)]
    rows = []
    for i in range(80):
        own = [f"o{r.randrange(10**9)}" for _ in range(r.randrange(40, 80))]
        at, p = r.randrange(5, 35), list(passages[i % 40])
        if i >= 40:                      # one inserted word, behind which the cuts must meet again
            p.insert(r.randrange(3, 9), f"x{i}")
        rows.append((i, " ".join(own[:at] + p + own[at:]) + "."))
    n, least = least_cover(rows)
    assert n == 40 and least > 0.6
    assert all("".join(P.pieces(t)) == t for _, t in rows)


def test_every_fifty_word_window_has_a_run():
    r = random.Random(12)
    for _ in range(300):
        p = [f"p{r.randrange(10**6)}" for _ in range(50)]
        rows = [(i, " ".join([f"o{r.randrange(10**9)}" for _ in range(r.randrange(1, 30))] + p
                             + [f"o{r.randrange(10**9)}" for _ in range(r.randrange(1, 30))])) for i in range(2)]
        marked = removed_words(rows)
        assert sum(c for _, c in marked[1]) >= P.MIN_RUN_WORDS


def test_spans_edge_rows(spark, docs, no_docs):
    out = P.dedup_spans(docs)
    assert out.count() == docs.count() and out.filter("text is null").count() == 1
    assert out.columns == [*docs.columns, "n_sentences", "n_removed"]
    assert P.dedup_spans(no_docs).count() == 0


def test_wand_equals_full_scoring(sf0001):
    import pyarrow.parquet as pq

    rows = [tuple(r.values()) for r in pq.read_table(f"{sf0001}/benchmark.parquet").to_pylist()]
    r = random.Random(2)
    vocab = sorted({w for _, t in rows for w in D.tokens(t)})
    many = rows + [(1000 + i, " ".join(x.decode() for x in r.sample(vocab, 12))) for i in range(300)]
    index = D.Index(many)
    for k in range(40):
        q = D.tokens(many[k * 7 % len(many)][1])[: 5 + k % 30] + r.sample(vocab, 10)
        ids = sorted({index.terms[t] for t in q})
        score = {}
        for t in ids:
            for i, x in zip(*index.posts[t], strict=True):
                score[i] = score.get(i, 0) + x
        for theta in (0.2, 0.5, 0.9):
            assert sorted(i for i, _ in index.search(ids, theta)) == sorted(i for i, s in score.items() if s >= theta - 1e-9)


def test_decontamination_finds_planted_items(spark, sf0001, docs, no_docs):
    items = spark.read.parquet(f"{sf0001}/benchmark.parquet")
    some = [tuple(x) for x in items.select("item_id", "text").orderBy("item_id").limit(5).collect()]
    filler = " ".join(f"zz{i}" for i in range(300))
    rows = [(i, f"{filler} {t.upper() if i % 2 and t.isascii() else t}\n{filler}") for i, t in some] + [(100, filler), (101, None), (102, "")]
    got = {(x["doc_id"], x["item_id"]) for x in D.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()}
    assert {(i, i) for i, _ in some} <= got and not {d for d, _ in got} & {100, 101, 102}
    assert D.drop_contaminated(docs, items).columns == docs.columns
    assert D.contaminated(no_docs, items).count() == 0
    assert D.contaminated(docs, items.limit(0)).count() == 0


def test_plain_scans_are_not_copied(spark, docs, tmp_path):
    """Rows by their places in files give what numbered copies give, and
    columns of clashing names come through."""
    from pyspark.sql import functions as F

    from textloom.llm import quality as Q

    path = str(tmp_path / "docs")
    wide = docs.withColumns({c: F.lit(c) for c in ("_row", "row", "spans", "_row_x", "n", "gone")})
    wide.repartition(3).write.parquet(path)
    scan, items = spark.read.parquet(path), spark.createDataFrame([(1, "word1x1 word2x2 word3x3 word4x4 word5x5 word6x6 word7x7")], "item_id long, text string")
    for run in (lambda d, s: S.keep_first(d, scan=s), lambda d, s: P.dedup_spans(d, s), lambda d, s: Q.keep_quality(d, s),
                lambda d, s: D.drop_contaminated(d, items, s)):
        a, b = run(scan, True), run(scan, False)
        assert a.columns == b.columns and set(wide.columns) <= set(a.columns)
        assert sorted(map(repr, a.drop("text").collect())) == sorted(map(repr, b.drop("text").collect()))


def test_a_hot_run_is_found_in_every_text(spark):
    passage = " ".join(f"hot{i}" for i in range(40)) + "."
    rows = [(i, f"own {i} text here. {passage} end {i}.") for i in range(500)]
    got = P.dedup_spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()
    assert sum(passage in r["text"] for r in got) == 1 and {r["doc_id"] for r in got if passage in r["text"]} == {0}


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    rows = [(i, f"{' '.join(f'w{(i * 31 + k) % 50}' for k in range(60))}. own{i}.") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(tuple(r) for r in P.dedup_spans(df).collect())
    monkeypatch.setattr(P, "repeated_filter", lambda found: b"\xff" * (P.FILTER_BITS // 8))
    assert sorted(tuple(r) for r in P.dedup_spans(df).collect()) == want


def test_merged_spans_cover_the_same_pieces():
    import pyarrow as pa

    r = random.Random(3)
    rows = [[(r.randrange(300) << 20) | r.randrange(8) for _ in range(r.randrange(1, 60))] for _ in range(50)] + [[5 << 20 | 0xFFFFE, (5 + 0xFFFFF) << 20 | 7]]
    got = next(P._merged([pa.RecordBatch.from_arrays([pa.array(range(51)), pa.array(rows, pa.list_(pa.int64()))], ["row", "spans"])]))

    def pieces(spans):
        return {k for s in spans for k in range(s >> 20, (s >> 20) + (s & 0xFFFFF) + 1)}
    for want, x in zip(rows, got["spans"].to_pylist(), strict=True):
        assert pieces(want) == pieces(x) and len(x) <= len(want)


def test_question_and_answer_must_both_be_found(spark):
    """A question without its answer is no hit, a glued or damaged end of a text
    does not hide one, and an item without an answer is its question."""
    q = "which of the seven rivers in the old valley runs north past the ruined tower"
    a = "the river of stones runs north past it all year"
    items = spark.createDataFrame([(1, q, a), (2, "one sentence only that has no answer of its own here", None)], "item_id long, text string, answer string")
    rows = [(1, f"x1 x2 {q} {a} x3"), (2, f"x1 x2 {q} x3"), (3, f"{a} x3"), (4, f"%%% {q.upper()}? &&&{a}.%%%x9 x3"), (5, f"{q}? {a}.###"),
            (6, "one sentence only that has no answer of its own here")]
    got = {(x["doc_id"], x["item_id"]) for x in D.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()}
    assert got >= {(1, 1), (5, 1), (6, 2)} and not got & {(2, 1), (3, 1)}


def test_items_in_parts_give_the_hits_of_one_index(spark, sf0001):
    items = spark.read.parquet(f"{sf0001}/benchmark.parquet")
    docs = spark.read.parquet(f"{sf0001}/documents.parquet")
    first = items.limit(3).selectExpr("item_id + 5000 as doc_id", "concat('aa bb cc ', text, ' dd') as text")
    docs = docs.select("doc_id", "text").unionByName(first)
    one, many = ({(r["doc_id"], r["item_id"]): r["score"] for r in D.contaminated(docs, items, part_bytes=b).collect()} for b in (D.PART_BYTES, 1500))
    assert len(list(D.indexes(items, 1500))) > 2
    assert one.keys() == many.keys() and len(one) >= 3
    assert all(abs(one[k] - many[k]) < 1e-9 for k in one)


def test_passages_of_a_text_are_bounded_at_once(sf0001, monkeypatch):
    """Texts get the hits of full scoring, however many spans are bounded at
    once; only few passages are bounded one by one."""
    import pyarrow.parquet as pq

    items = [tuple(r.values()) for r in pq.read_table(f"{sf0001}/benchmark.parquet").to_pylist()]
    r = random.Random(5)
    vocab = sorted({w.decode() for _, t in items for w in D.tokens(t)})

    def filler(n):
        return " ".join(r.choice(vocab) if r.random() < 0.3 else f"zz{r.randrange(10**6)}" for _ in range(n))
    docs = [(i, f"{filler(r.randrange(400))} {items[i % len(items)][1]} {filler(r.randrange(400))}") for i in range(40)]
    docs += [(40, None), (41, ""), (42, " .. ,"), (43, items[0][1]), (44, filler(3000)), (45, " ".join(t for _, t in items))]
    exact, calls = D.Index.reachable, []
    monkeypatch.setattr(D.Index, "reachable", lambda *a: calls.append(1) or exact(*a))
    index = D.Index(items)
    got = {}
    for cells in (D.CELLS, 2 * index.n_spans, 1):
        monkeypatch.setattr(D, "CELLS", cells)
        calls.clear()
        got[cells] = list(D._hits(index, docs, D.THRESHOLD))
        passages = sum(len(D.tokens(t)) // index.span + 1 for _, t in docs)
        assert len(calls) < passages / 2 or cells == 1
    want = got.pop(1)           # none bounded at once
    assert all(x == want for x in got.values())
    assert {(d, items[d % len(items)][0]) for d in range(40)} | {(45, i) for i, _ in items} <= {x[:2] for x in want}
    assert list(D._hits(D.Index([]), docs, D.THRESHOLD)) == []


def test_runs_and_texts_unfold_in_small_batches():
    """A worker unfolds few rows of a large batch at once, with the same result."""
    import numpy as np
    import pyarrow as pa

    texts = [None if i % 50 == 0 else f"One {i} a. Two {i} b. Three {i} c.\nFour {i} d." for i in range(1000)] + [""]
    spans = [[1 << 20 | 1] if i % 3 == 0 else None if i % 3 == 1 else [] for i in range(1001)]
    got = P._without(pa.array(texts), pa.array(spans, pa.list_(pa.int64()))).to_pylist()
    for t, lost, x in zip(texts, spans, got, strict=True):
        p = P.pieces(t or "")
        keep = p[:1] + p[3:] if lost and t is not None else p
        assert x == {"text": None if t is None else "".join(keep), "n": len(p), "gone": len(p) - len(keep)}
    assert len(P._without(pa.array([], pa.string()), pa.array([], pa.list_(pa.int64())))) == 0

    r = random.Random(8)
    n = [r.randrange(5) for _ in range(1000)]
    hashes = [np.array([r.randrange(-1 << 63, 1 << 63) for _ in range(2 * k)], np.int64).tobytes() for k in n]
    held = [np.arange(k, dtype=np.int64).tobytes() for k in n]
    batch = pa.RecordBatch.from_arrays([pa.array(range(1000)), pa.array(range(1000)), pa.array(held), pa.array(hashes)], ["doc", "row", "spans", "hashes"])
    out = list(P._passing(iter([batch]), np.full(P.FILTER_BITS // 8, 255, np.uint8)))
    assert max(len(set(b.column(3).to_pylist())) for b in out) <= P.ROWS
    rows = [x for b in out for x in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    assert [(hi, lo) for hi, lo, *_ in rows] == [tuple(x) for h in hashes for x in np.frombuffer(h, np.int64).reshape(-1, 2).tolist()]
    assert [(d, k) for *_, d, k, s in rows] == [(i, i) for i, k in enumerate(n) for _ in range(k)]
