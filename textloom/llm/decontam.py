"""Benchmark decontamination (operator 5): BM25 index with block-max WAND.

Test items form an inverted index: postings by item number with impacts (BM25
weight over the item's score against itself, so 1 is a full match), in blocks
of ``BLOCK`` with their largest impact. Every training text is cut into
overlapping passages (twice the longest item, by half), so each stretch as long
as an item lies whole in some passage; every passage is a query for all items
that score at least ``THRESHOLD``. The sum of a passage's largest impacts is
its WAND bound, taken for all passages of a batch at once; those that reach
the threshold are bounded again by the block maxima of short spans of items,
and what is left is evaluated item at a time with pivots and block maxima.

A retrieved item is verified on five-word shingles (the whole item if shorter)
of the passage: its question (all but the last sentence) and its answer (the last
one, or an ``answer`` column) must both be found to 0.8 or more; an item without an
answer is its question.

The index is broadcast. Items of more than ``PART_BYTES`` are dealt to parts by a
hash of their text, each part is indexed and searched by itself with the statistics
(item count, mean length, document frequencies, longest item) of all items, so the
hits do not depend on the parts. A part's index is what the driver and a worker
hold; one item is the least part.

Defined results: null or empty texts give no hit, null or empty items are not
indexed; repeated items and rows give a hit each; an empty table gives no
rows; extra columns are ignored by the search.
"""

from __future__ import annotations

import math
import re
import string
from bisect import bisect_left
from collections import Counter
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import Shared, numbered, stored, table, without_rows

K1, B = 1.2, 0.75
THRESHOLD = 0.6
OVERLAP = 0.8
SHINGLE = 5
BLOCK = 64
SPAN = 4          # items of a span whose block maxima bound a passage
CELLS = 1 << 14   # passages x spans that are bounded at once
PART_BYTES = 16 << 20      # text of the items of one index, which takes some 16 times as much
_SIGNS = string.punctuation.encode()
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def tokens(text: str | None) -> list[bytes]:
    """ASCII-lowered words without outer ASCII punctuation."""
    return list(filter(None, map(bytes.strip, (text or "").encode().lower().split(), repeat(_SIGNS))))


def shingles(w: list[bytes]) -> set:
    return {tuple(w[i:i + SHINGLE]) for i in range(max(1, len(w) - SHINGLE + 1))} if w else set()


def split_item(text: str, answer: str | None = None) -> tuple[list, list]:
    """Words of question and answer."""
    if answer is not None:
        return tokens(text), tokens(answer)
    s = [x for x in _SENTENCE.split(text.strip()) if x]
    return (tokens(" ".join(s[:-1])), tokens(s[-1])) if len(s) > 1 else (tokens(text), [])


class Index:
    """Block-max BM25 index of ``(item_id, text[, answer])`` rows. ``stats``:
    number of items, their words, the longest one and the document frequencies,
    where there are more items than these."""

    def __init__(self, items, stats=None):
        self.ids, self.parts, docs = [], [], []
        for item in sorted(items, key=str):
            q, a = split_item(item[1] or "", item[2] if len(item) > 2 else None)
            if q or a:
                self.ids.append(item[0])
                self.parts.append((q, a))
                docs.append(Counter(q + a))
        size = [sum(d.values()) for d in docs]
        n, total, longest, df = stats or (len(docs), sum(size), max(size, default=1), Counter(t for d in docs for t in d))
        mean = total / max(1, n)
        idf = {t: math.log(1 + (n - c + 0.5) / (c + 0.5)) for t, c in df.items()}
        self.terms, posts = {}, []
        weights = [{t: idf[t] * c * (K1 + 1) / (c + K1 * (1 - B + B * size[i] / mean)) for t, c in d.items()} for i, d in enumerate(docs)]
        for i, w in enumerate(weights):
            full = sum(w.values())
            for t, x in w.items():
                at = self.terms.setdefault(t, len(self.terms))
                if at == len(posts):
                    posts.append(([], []))
                posts[at][0].append(i)
                posts[at][1].append(x / full)
        self.posts = posts
        # (last item of the block, largest impact in it) by term
        self.blocks = [([p[0][min(k + BLOCK, len(p[0])) - 1] for k in range(0, len(p[0]), BLOCK)],
                        [max(p[1][k:k + BLOCK]) for k in range(0, len(p[0]), BLOCK)]) for p in posts]
        self.top = np.array([max(p[1]) for p in posts] + [0.0])
        self.span = longest
        # spans of SPAN neighbouring items and a term's largest impact in each; term
        # t has those from span_from[t] to span_from[t + 1]
        spans = []
        for items, impact in posts:
            at = np.asarray(items) // SPAN
            first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
            spans.append((at[first], np.maximum.reduceat(np.asarray(impact), first)))
        self.n_spans = -(-len(self.ids) // SPAN)
        self.span_from = np.cumsum([0, *(len(at) for at, _ in spans)])
        self.span_at = np.concatenate([np.empty(0, np.int64), *(at for at, _ in spans)])
        self.span_most = np.concatenate([np.empty(0), *(most for _, most in spans)])

    def masses(self, row: np.ndarray, term: np.ndarray, rows: int) -> np.ndarray:
        """By row and span, the sum of the row's terms' block maxima."""
        size = self.span_from[term + 1] - self.span_from[term]
        at = np.repeat(self.span_from[term] - np.cumsum(size) + size, size) + np.arange(size.sum())
        cell = np.repeat(row, size) * self.n_spans + self.span_at[at]
        return np.bincount(cell, self.span_most[at], rows * self.n_spans).reshape(rows, self.n_spans)

    def reachable(self, query: np.ndarray, theta: float) -> bool:
        """Whether the block maxima of some span of items reach ``theta``."""
        return self.masses(np.zeros(len(query), np.int64), query, 1).max() >= theta - 1e-9

    def likely(self, step: np.ndarray, term: np.ndarray, n: int, theta: float):
        """Of the passages of a text (step k and the next one, by ``step``), those
        whose steps' block maxima reach ``theta`` together: all that ``reachable``
        finds, some more where a term is in both steps."""
        rows = CELLS // self.n_spans
        if not rows:
            yield from range(n)
        for k in range(0, n, rows) if rows else ():
            end = min(n, k + rows)
            own = slice(*np.searchsorted(step, (k, end + 1)))
            m = self.masses(step[own] - k, term[own], end + 1 - k)
            yield from (k + np.flatnonzero((m[:-1] + m[1:]).max(1) >= theta - 2e-9)).tolist()

    def search(self, query: list[int], theta: float) -> list[tuple[int, float]]:
        """All items scoring ``theta`` or more (document at a time)."""
        cur = [[self.posts[t][0][0], 0, t] for t in query]
        out, eps = [], 1e-9
        while True:
            cur.sort()
            bound, pivot = 0.0, -1
            for k, c in enumerate(cur):
                bound += self.top[c[2]]
                if bound >= theta - eps:
                    pivot = k
                    break
            if pivot < 0:
                return out
            item = cur[pivot][0]
            while pivot + 1 < len(cur) and cur[pivot + 1][0] == item:
                pivot += 1
            # block maxima at the pivot item, and the first item behind them
            total, until = 0.0, math.inf
            for c in cur[:pivot + 1]:
                last, most = self.blocks[c[2]]
                b = bisect_left(last, item)
                if b < len(last):
                    total += most[b]
                    until = min(until, last[b] + 1)
            if total >= theta - eps:
                score, to = 0.0, item + 1
                for c in cur[:pivot + 1]:
                    items, impact = self.posts[c[2]]
                    at = bisect_left(items, item, c[1])
                    if at < len(items) and items[at] == item:
                        score += impact[at]
                if score >= theta - eps:
                    out.append((item, score))
            else:
                to = until if pivot + 1 >= len(cur) else min(until, cur[pivot + 1][0])
                to = max(to, item + 1)
            if to is math.inf:
                return out
            kept = []
            for k, c in enumerate(cur):
                if k <= pivot and c[0] < to:
                    items = self.posts[c[2]][0]
                    at = bisect_left(items, to, c[1])
                    if at == len(items):
                        continue
                    c = [items[at], at, c[2]]
                kept.append(c)
            cur = kept

    def overlaps(self, item: int, passage: set, plain: set) -> tuple[float, float, float]:
        """Shares of question, answer and whole item found in a passage."""
        def share(w):
            if not w:
                return 1.0
            if len(w) < SHINGLE:
                return float(tuple(w) in plain or any(tuple(w) == s[k:k + len(w)] for s in passage for k in range(SHINGLE - len(w) + 1)))
            s = shingles(w)
            return len(s & passage) / len(s)
        q, a = self.parts[item]
        return share(q), share(a), share(q + a)


def _hits(index: Index, docs, theta: float):
    """Best verified hit per document and item of a small batch."""
    width, step = 2 * index.span, index.span
    get, none = index.terms.get, len(index.terms)
    for doc, text in docs:
        w = tokens(text)
        if not w:
            continue
        ids = np.fromiter(map(get, w, repeat(none)), np.int64, len(w))
        # bound of each passage by steps: distinct terms at most once a step
        known = np.flatnonzero(ids < none)
        if not len(known):
            continue
        pair = np.unique((known // step) * (none + 1) + ids[known])
        n = (len(w) - 1) // step + 1
        at, term = np.divmod(pair, none + 1)
        mass = np.bincount(at, index.top[term], n)
        bound = mass + np.append(mass[1:], 0)
        if n > 1:
            bound[-1] = 0       # the last step lies whole in the passage before
        if bound.max() < theta:
            continue
        best = {}
        for k in index.likely(at, term, n, theta):
            if bound[k] < theta:
                continue
            a = k * step
            query = np.unique(ids[a:a + width])
            query = query[query < none]
            if index.top[query].sum() < theta or not index.reachable(query, theta):
                continue
            found = index.search(query.tolist(), theta)
            if found:
                part = w[a:a + width]
                sh = shingles(part)
                for item, score in found:
                    q, x, both = index.overlaps(item, sh, {tuple(part)} if len(part) < SHINGLE else set())
                    if q >= OVERLAP and x >= OVERLAP:
                        best[item] = max(best.get(item, (0,)), (score, q, x))
        for item, (score, q, x) in sorted(best.items()):
            yield doc, index.ids[item], score, q, x


def _item_terms(items: DataFrame, cols: list) -> DataFrame:
    """``part, term, df, words, items, longest`` by part: a row for each term, and
    one without a term for the part's items."""
    def run(batches):
        for b in batches:
            rows = Counter()
            size = {}
            for p, *item in zip(*(c.to_pylist() for c in b.columns), strict=True):
                q, a = split_item(item[0] or "", item[1] if len(item) > 1 else None)
                if q or a:
                    rows.update((p, t) for t in set(q + a))
                    n, total, longest = size.get(p, (0, 0, 0))
                    size[p] = (n + 1, total + len(q + a), max(longest, len(q + a)))
            out = [(p, t, c, 0, 0, 0) for (p, t), c in rows.items()] + [(p, None, 0, *x) for p, x in size.items()]
            names = ["part", "term", "df", "items", "words", "longest"]
            types = [pa.int64(), pa.binary(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 6, types, strict=True)], names)
    found = items.select("_part", *cols).mapInArrow(run, "part long, term binary, df long, items long, words long, longest long")
    return found.groupBy("part", "term").agg(*[F.sum(c).alias(c) for c in ("df", "items", "words")], F.max("longest").alias("longest"))


def indexes(items: DataFrame, part_bytes: int = PART_BYTES):
    """The indexes of all items, one at a time, each of a bounded part."""
    cols = [c for c in ("item_id", "text", "answer") if c in items.columns]
    size = items.agg(*[F.coalesce(F.sum(F.octet_length(c)), F.lit(0)) for c in cols[1:]]).first()
    parts = max(1, -(-sum(size) // part_bytes))
    if parts == 1:
        yield Index([tuple(r) for r in items.select(*cols).collect()])
        return
    items = stored(items.select(*cols, F.pmod(F.xxhash64(*cols), F.lit(parts)).alias("_part")), "decontam-items")
    terms = stored(_item_terms(items, cols[1:]), "decontam-terms")
    n, total, longest = terms.agg(F.sum("items"), F.sum("words"), F.max("longest")).first()
    df = stored(terms.filter("term is not null").groupBy("term").agg(F.sum("df").alias("df")), "decontam-df")
    for part in range(parts):
        mine = terms.filter((F.col("part") == part) & F.col("term").isNotNull()).select("term")
        stats = (n, total, longest, {bytes(t): c for t, c in df.join(mine, "term").collect()})
        yield Index([tuple(r) for r in items.filter(F.col("_part") == part).select(*cols).collect()], stats)


def contaminated(docs: DataFrame, items: DataFrame, theta: float = THRESHOLD, part_bytes: int = PART_BYTES) -> DataFrame:
    """``doc_id, item_id, score, question_overlap, answer_overlap`` of every
    verified hit."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    return reduce(DataFrame.unionByName, [_search(docs, index, theta) for index in indexes(items, part_bytes)])


def _search(docs: DataFrame, index: Index, theta: float) -> DataFrame:
    shared = Shared(docs.sparkSession, index)

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 64):
                rows = list(_hits(shared.value, zip(*(c.to_pylist() for c in b.slice(at, 64).columns), strict=True), theta))
                cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int64(), pa.int64(), *[pa.float64()] * 3], strict=True)],
                                                 ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])
    return docs.mapInArrow(
        run, "doc_id long, item_id long, score double, question_overlap double, answer_overlap double")


def drop_contaminated(docs: DataFrame, items: DataFrame, scan: bool = False) -> DataFrame:
    """The documents without a verified hit, row by row. ``scan``: see
    ``numbered``."""
    rows, row = numbered(docs, "decontam-docs", scan)
    hits = contaminated(rows.select(F.col(row).alias("doc_id"), "text"), items)
    return without_rows(rows, row, hits.select(F.col("doc_id").alias("row")).distinct())


def op5_decontaminate(spark, sf_dir) -> DataFrame:
    """Verified hits of every document against every benchmark item."""
    out = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.withColumn("contaminated", F.lit(True))
