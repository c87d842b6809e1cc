"""HTML extraction (operator 6): recurrent block labeller.

A page is cut into leaf blocks (text between block-level tags). Each block is a
vector: hashed tag path (tags, class and id words), hashed words of its text,
and a few shape numbers. A numpy bidirectional LSTM reads the whole sequence of a
page and labels every block as main text or not, so the whole document is its
context. The main text is the labelled blocks in page order.

The labeller is trained here, on a bounded sample (``TRAIN_PAGES`` pages, smallest
hash of the id first) whose blocks are labelled by their semantic elements
(``article``/``main`` against ``nav``, ``footer``, ``aside``, form, advert and comment
containers). Each page is also shown in altered layouts: other container tags
and class names, and added menus, notices, sidebars and comments made of other
pages' text, so that no single tag decides.

Scripts, styles, comments and the head are markup and never blocks.

Defined results: null or empty html gives the empty text; pages without tags
are one block; unclosed and cut-off tags are tolerated; repeated rows get the
same text; an empty table gives no rows (training needs one labelled page,
else nothing is main text); other input columns are kept, ``text`` and
``n_chars`` replace columns of the same name.
"""

from __future__ import annotations

import html as _html
import re
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.common import Shared, table

TRAIN_PAGES = 200     # bound of the labeller's sample
PATH, WORDS, SHAPE = 96, 32, 8
HIDDEN = 16
STEP_CELLS = 4096     # blocks of a padded batch: bounds the memory of a step

# Element names with a meaning in HTML.
RAW = "script style noscript template textarea title svg iframe".split()
INLINE = set("a abbr b bdi bdo br cite code data del dfn em font i ins kbd label mark q s samp small span strong sub sup time tt u var wbr img".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
GOOD, BAD = {"article", "main"}, {"nav", "footer", "header", "aside", "form", "menu", "dialog", "button", "select"}
BAD_CLASS = re.compile(r"(?:^|[-_ ])(?:ad|ads|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu|header|footer|sidebar|side|widget|related|share|social|cookie\w*|consent|notice|alert|popup|newsletter|subscribe|comments?|replies|reply|breadcrumbs?|login|search)(?:$|[-_ ])", re.I)
_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"?|'[^']*'?)*)>?|<[!?][^>]*>?|[^<]+|<", re.S)
_ATTR = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


def blocks(page: str | None) -> list[tuple[tuple, str, int]]:
    """``(path, text, characters inside links)`` of every leaf block; the path
    holds ``(tag, class words)`` from the root."""
    page, out, path, buf, links = page or "", [], [], [], 0
    at, end = 0, len(page)

    def flush():
        nonlocal links
        if buf:
            text = " ".join(_html.unescape("".join(buf)).split())
            if text:
                out.append((tuple(path), text, links))
            buf.clear()
        links = 0

    depth = 0
    while at < end:
        m = _TOKEN.match(page, at)
        at = m.end()
        tag = m.group(2)
        if tag is None:
            s = m.group(0)
            if s[0] != "<" or s == "<":
                buf.append(s)
                if depth:
                    links += len(s)
            continue
        tag = tag.lower()
        close = m.group(1)
        if tag in INLINE:
            if tag == "br":
                buf.append(" ")
            elif tag == "a":
                depth = 0 if close else 1
            continue
        if tag in RAW:
            if not close and not m.group(0).endswith("/>"):
                stop = re.compile(f"</{tag}", re.I).search(page, at)
                at = end if stop is None else stop.start()
                flush()
            continue
        flush()
        depth = 0
        if close:
            for k in range(len(path) - 1, -1, -1):
                if path[k][0] == tag:
                    del path[k:]
                    break
        elif tag == "body":
            path.clear()
            path.append(("body", ""))
        else:
            if path and (path[-1][0] == "p" and tag in CLOSES_P or path[-1][0] == tag and tag in ("li", "dt", "dd", "td", "th", "tr", "option")):
                path.pop()
            if tag not in VOID:
                name = " ".join(x for a in _ATTR.findall(m.group(3)) for x in a if x) if m.group(3) else ""
                path.append((tag, name))
    flush()
    return [b for b in out if not any(t == "head" for t, _ in b[0])]


def weak_label(path: tuple) -> int:
    """1 for main text by semantic elements, 0 for boilerplate."""
    if any(t in BAD or c and BAD_CLASS.search(c) for t, c in path):
        return 0
    return int(any(t in GOOD or "article" in c or "content" in c for t, c in path))


def _path_slots(step: tuple, last: bool) -> tuple:
    tag, name = step
    keys = [f"t:{tag}", *(f"c:{x}" for x in re.split(r"[^a-z0-9]+", name.lower()) if x)]
    if last:
        keys.append(f"l:{tag}")
    return tuple(zlib.crc32(k.encode()) % PATH for k in keys)


def vectors(bs: list, seen: dict | None = None) -> np.ndarray:
    """One row of ``PATH + WORDS + SHAPE`` numbers a block; ``seen`` keeps the
    slots of path steps between pages."""
    seen = {} if seen is None else seen
    x, n = np.zeros((len(bs), PATH + WORDS + SHAPE), np.float32), len(bs)
    for i, (path, text, links) in enumerate(bs):
        for k, step in enumerate(path):
            key = step, k == len(path) - 1
            if key not in seen:
                seen[key] = _path_slots(*key)
            for s in seen[key]:
                x[i, s] = 1
        w = text.lower().encode().split()
        h = np.array(list(map(zlib.crc32, w))) % WORDS
        x[i, PATH:PATH + WORDS] = np.bincount(h, minlength=WORDS) / len(w)
        x[i, -SHAPE:] = (np.log1p(len(w)) / 5, np.log1p(len(text)) / 7, links / max(1, len(text)), i / n, (n - i) / n,
                         float(text[-1] in ".!?"), float("\N{COPYRIGHT SIGN}" in text), 1)
    return x


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class BiLstm:
    """Two LSTM directions and a logistic output on both hidden states."""

    def __init__(self, d: int, h: int = HIDDEN, seed: int = 5):
        r = np.random.default_rng(seed)
        self.h = h
        self.p = {}
        for k in "fb":
            self.p["W" + k] = (r.standard_normal((d, 4 * h)) * 0.2).astype(np.float32)
            self.p["U" + k] = (r.standard_normal((h, 4 * h)) * 0.2).astype(np.float32)
            self.p["c" + k] = np.concatenate([np.zeros(h), np.ones(h), np.zeros(2 * h)]).astype(np.float32)
        self.p["v"] = (r.standard_normal(2 * h) * 0.2).astype(np.float32)
        self.p["o"] = np.zeros(1, np.float32)

    def _run(self, x, mask, k, keep=False):
        b, t, _ = x.shape
        h, c = (np.zeros((b, self.h), np.float32) for _ in "hc")
        z0 = x.reshape(b * t, -1) @ self.p["W" + k] + self.p["c" + k]
        z0, hs, tape = z0.reshape(b, t, -1), np.zeros((b, t, self.h), np.float32), []
        for i in (range(t) if k == "f" else range(t - 1, -1, -1)):
            z = z0[:, i] + h @ self.p["U" + k]
            gi, gf, go = (_sigmoid(z[:, j * self.h:(j + 1) * self.h]) for j in range(3))
            gc, m = np.tanh(z[:, 3 * self.h:]), mask[:, i, None]
            c1 = gf * c + gi * gc
            tc = np.tanh(c1)
            if keep:
                tape.append((i, h, c, gi, gf, go, gc, tc, m))
            h, c = m * (go * tc) + (1 - m) * h, m * c1 + (1 - m) * c
            hs[:, i] = h
        return hs, tape

    def scores(self, x, mask):
        """Logit of every block."""
        hs = np.concatenate([self._run(x, mask, k)[0] for k in "fb"], 2)
        return hs @ self.p["v"] + self.p["o"]

    def gradients(self, x, mask, y):
        runs = {k: self._run(x, mask, k, True) for k in "fb"}
        hs = np.concatenate([runs[k][0] for k in "fb"], 2)
        d = (_sigmoid(hs @ self.p["v"] + self.p["o"]) - y) * mask / mask.sum()
        g = {"v": np.tensordot(d, hs, 2), "o": np.array([d.sum()])}
        for n, k in enumerate("fb"):
            dh_all = d[:, :, None] * self.p["v"][n * self.h:(n + 1) * self.h]
            dz_all, gu = np.zeros((*x.shape[:2], 4 * self.h), np.float32), np.zeros_like(self.p["U" + k])
            dh, dc = (np.zeros((len(x), self.h), np.float32) for _ in "hc")
            for i, h, c, gi, gf, go, gc, tc, m in reversed(runs[k][1]):
                dh = dh + dh_all[:, i]
                a = m * dh
                e = m * dc + a * go * (1 - tc * tc)
                dz = np.concatenate([e * gc * gi * (1 - gi), e * c * gf * (1 - gf), a * tc * go * (1 - go), e * gi * (1 - gc * gc)], 1)
                dz_all[:, i] = dz
                gu += h.T @ dz
                dh, dc = (1 - m) * dh + dz @ self.p["U" + k].T, (1 - m) * dc + e * gf
            flat = dz_all.reshape(-1, 4 * self.h)
            g |= {"W" + k: x.reshape(len(flat), -1).T @ flat, "U" + k: gu, "c" + k: flat.sum(0)}
        return g

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = 6, rate: float = 0.01, seed: int = 3):
        """Adam on batches of pages of like length."""
        mom, r, n = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in self.p.items()}, np.random.default_rng(seed), 0
        for _ in range(epochs):
            batches = list(batched([len(y) for _, y in pages], 16))
            for at in r.permutation(len(batches)):
                x, mask = padded([pages[i][0] for i in batches[at]])
                y = padded([pages[i][1][:, None] for i in batches[at]])[0][:, :, 0]
                n += 1
                for k, g in self.gradients(x, mask, y).items():
                    a, b = mom[k]
                    a += 0.1 * (np.clip(g, -1, 1) - a)
                    b += 0.01 * (g * g - b)
                    self.p[k] -= (rate * a / (1 - 0.9 ** n) / (np.sqrt(b / (1 - 0.99 ** n)) + 1e-8)).astype(np.float32)
        return self


def padded(seqs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    t = max(len(s) for s in seqs)
    x, mask = np.zeros((len(seqs), t, seqs[0].shape[1]), np.float32), np.zeros((len(seqs), t), np.float32)
    for i, s in enumerate(seqs):
        x[i, :len(s)], mask[i, :len(s)] = s, 1
    return x, mask


def batched(lengths: list[int], most: int = 256):
    """Index lists of like lengths, at most ``STEP_CELLS`` cells each."""
    out, width = [], 0
    for i in np.argsort(lengths, kind="stable"):
        if not lengths[i]:
            continue
        width = max(width, lengths[i])
        if out and (len(out) == most or width * (len(out) + 1) > STEP_CELLS):
            yield out
            out, width = [], lengths[i]
        out.append(i)
    if out:
        yield out


# Container names of common page layouts.
MAIN_NAMES = [("article", ""), ("main", ""), ("div", "content"), ("div", "post-content"), ("div", "entry-content"), ("section", "story"),
              ("div", "article-body"), ("div", "main-content"), ("div", "post"), ("section", ""), ("div", "")]
OTHER_NAMES = [("nav", ""), ("header", ""), ("footer", ""), ("aside", ""), ("form", ""), ("div", "ad"), ("div", "advert"), ("div", "sidebar"),
               ("div", "cookie-notice"), ("div", "notice"), ("div", "menu"), ("div", "navbar"), ("div", "footer"), ("div", "site-header"),
               ("section", "comments"), ("div", "comment"), ("div", "related"), ("div", "promo"), ("div", "newsletter"), ("ul", "breadcrumbs"), ("div", "")]


def layouts(sample: list[list], rounds: int = 3, seed: int = 11):
    """Labelled block lists: the pages as they are, then altered layouts."""
    r = np.random.default_rng(seed)
    good = [b for bs in sample for b in bs if weak_label(b[0])]
    bad = [b for bs in sample for b in bs if not weak_label(b[0])]
    for bs in sample:
        yield bs, [weak_label(b[0]) for b in bs]
        if not good or not bad:
            continue
        for _ in range(rounds):
            main = MAIN_NAMES[r.integers(len(MAIN_NAMES))]
            names = [OTHER_NAMES[i] for i in r.integers(len(OTHER_NAMES) - (main[1] == "" and main[0] in ("div", "section")), size=3)]
            wrap = [("body", "")] + [("div", "page")] * int(r.integers(2))
            out, y = [], []

            def other(k, name, out=out, y=y, wrap=wrap):
                prose = name[1] in ("comment", "comments", "related", "sidebar", "notice") or name[0] == "aside"
                for _ in range(k):
                    src = good if prose and r.random() < 0.7 else bad
                    b = src[r.integers(len(src))]
                    leaf = (("ul", ""), ("li", "")) if r.random() < 0.4 else (("p", ""),) if r.random() < 0.6 else ()
                    out.append(((*wrap, name, *leaf), b[1], b[2]))
                    y.append(0)
            other(int(r.integers(0, 7)), names[0])
            if r.random() < 0.5:
                other(int(r.integers(1, 4)), names[1])
            for b in bs:
                if weak_label(b[0]):
                    tail = next((b[0][k + 1:] for k in range(len(b[0]) - 1, -1, -1) if b[0][k][0] in GOOD), b[0][-1:])
                    out.append(((*wrap, main, *tail), b[1], b[2]))
                    y.append(1)
                    if r.random() < 0.03:
                        other(1, OTHER_NAMES[r.integers(5, 9)])
            other(int(r.integers(0, 6)), names[2])
            yield out, y


def train(df: DataFrame, limit: int = TRAIN_PAGES) -> BiLstm:
    """Fit the labeller on the weakly labelled sample."""
    ids = (df.filter("html is not null").select("page_id").orderBy(F.xxhash64("page_id"), "page_id").limit(limit))
    rows = (df.join(F.broadcast(ids.distinct()), "page_id", "left_semi").orderBy(F.xxhash64("page_id"), F.xxhash64("html"))
            .limit(limit).select("html").toPandas()["html"])
    seqs = [(vectors(bs), np.array(y, np.float32)) for bs, y in layouts([b for b in map(blocks, rows) if 0 < len(b) <= 2000]) if bs]
    model = BiLstm(PATH + WORDS + SHAPE)
    return model.fit(seqs) if seqs else model


def main_texts(pages: list, model: BiLstm) -> list[str]:
    """Main text of each page of a batch."""
    found = [blocks(p) for p in pages]
    out, seen = [""] * len(pages), {}
    for at in batched([len(b) for b in found]):
        x, mask = padded([vectors(found[i], seen) for i in at])
        z = model.scores(x, mask)
        for k, i in enumerate(at):
            out[i] = " ".join(b[1] for b, s in zip(found[i], z[k], strict=False) if s > 0)
    return out


def extract(df: DataFrame, model: BiLstm | None = None) -> DataFrame:
    """Add ``text`` (main text) and ``n_chars``."""
    shared = Shared(df.sparkSession, model or train(df))

    @F.pandas_udf(T.StringType())
    def run(page):
        import pandas as pd

        got = []
        for at in range(0, len(page), 256):
            got.extend(main_texts(page.iloc[at:at + 256].tolist(), shared.value))
        return pd.Series(got, dtype=object)
    return df.withColumn("text", run("html")).withColumn("n_chars", F.length("text").cast("long"))


def op6_html_extract(spark, sf_dir) -> DataFrame:
    """Main text of every page."""
    return extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")
