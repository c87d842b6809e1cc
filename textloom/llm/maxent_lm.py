"""LM scoring (operator 9): hashed maximum-entropy model.

Every word is predicted along a path of classes, ``P(w | h) = P(class | h)
P(slot | class, h) [P(leaf | class, slot, h)] P(w | leaf)``. Each of the first
factors is a softmax over weights summed from hashed features of the history: bias,
previous word, the word before it as a skip feature, and both as a pair. All words
of the history are hashed, frequent or not. The ``HEAD`` most frequent training
tokens own a slot of the first ``HEAD_CLASSES`` classes. All other words, unseen
ones too, lie in a leaf by their CRC-32 and share its probability by their smoothed
counts (c + 0.1); each leaf keeps 0.1 for an unseen word. So every token has
history-dependent factors and the model is a proper distribution. The number of
leaves follows the counted distinct words, up to ``HEAD * MOST_LEAVES``; tables
have at most 3 * (3 * ``BUCKETS`` + ``HEAD``) rows of 32 floats (about 9 MB).

Training (each training document is used once; a hash of its id and text says
where): weights start at the smoothed unigram model. The first step's gradient is
taken there, where expected counts follow from observed ones without a softmax: it
needs one distributed sum of feature counts. ``STEPS`` more synchronous steps each
sum the gradient over all documents of their own share (one of ``SHARES``) at fixed
weights, scaled by the counts of the first step. Sums go by blocks of weights, so a model does
not depend on how the documents are partitioned (but for rounding).

The counts of the most frequent tokens (``SHARED``, a fixed number) are broadcast;
the rest are joined: each document's rare tokens are counted by key in an equi-
join that no frequent token enters, so no key is hot.

Scoring: ``base_score`` sums log10((c+0.1)/(N+0.1(V+1))); ``score`` is the
model's log10 probability of the whole text with its end token.

Defined results: null or empty text is the end token alone; null ``doc_id`` is
not held out and its text is trained on; repeated rows count and are scored
each; an empty table gives no rows; without training tokens all counts are 0;
extra columns are ignored.
"""

from __future__ import annotations

from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import Shared, stored, table

CLASSES, SLOTS, HEAD_CLASSES = 32, 32, 16
HEAD = HEAD_CLASSES * SLOTS
MOST_LEAVES = 32      # leaves of a slot of the other classes, at most
PATHS = (1, CLASSES, (CLASSES - HEAD_CLASSES) * SLOTS)     # softmaxes of each level
BUCKETS = 1 << 13     # rows of a feature kind in each level's table
SHARED = 100_000
STEPS, SHARES = 2, 8  # gradient steps, each over one share of the training documents; the first step counts all other shares
BATCH = 8192          # tokens of a softmax at once: their rows stay in a core's cache
CACHED = 4096         # the same, where only probabilities are wanted
PIECE = 1 << 20       # bytes of texts that are split and encoded at once
TASK_TOKENS = 1 << 19 # tokens that a summing task takes at least: each sends sums of the size of the model
TRUST = 0.35          # part of the log ratio that the first step takes
PRIOR = 4.0           # tokens that a feature row counts as seen beforehand
RATE = 0.5
STEP = 1.0            # largest change of a weight in a step
START = 1 << 32       # stands before the first token; no CRC-32 has this value
END = b"\n"           # no word can be a line feed
SMOOTH = 0.1


def tokens(text: str | None) -> list[bytes]:
    """Tokens of one text: what ``encoded`` gives for many."""
    out = (text or "").encode().lower().split()
    out.append(END)
    return out


def pieces(batch: pa.RecordBatch, column: int):
    """``batch`` in slices of about ``PIECE`` bytes of texts, one row at least."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    at = (np.cumsum(size) - size) // PIECE
    cuts = np.r_[0, np.flatnonzero(np.diff(at)) + 1, len(size)]
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if b > a:
            yield batch.slice(a, b - a)


def as_list(words: pa.Array) -> list[bytes]:
    """As ``to_pylist``, many times faster."""
    return words.to_numpy(zero_copy_only=False).tolist()


def encoded(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words of some texts (the last one is the end), for each token the
    place of its word, and the number of tokens of each text."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat, ends = parts.flatten(), parts.offsets.to_numpy()
    ends = ends - ends[0]
    full = pc.greater(pc.binary_length(flat), 0)         # white space at an end leaves an empty part
    upto = np.r_[0, np.cumsum(full.to_numpy(zero_copy_only=False))]
    size = np.diff(upto[ends])
    flat = flat.filter(full).dictionary_encode()
    words = flat.dictionary.cast(pa.binary())
    ids = np.full(len(flat) + len(texts), len(words))
    ids[np.arange(len(flat)) + np.repeat(np.arange(len(texts)), size)] = flat.indices.to_numpy()
    return pa.concat_arrays([words, pa.array([END], pa.binary())]), ids, size + 1


def with_split(df: DataFrame) -> DataFrame:
    """``doc_id, text, held_out``."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0, F.lit(False))
    return df.select("doc_id", "text", held.alias("held_out"))


def count_tokens(rows: DataFrame) -> DataFrame:
    """``token, c`` over all training texts, combined per batch of texts."""
    def run(batches):
        for b in batches:
            seen = []
            for part in pieces(b, 0):
                words, ids, _ = encoded(part.column(0))
                seen.append(pa.table([words, np.bincount(ids, minlength=len(words))], ["token", "c"]))
            if seen:
                both = pa.concat_tables(seen).group_by("token", use_threads=False).aggregate([("c", "sum")])
                yield from both.select(["token", "c_sum"]).rename_columns(["token", "c"]).combine_chunks().to_batches()
    return stored(rows.filter("not held_out").select("text").mapInArrow(run, "token binary, c long")
                  .groupBy("token").agg(F.sum("c").alias("c")), "lm-counts")


def shared_from(counts: DataFrame, most: int = SHARED) -> int:
    """Smallest count that at most ``most`` tokens reach: tokens by count are
    a short table (counts differ at most sqrt(2 N) times), so no task or driver
    meets more than ``most`` tokens however many tasks there are."""
    sizes = stored(counts.groupBy("c").agg(F.count("*").alias("n")), "lm-sizes")
    at = Window.orderBy(F.desc("c"))
    return int(sizes.withColumn("_to", F.sum("n").over(at)).filter(F.col("_to") <= most).agg(F.coalesce(F.min("c"), F.lit(1 << 62))).first()[0])


def leaves_for(distinct: int) -> int:
    """Leaves of a slot: a power of two that follows the distinct words."""
    n = 4
    while n < MOST_LEAVES and n * HEAD * 4 < distinct:
        n *= 2
    return n


def add_rows(total: np.ndarray, rows: np.ndarray, p: np.ndarray) -> None:
    """``total[rows] += p``, rows that repeat included, as pairs of floats."""
    half = total.shape[1] // 2
    cells = (rows[:, None] * half + np.arange(half)).ravel()
    np.add.at(total.view(np.complex64).ravel(), cells, p.view(np.complex64).ravel())


class Model:
    """Weights and paths. Entries below ``HEAD`` are single words, entry
    ``HEAD + i`` is leaf ``i``. ``mass[i]`` is a leaf's smoothed count."""

    def __init__(self, top: list[tuple[bytes, int]], mass: np.ndarray):
        top = top[:HEAD]
        self.ids = {t: i for i, (t, _) in enumerate(top)}
        self.leaves = len(mass)
        self.log_mass = np.log10(mass)
        own = np.full(HEAD, 1e-9)
        own[:len(top)] = [c + SMOOTH for _, c in top]
        # entry i: class i % 16 (tail: + 16), slot i // 16 % 32, leaf i // 512 - 1
        tail = mass.reshape(-1, SLOTS, HEAD_CLASSES).T                     # class, slot, leaf
        slots = np.concatenate([own.reshape(SLOTS, HEAD_CLASSES).T, tail.sum(2)])
        shares = [slots.sum(1)[None, :], slots, tail.reshape(PATHS[2], -1)]
        self.bias = [s / s.sum(1, keepdims=True) for s in shares]
        self.w = [np.concatenate([np.zeros((3 * BUCKETS, b.shape[1])), np.log(b)]).astype(np.float32) for b in self.bias]
        self.scale = None
        self.odds = None

    def __getstate__(self):
        return self.__dict__ | {"odds": None}

    def encode(self, docs: list[list[bytes]], ranks: dict[bytes, int] | None = None):
        """``place`` for texts given as tokens, and these in one list."""
        flat = [t for d in docs for t in d]
        place = {t: i for i, t in enumerate(dict.fromkeys(flat))}
        return flat, *self.place(list(place), np.fromiter(map(place.get, flat), np.int64, len(flat)), np.array([len(d) for d in docs]), ranks)

    def place(self, words: list[bytes], ids: np.ndarray, size: np.ndarray, ranks: dict[bytes, int] | None = None):
        """All tokens of some texts, as ``encoded`` gives them: their rank in ``ranks``
        (the own words; -1: not there), their entries and the CRC-32 of the two
        tokens before."""
        rank = np.fromiter(map((self.ids if ranks is None else ranks).get, words, repeat(-1)), np.int64, len(words))
        crc = np.fromiter(map(crc32, words), np.uint64, len(words))
        y = np.where((rank >= 0) & (rank < len(self.ids)), rank, HEAD + (crc % np.uint64(self.leaves)).astype(np.int64))
        rank, crc, y = rank[ids], crc[ids], y[ids]
        one, two = np.empty_like(crc), np.empty_like(crc)
        one[1:], two[2:] = crc[:-1], crc[:-2]
        start = np.cumsum(size) - size
        one[start] = two[start] = START
        after = start + 1
        two[after[after < len(y)]] = START
        return rank, y, one, two

    def levels(self, y, one, two):
        """Of each level: which tokens meet it, their rows in its table (three
        features, the bias) and the choice that was taken."""
        mix = np.uint64(0x9E3779B97F4A7C15)       # fixed value: 2^64 by the golden ratio
        hs = [((x * mix) ^ np.uint64(k)) * mix >> np.uint64(40) for k, x in enumerate((one, two, one * np.uint64(1_000_003) + two))]
        hs = [h.view(np.int64) for h in hs]
        tail = np.flatnonzero(y >= HEAD)
        cls, slot = (y & HEAD_CLASSES - 1) + HEAD_CLASSES * (y >= HEAD), y // HEAD_CLASSES & SLOTS - 1
        t = y[tail]
        for k, (at, path, hit) in enumerate(((slice(None), np.zeros_like(y), cls), (slice(None), cls, slot),
                                             (tail, (t & HEAD_CLASSES - 1) * SLOTS + (t // HEAD_CLASSES & SLOTS - 1), t // HEAD - 1))):
            room = BUCKETS // PATHS[k]
            yield k, at, [(h[at] & room - 1) + (path * room + f * BUCKETS) for f, h in enumerate(hs)] + [path + 3 * BUCKETS], hit

    def paths(self, k: int) -> np.ndarray:
        """The path of each row of a feature kind in level ``k``'s table."""
        return np.repeat(np.arange(PATHS[k]), BUCKETS // PATHS[k])

    def choices(self, k: int, rows) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of all choices of level ``k``, not yet divided by their
        sums, and these. Products of e to the weights are looked up: a row's are
        divided by its largest, the bias is in the first feature's rows."""
        if self.odds is None:
            self.odds = []
            for j, w in enumerate(self.w):
                w = w[:3 * BUCKETS].astype(np.float64)
                w[:BUCKETS] += self.w[j][3 * BUCKETS + self.paths(j)]
                self.odds.append(np.exp(w - w.max(1, keepdims=True)).astype(np.float32))
        p = self.odds[k].take(rows[0], 0)
        for r in rows[1:3]:
            p *= self.odds[k].take(r, 0)
        total = p @ np.ones(p.shape[1], np.float32)
        low = np.flatnonzero(total < 1e-6)        # rows that agree on nothing: too small for products
        if len(low):
            z = sum(self.w[k].take(r[low], 0).astype(np.float64) for r in rows)
            p[low] = np.exp(z - z.max(1, keepdims=True))
            total[low] = p[low].sum(1)
        return p, total

    def log10(self, y, one, two) -> np.ndarray:
        """log10 probability of each entry, a leaf's per unit of smoothed
        count (add log10(c + 0.1) of the word), in bounded batches."""
        out = np.ones(len(y))
        for a in range(0, len(y), CACHED):
            s = slice(a, a + CACHED)
            got = out[s]
            for k, at, rows, hit in self.levels(y[s], one[s], two[s]):
                p, total = self.choices(k, rows)
                got[at] *= np.maximum(p.ravel()[np.arange(0, p.size, p.shape[1]) + hit] / total, 1e-30)
        np.log10(out, out=out)
        tail = y >= HEAD
        out[tail] -= self.log_mass[y[tail] - HEAD]
        return out

    def zeros(self) -> list[np.ndarray]:
        return [np.zeros(w.shape, np.float32) for w in self.w]

    def observe(self, y, one, two, sums) -> None:
        """Add how often each feature row met each choice."""
        for k, _, rows, hit in self.levels(y, one, two):
            width = sums[k].shape[1]
            for f, r in enumerate(rows[:3]):
                part = sums[k][f * BUCKETS:(f + 1) * BUCKETS]
                part += np.bincount((r - f * BUCKETS) * width + hit, minlength=part.size).reshape(part.shape)
        self.biases(sums)

    def gradient(self, y, one, two, sums) -> None:
        """Add observed less expected choices of each feature row."""
        for a in range(0, len(y), BATCH):
            s = slice(a, a + BATCH)
            for k, _, rows, hit in self.levels(y[s], one[s], two[s]):
                if not len(hit):
                    continue
                p, total = self.choices(k, rows)
                p *= (-1 / total)[:, None]
                p.ravel()[np.arange(0, p.size, p.shape[1]) + hit] += 1
                for r in rows[:3]:
                    add_rows(sums[k], r, p)
        self.biases(sums)

    def biases(self, sums) -> None:
        """Set each path's bias to the sum over its rows of one feature kind: all
        its tokens have one of these."""
        for k, s in enumerate(sums):
            s[3 * BUCKETS:] = s[:BUCKETS].reshape(PATHS[k], -1, s.shape[1]).sum(1, dtype=np.float64)

    def first_step(self, seen: list[np.ndarray]) -> None:
        """Step from the unigram start: expected counts are the row's tokens
        times the unigram share; the log ratio to the observed ones is taken in part."""
        self.scale, self.odds = [], None
        for k, obs in enumerate(seen):
            path = np.r_[np.tile(self.paths(k), 3), np.arange(PATHS[k])]
            b, n = self.bias[k][path], obs.sum(1, keepdims=True)
            change = TRUST * np.log((obs + PRIOR * b) / ((n + PRIOR) * b))
            change[3 * BUCKETS:] = 0
            self.w[k] = (self.w[k] + change).astype(np.float32)
            self.scale.append(((obs + n * b) / 2).astype(np.float32))

    def step(self, grad: list[np.ndarray], share: float) -> None:
        """One gradient step; ``share``: its tokens by those of the counts."""
        self.odds = None
        for k, g in enumerate(grad):
            self.w[k] = (self.w[k] + np.clip(RATE * g / (self.scale[k] * share + PRIOR), -STEP, STEP)).astype(np.float32)


def summed(rows: DataFrame, model: Model, method: str, expected: float, blocks: int = 64) -> tuple[list[np.ndarray], int]:
    """``method``'s sums over all texts of ``rows`` at fixed weights, and the
    number of tokens. Each task sends its sums in blocks, a block's are added in one
    task. Splits are put together, without a shuffle, where they hold few of the
    ``expected`` tokens; every core still has one.
    """
    shared = Shared(rows.sparkSession, model)
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, int(expected / TASK_TOKENS))

    def run(batches):
        m = shared.value
        sums, used = m.zeros(), 0
        for b in batches:
            for part in pieces(b, 0):
                words, ids, size = encoded(part.column(0))
                _, y, one, two = m.place(as_list(words), ids, size)
                getattr(m, method)(y, one, two, sums)
                used += len(y)
        if used:
            parts = np.array_split(np.concatenate([s.ravel() for s in sums]), blocks)
            yield pa.RecordBatch.from_arrays([pa.array(range(blocks)), pa.array([used] * blocks), pa.array([p.tobytes() for p in parts], pa.binary())], ["block", "n", "sums"])

    def add(batches):
        total, n = {}, {}
        for b in batches:
            for i, c, d in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                v = np.frombuffer(d.as_py(), np.float32)
                total[i] = total[i] + v if i in total else v.astype(np.float64)
                n[i] = n.get(i, 0) + c
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total)), pa.array([n[i] for i in total]), pa.array([total[i].tobytes() for i in total], pa.binary())], ["block", "n", "sums"])
    schema = "block long, n long, sums binary"
    got = rows.select("text").coalesce(tasks).mapInArrow(run, schema).repartition(blocks, "block").mapInArrow(add, schema).toPandas()
    out, n = [s.astype(np.float64) for s in model.zeros()], 0
    if len(got):
        got = got.sort_values("block")
        flat, n = np.concatenate([np.frombuffer(d) for d in got["sums"]]), int(got["n"].iloc[0])
        cuts = np.cumsum([s.size for s in out])[:-1]
        out = [f.reshape(s.shape) for f, s in zip(np.split(flat, cuts), out, strict=True)]
    return out, n


def train(rows: DataFrame, steps: int = STEPS):
    """``(model, shared counts, N, V, counts)`` learned from training rows."""
    counts = count_tokens(rows)
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    top = counts.filter(F.col("c") >= shared_from(counts)).toPandas()
    pairs = sorted(((bytes(t), int(c)) for t, c in zip(top["token"], top["c"], strict=True)), key=lambda x: (-x[1], x[0]))
    leaves = HEAD * leaves_for(int(v))
    by_leaf = counts.groupBy((F.crc32("token") % leaves).alias("leaf")).agg(F.sum("c").alias("c"), F.count("*").alias("n")).toPandas()
    mass = np.full(leaves, SMOOTH)
    mass[by_leaf["leaf"].to_numpy(int)] += by_leaf["c"].to_numpy(float) + SMOOTH * by_leaf["n"].to_numpy(float)
    for t, c in pairs[:HEAD]:
        mass[crc32(t) % leaves] -= c + SMOOTH
    model = Model(pairs, np.maximum(mass, SMOOTH))
    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(SHARES))
    learn = rows.filter("not held_out")
    seen, counted = summed(learn.filter(part >= steps), model, "observe", n * (SHARES - steps) / SHARES)
    model.first_step(seen)
    for k in range(steps):
        grad, used = summed(learn.filter(part == k), model, "gradient", n / SHARES)
        if used and counted:
            model.step(grad, used / counted)
    return model, dict(pairs), int(n), int(v), counts


def score(rows: DataFrame, fitted) -> DataFrame:
    """Scores of every row: the part of frequent tokens is summed in place,
    that of rare tokens is joined to their counts."""
    model, common, n, v, counts = fitted
    model.scale = None                  # only training needs it
    ranks = {t: i for i, t in enumerate(dict.fromkeys([*model.ids, *common]))}
    shared = Shared(rows.sparkSession, (model, ranks, np.log10(np.array([common[t] for t in ranks], float) + SMOOTH)))
    base_of = float(np.log10(n + SMOOTH * (v + 1)))

    def run(batches):
        m, ranks, logs = shared.value
        logs = np.append(logs, 0.0)     # rank -1: joined later
        for b in batches:
            for part in pieces(b, 1):
                words, ids, size = encoded(part.column(1))
                rank, y, one, two = m.place(as_list(words), ids, size, ranks)
                p = m.log10(y, one, two)
                own = logs[rank]
                start = np.cumsum(size) - size
                rare = np.flatnonzero(rank < 0)
                doc = np.repeat(np.arange(len(size)), size)[rare]
                left, f = np.unique(doc * len(words) + ids[rare], return_counts=True)      # a text's rare words
                ends = np.cumsum(np.bincount(left // len(words), minlength=len(size)))
                pairs = pa.StructArray.from_arrays([words.take(pa.array(left % len(words))), pa.array(f)], ["token", "f"])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), part.column(3), pa.array(size), pa.array(np.add.reduceat((rank >= 0).astype(np.int64), start)),
                     pa.array(np.add.reduceat(own, start)), pa.array(np.add.reduceat(p + np.where(y >= HEAD, own, 0.0), start)),
                     pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pairs)],
                    ["doc_id", "held_out", "_row", "n_tokens", "known", "base", "model", "rare"])
    kind = rows.schema["doc_id"].dataType.simpleString()
    out = stored(rows.select("doc_id", "text", "held_out", F.monotonically_increasing_id().alias("_row")).mapInArrow(
        run, f"doc_id {kind}, held_out boolean, _row long, n_tokens long, known long, base double, model double, rare array<struct<token: binary, f: bigint>>"), "lm-parts")
    rare = out.select("_row", F.explode("rare").alias("x")).select("_row", F.col("x.token").alias("token"), F.col("x.f").alias("f"))
    low = counts
    if common:
        least = min(common.values())
        low = counts.filter(F.col("c") <= least)        # what was not broadcast (and ties with it)
    c = F.coalesce("c", F.lit(0))
    sums = (rare.join(low, "token", "left").groupBy("_row").agg(
        F.sum(F.col("f") * F.log10(c + SMOOTH)).alias("s"), F.sum(F.when(c > 0, F.col("f")).otherwise(0)).alias("k")))
    sums = stored(sums, "lm-rare")
    s, k = (F.coalesce(x, F.lit(0)) for x in ("s", "k"))
    return out.drop("rare").join(sums, "_row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + k).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + s - F.col("n_tokens") * base_of).alias("base_score"), (F.col("model") + s).alias("score"))


def op9_maxent_lm(spark, sf_dir) -> DataFrame:
    """Base and model score of every document."""
    rows = with_split(table(spark, sf_dir, "documents"))
    return score(rows, train(rows))
