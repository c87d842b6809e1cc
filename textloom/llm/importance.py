"""Target-distribution importance resampling (operator 11).

A text's features are its runs of 1 to ``n`` words; a feature's bucket is the
CRC-32 of its bytes, modulo the number of buckets. CRCs are taken of distinct
features: those of equal length form one two-dimensional byte array, whose
CRCs are updated together, column by column, and scattered back.

A text is cut into words once; the stored table holds its buckets, 2 bytes a
feature. Totals per bucket (whose number is a parameter and bounds the broadcast)
of the corpus and the target give each bucket's gain. A document's weight is the
floored mean of its features' gains, its score the weight plus Gumbel noise
seeded by its id, so the highest scores are a draw without replacement.
Scores are integers: a histogram of them finds the lowest drawn one, and only
documents from there on are put in order, by one range exchange.

Defined results: null or empty text has no features, weight 0, and takes part
like any other; null ``doc_id`` hashes as the empty text and is ordered last
among equal scores; repeated rows score alike and get ranks of their own; an
empty table gives no rows; an empty target leaves only smoothing; a draw of no
documents leaves all ranks null; extra columns are ignored. A text over
``CHUNK`` bytes is worked through in pieces cut between words, so memory is that
of the text; time for one word grows with its length.
"""

from __future__ import annotations

import math
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import positions, stored, table

BUCKETS, RUN = 10_000, 1
SEED, MIN_WORDS, PERCENT = 2024, 20, 10
CHUNK = 4 << 20
# words: 0-9, a-z and all bytes of non-ASCII characters; A-Z is lowered, the rest parts words
_FOLD = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1)
    return c.astype(np.uint32)


_CRC = _crc_table()


def crc32s(features: list[bytes]) -> np.ndarray:
    """CRC-32 of every feature, in columns of equal-length features."""
    lengths = np.fromiter(map(len, features), np.int64, len(features))
    order = np.argsort(lengths, kind="stable")
    flat = np.frombuffer(b"".join([features[i] for i in order]), np.uint8)
    out, at, row = np.empty(len(features), np.uint32), 0, 0
    for size, n in zip(*np.unique(lengths, return_counts=True), strict=True):
        columns = np.ascontiguousarray(flat[at:at + size * n].reshape(n, size).T)
        crc = np.full(n, 0xFFFFFFFF, np.uint32)
        for column in columns:
            crc = _CRC[(crc ^ column) & 255] ^ (crc >> 8)
        out[order[row:row + n]] = ~crc
        at, row = at + size * n, row + n
    return out


def _pieces(text: str | None, run: int):
    """Lists of words of a text; pieces behind the first start with the
    ``run - 1`` words before, whose own features are not counted again."""
    plain, at, tail = (text or "").encode().translate(_FOLD), 0, []
    while at < len(plain):
        end = len(plain)
        if end - at > CHUNK:
            cut = plain.rfind(b" ", at, at + CHUNK)
            end = cut if cut > at else plain.find(b" ", at + CHUNK)
            end = len(plain) if end < 0 else end
        words = plain[at:end].split()
        yield len(tail), tail + words
        tail = (tail + words)[1 - run:] if run > 1 else []
        at = end


def _features(old: int, words: list[bytes], run: int) -> list[bytes]:
    out = words[old:]
    for k in range(2, run + 1):
        first = max(0, old - k + 1)
        out = out + [b" ".join(words[i:i + k]) for i in range(first, len(words) - k + 1)]
    return out


def _buckets(features: list[bytes], buckets: int) -> np.ndarray:
    index = {f: i for i, f in enumerate(dict.fromkeys(features))}
    of = (crc32s(list(index)) % np.uint32(buckets)).astype("<u4" if buckets > 65536 else "<u2")
    return of[np.fromiter(map(index.__getitem__, features), np.int64, len(features))]


def _hashed(batches, run: int, buckets: int):
    """``doc_id, n_words, n_features, buckets`` of each row."""
    def done(rows, held, counts):
        ids = _buckets(held, buckets)
        ends = np.cumsum([n for _, n in counts])
        parts = np.split(ids, ends[:-1])
        return pa.RecordBatch.from_arrays([
            pa.array([r for r, _ in rows], pa.int64()), pa.array([w for _, w in rows], pa.int64()),
            pa.array([n for _, n in counts], pa.int64()), pa.array([p.tobytes() for p in parts], pa.binary())],
            ["doc_id", "n_words", "n_features", "buckets"])

    for batch in batches:
        rows, held, counts, size = [], [], [], 0
        for at in range(batch.num_rows):
            doc, text = batch.column(0)[at].as_py(), batch.column(1)[at].as_py()
            if text and len(text) > CHUNK // 4:       # worked through alone, piece by piece
                n_words, parts = 0, []
                for old, words in _pieces(text, run):
                    n_words += len(words) - old
                    parts.append(_buckets(_features(old, words, run), buckets))
                ids = np.concatenate(parts) if parts else np.empty(0, "<u2")
                yield pa.RecordBatch.from_arrays([pa.array([doc], pa.int64()), pa.array([n_words], pa.int64()),
                                                  pa.array([len(ids)], pa.int64()), pa.array([ids.tobytes()], pa.binary())],
                                                 ["doc_id", "n_words", "n_features", "buckets"])
                continue
            words = (text or "").encode().translate(_FOLD).split()
            found = _features(0, words, run)
            rows.append((doc, len(words)))
            counts.append((doc, len(found)))
            held += found
            size += len(text or "")
            if size > CHUNK:
                yield done(rows, held, counts)
                rows, held, counts, size = [], [], [], 0
        if rows:
            yield done(rows, held, counts)


def hashed(df: DataFrame, run: int = RUN, buckets: int = BUCKETS, name: str = "resample-hashed") -> DataFrame:
    """``doc_id, n_words, n_features, buckets`` of every row, stored."""
    return stored(df.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        lambda batches: _hashed(batches, run, buckets), "doc_id long, n_words long, n_features long, buckets binary"), name)


def totals(rows: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket, over all rows."""
    kind = "<u4" if buckets > 65536 else "<u2"

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for x in b.column(0):
                total += np.bincount(np.frombuffer(x.as_py(), kind), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])
    found = rows.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for r in found:
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored thousandths of the log ratio of smoothed bucket shares."""
    n = len(corpus)
    all_s, all_t = int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((int(t) + 1) * (all_s + n) / ((int(s) + 1) * (all_t + n))))
                     for s, t in zip(corpus, target, strict=True)], np.int64)


def _noise(doc: int | None, seed: int) -> int:
    h = int(sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(rows: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """``rows`` without buckets, with ``weight`` and ``score``, stored."""
    shared = rows.sparkSession.sparkContext.broadcast(gain)
    kind = "<u4" if len(gain) > 65536 else "<u2"

    def run(batches):
        g = shared.value
        for b in batches:
            weights = []
            for n, x in zip(b.column(2), b.column(3), strict=True):
                weights.append(int(g[np.frombuffer(x.as_py(), kind)].sum()) // n.as_py() if n.as_py() else 0)
            noise = [_noise(d.as_py(), seed) for d in b.column(0)]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(weights, pa.int64()), pa.array(
                [w + x for w, x in zip(weights, noise, strict=True)], pa.int64())], ["doc_id", "n_words", "n_features", "weight", "score"])
    out = rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long")
    return stored(out.withColumn("row", F.monotonically_increasing_id()), "resample-scored")


def drawn(rows: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """``rows`` with ``rank``: 1, 2, 3 ... for the drawn documents."""
    able = F.col("n_words") >= min_words
    # scores are integers of a few ten thousand values, however many documents there are
    counts = sorted((-r["score"], r["n"]) for r in rows.filter(able).groupBy("score").agg(F.count("*").alias("n")).collect())
    want = percent * sum(n for _, n in counts) // 100
    none = F.lit(None).cast("long")
    if not want:
        return rows.withColumn("rank", none)
    seen = 0
    for low, n in counts:
        seen += n
        if seen >= want:
            break
    near = able & (F.col("score") >= -low)
    ranked = positions(rows.filter(near), [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")], "resample-drawn")
    ranked = ranked.withColumn("rank", F.when(F.col("pos") < want, F.col("pos") + 1)).drop("pos")
    return ranked.unionByName(rows.filter(~near).withColumn("rank", none))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, run: int = RUN, buckets: int = BUCKETS,
             seed: int = SEED, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every row of
    ``docs``: drawn to resemble ``target`` (its ``text`` column)."""
    rows = hashed(docs, run, buckets)
    like = hashed(target.select(F.lit(0).alias("doc_id"), "text"), run, buckets, "resample-target")
    return drawn(scored(rows, gains(totals(rows, buckets), totals(like, buckets)), seed), percent, min_words).drop("row")


def op11_importance_resampling(spark, sf_dir) -> DataFrame:
    """Weight, score and rank of every document against the benchmark texts."""
    out = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


# CRC-32 in SQL, of distinct words only; the byte table comes from the polynomial.
OP11_SQL = r"""WITH low AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t, 0 AS target FROM documents
  UNION ALL SELECT NULL, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), 1 FROM benchmark),
docs AS (SELECT row_number() OVER () AS rid, doc_id, target, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM low),
occ AS (SELECT rid, target, unnest(ws) AS w FROM docs),
per AS (SELECT rid, target, w, count(*) AS n FROM occ GROUP BY ALL),
tab AS (SELECT list(c ORDER BY i) AS tab FROM (SELECT i, list_reduce(range(8), lambda c, j:
  CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c FROM (SELECT unnest(range(256)) AS i))),
hexes AS (SELECT w, hex(encode(w)) AS x FROM (SELECT DISTINCT w FROM per)),
byt AS (SELECT w, list_transform(range(length(x) // 2), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT)) AS b FROM hexes),
buck AS (SELECT w, xor(list_reduce(b, lambda c, y: xor(tab[CAST(xor(c, y) & 255 AS BIGINT) + 1], c >> 8), 4294967295), 4294967295) % 10000 AS bucket
  FROM byt, tab),
cnt AS (SELECT bucket, coalesce(sum(n) FILTER (WHERE target = 0), 0) AS s, coalesce(sum(n) FILTER (WHERE target = 1), 0) AS t
  FROM per JOIN buck USING (w) GROUP BY bucket),
tot AS (SELECT coalesce(sum(s), 0) AS s_all, coalesce(sum(t), 0) AS t_all FROM cnt),
gain AS (SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) * (s_all + 10000) AS DOUBLE) / CAST((s + 1) * (t_all + 10000) AS DOUBLE))) AS BIGINT) AS g
  FROM cnt, tot),
wsum AS (SELECT rid, sum(n * g) AS g, sum(n) AS n FROM per JOIN buck USING (w) JOIN gain USING (bucket) WHERE target = 0 GROUP BY rid),
sc AS (SELECT d.rid, d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_features,
  CAST(coalesce(CASE WHEN x.g >= 0 THEN x.g // x.n ELSE -((-x.g + x.n - 1) // x.n) END, 0) AS BIGINT) AS weight,
  CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256(concat('2024:', d.doc_id)), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS noise
  FROM docs d LEFT JOIN wsum x USING (rid) WHERE d.target = 0),
r AS (SELECT *, weight + noise AS score, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY weight + noise DESC, doc_id, rid) AS k,
  (SELECT 10 * count(*) // 100 FROM sc WHERE n_features >= 20) AS want FROM sc)
SELECT doc_id, n_features, weight, CAST(score AS BIGINT) AS score,
  CASE WHEN n_features >= 20 AND k <= want THEN CAST(k AS BIGINT) END AS rank FROM r"""
