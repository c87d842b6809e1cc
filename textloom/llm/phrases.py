"""Phrase collocation mining (operator 12): an FM-index per shard over word ids.

A shard holds some ``SHARD_WORDS`` words of one language, pieces parted by id 0.
Its index is the Burrows-Wheeler transform of the word ids and of their reverse,
over suffixes sorted by no more words than the phrases sought have. Shards are
stored; each level builds the index to the depth it needs. A phrase is an interval in both; all phrases of a
length are extended at once by every word to the left (in the forward transform) or,
by turns, to the right (in the reverse one), with the other interval following.

Counts are summed across shards, level by level. A phrase of ``min_count``
occurrences has only words, and one-word-shorter parts, of as many, so a
level's frequent phrases are kept as bits of a filter of fixed size
(``FILTER_BITS``, broadcast) and the next level extends and sends only what passes.
A bit set by chance sends a row too many and loses nothing; sums are exact.

A cut's score is ``SCALE * a // (l + r)`` in decimals of 38 digits. A candidate
inside a longer one of nearly its count is dropped; it is enough to ask the
one-word extensions, since any longer candidate holds one with at least its count.

Defined results: null or empty text has no words; null language is ``und``;
repeated rows count each; ties follow score, count, then the phrase's bytes;
an empty table gives no rows; extra columns are ignored. Memory of a task is that
of ``2 * SHARD_WORDS`` words and of its longest text.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import stored, table

MIN_COUNT, DEPTH, TOP = 30, 4, 2000
SCALE, ABSORBED = 2_000_000, 80
NO_LANG = "und"
SHARD_WORDS = 1 << 20
FILTER_BITS = 1 << 25
ROWS = 1 << 16
# A-Z lowered; the signs that end a piece become a line end
_FOLD = bytes(10 if c in b".,;:!?" or 10 <= c <= 13 else c + 32 if 65 <= c <= 90 else c for c in range(256))
_BREAK = b"."         # no word: all full stops are line ends by then
_MIX = 0x9E3779B97F4A7C15


def spelled(text: str | None) -> list[bytes]:
    """Words of a text, with ``_BREAK`` wherever a piece ends."""
    return (text or "").encode().translate(_FOLD).replace(b"\n", b" . ").split()


def word_hash(lang: str, word: str) -> int:
    return xxhash.xxh64_intdigest(word, xxhash.xxh32_intdigest(lang.encode()))


def joined(hashes: list[np.ndarray]) -> np.ndarray:
    """Filter position of phrases, from the hashes of their words."""
    h = hashes[0]
    for x in hashes[1:]:
        h = h * np.uint64(_MIX) + x
    return ((h ^ (h >> np.uint64(31))) * np.uint64(_MIX)) >> np.uint64(64 - FILTER_BITS.bit_length() + 1)


def passes(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def shards(batches, size: int):
    """``lang, vocabulary, ids`` of each shard; id 0 parts pieces."""
    held: dict = {}

    def close(lang):
        index, parts, _ = held.pop(lang)
        words = list(index)
        return lang, words, np.concatenate([np.zeros(1, np.int32), *parts])

    for batch in batches:
        for at in range(batch.num_rows):
            lang = batch.column(0)[at].as_py()
            lang = NO_LANG if lang is None else lang
            if lang not in held:
                index = defaultdict()
                index.default_factory = index.__len__
                index[_BREAK]
                held[lang] = [index, [], 0]
            w = spelled(batch.column(1)[at].as_py())
            if not w:
                continue
            w.append(_BREAK)
            index, parts, n = held[lang]
            parts.append(np.fromiter(map(index.__getitem__, w), np.int32, len(w)))
            held[lang][2] = n + len(w)
            if n + len(w) >= size:
                yield close(lang)
            elif sum(x[2] for x in held.values()) >= 2 * size:
                yield close(max(held, key=lambda k: held[k][2]))
    for lang in list(held):
        yield close(lang)


def _sorted(key: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Stable order of ``key`` (0 to ``top``), and the sorted keys. Key and
    place are sorted as one integer wherever they fit."""
    bits = len(key).bit_length()
    if top.bit_length() + bits <= 63:
        both = np.sort((key.astype(np.int64) << bits) | np.arange(len(key)))
        return both & ((1 << bits) - 1), both >> bits
    order = np.argsort(key, kind="stable")
    return order, key[order]


def _starts(key: np.ndarray) -> np.ndarray:
    """Where each run of equal sorted keys starts."""
    return np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))


def transform(ids: np.ndarray, m: int, depth: int, stepped: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """The Burrows-Wheeler transform over suffixes in order of their first
    ``depth`` ids, and the last-to-first map: for each row, the row of the
    suffix that is one id longer."""
    rank, top, seen = ids.astype(np.int64), m, 1
    while True:                         # ranks of the first 1, 2, 4, ... ids
        if seen < depth:
            ahead = np.zeros_like(rank)
            ahead[:-seen] = rank[seen:]
            rank, top, seen = rank * (top + 1) + ahead, top * (top + 2), 2 * seen
        order, key = _sorted(rank, top)
        if seen >= depth:
            break
        starts = _starts(key)
        rank = np.empty_like(rank)
        rank[order] = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(key))))
        top = len(starts) - 1
    bwt, step = ids[order - 1], None
    if stepped:
        step = np.empty(len(ids), np.int64)
        step[_sorted(bwt, m)[0]] = np.arange(len(ids))
    return bwt, step


class Index:
    """Forward and reverse transforms over ids 1 to ``m`` (0 parts pieces), as
    deep as extending single words to phrases of ``length`` words needs: even
    lengths are reached by a word to the left, odd ones by a word to the right."""

    def __init__(self, ids: np.ndarray, length: int):
        self.m = int(ids.max(initial=0))
        left, right = length - length % 2, length - 1 + length % 2
        self.left = transform(ids, self.m, left - 1, left > 2)
        self.right = transform(ids[::-1], self.m, right - 1, right > 3) if right > 1 else None

    def words(self):
        """Intervals (forward and reverse start, size) of the single words."""
        n = np.bincount(self.left[0], minlength=self.m + 1)
        start = np.cumsum(n) - n
        return start[1:], start[1:], n[1:]

    def extend(self, at: np.ndarray, other: np.ndarray, size: np.ndarray, left: bool):
        """All one-word extensions of the intervals at ``at`` (forward rows if
        ``left``, else reverse rows) with the intervals at ``other`` following:
        ``parent, word, at, other, size``. ``at`` is None, and may be
        given as ``other``, where no later extension needs it."""
        bwt, step = self.left if left else self.right
        offset = np.cumsum(size) - size
        rows = np.repeat(at - offset, size) + np.arange(int(size.sum()))
        parent = np.repeat(np.arange(len(size)), size)
        order, key = _sorted(parent * (self.m + 1) + bwt[rows], len(size) * (self.m + 1))
        starts = _starts(key) if len(key) else np.empty(0, np.int64)
        parent, word = np.divmod(key[starts], self.m + 1)
        # smaller words of the same interval come first in the other one
        before = starts - offset[parent]
        n = np.diff(np.append(starts, len(key)))
        keep = word > 0
        found = step[rows[order[starts[keep]]]] if step is not None else None
        follows = None if other is None else (other[parent] + before)[keep]
        return parent[keep], word[keep], found, follows, n[keep]


def levels(lang: str, words: pa.Array, ids: np.ndarray, filters: list[np.ndarray]):
    """``words, word id columns, counts`` of the shard's phrases of one word
    more than ``filters`` covers."""
    hashes = np.array([word_hash(lang, w) for w in words.to_pylist()], np.uint64)
    keep = passes(filters[0], joined([hashes]))
    keep[0] = False
    ids = np.where(keep, np.cumsum(keep), 0).astype(np.int32)[ids]
    ids = ids[(ids > 0) | np.concatenate([[True], ids[:-1] > 0])]     # one break in a row is enough
    hashes, words = hashes[keep], words.filter(pa.array(keep))
    length = len(filters) + 1
    if not ids.any():
        return words, [], np.empty(0, np.int64)
    index = Index(ids, length)
    fwd, rev, size = index.words()
    phrase = [np.arange(index.m)]

    def only(ok):
        return [p[ok] for p in phrase], None if fwd is None else fwd[ok], None if rev is None else rev[ok], size[ok]

    for k in range(2, length + 1):
        left = k % 2 == 0
        if left:
            parent, word, fwd, rev, size = index.extend(fwd, rev, size, True)
        else:
            parent, word, rev, fwd, size = index.extend(rev, fwd, size, False)
        phrase = [p[parent] for p in phrase]
        phrase = [word - 1, *phrase] if left else [*phrase, word - 1]
        # both parts that are one word shorter must pass; one of them has been extended and did
        if k > 2:
            phrase, fwd, rev, size = only(passes(filters[k - 2], joined([hashes[p] for p in (phrase[:-1] if left else phrase[1:])])))
        if k < length:
            phrase, fwd, rev, size = only(passes(filters[k - 1], joined([hashes[p] for p in phrase])))
    return words, phrase, size


def _rows_of(lang: str, words: pa.Array, phrase: list[np.ndarray], size: np.ndarray):
    for a in range(0, len(size), ROWS):
        parts = [words.take(pa.array(p[a:a + ROWS])) for p in phrase]
        text = pc.binary_join_element_wise(*parts, " ") if len(parts) > 1 else parts[0]
        yield pa.RecordBatch.from_arrays([pa.repeat(lang, len(text)), text, pa.array(size[a:a + ROWS], pa.int64())],
                                         ["lang", "phrase", "n"])


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("lang", "phrase").agg(F.sum("n").alias("f"))


def stored_shards(df: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``lang, words, ids`` of each shard: texts are cut into words once."""
    def run(batches):
        for lang, words, ids in shards(batches, shard_words):
            yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([[w.decode() for w in words]], pa.list_(pa.string())),
                                              pa.array([ids.tobytes()], pa.binary())], ["lang", "words", "ids"])
    return stored(df.select("lang", "text").mapInArrow(run, "lang string, words array<string>, ids binary"), "phrase-shards", "zstd")


def _read(batches):
    for b in batches:
        for lang, words, ids in zip(*b.columns, strict=True):
            yield lang.as_py(), words.values, np.frombuffer(ids.as_buffer(), np.int32)


def word_counts(parts: DataFrame) -> DataFrame:
    """``lang, phrase, f`` of every single word of stored shards."""
    def run(batches):
        for lang, words, ids in _read(batches):
            n = np.bincount(ids, minlength=len(words))[1:]
            yield from _rows_of(lang, words.slice(1), [np.arange(len(n))], n)
    return _summed(parts.mapInArrow(run, "lang string, phrase string, n long"))


def filter_bits(frequent: DataFrame) -> bytes:
    """The filter of ``lang, phrase`` rows: each task sets bits, Spark ors them
    by 64-bit words, of which the driver gets ``FILTER_BITS / 64`` at most."""
    def run(batches):
        bits = np.zeros(FILTER_BITS // 8, np.uint8)
        for b in batches:
            if not b.num_rows:
                continue
            langs, phrases = b.column(0).to_pylist(), b.column(1).to_pylist()
            split = [p.split(" ") for p in phrases]
            hashes = [np.array([word_hash(x, p[k]) for x, p in zip(langs, split, strict=True)], np.uint64) for k in range(len(split[0]))]
            at = joined(hashes)
            np.bitwise_or.at(bits, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
        longs = bits.view("<i8")
        set_ = np.flatnonzero(longs)
        yield pa.RecordBatch.from_arrays([pa.array(set_), pa.array(longs[set_])], ["at", "bits"])
    found = (frequent.select("lang", "phrase").mapInArrow(run, "at long, bits long")
             .groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow())
    out = np.zeros(FILTER_BITS // 64, "<i8")
    out[found.column("at").to_numpy()] = found.column("bits").to_numpy()
    return out.tobytes()


def phrase_counts(parts: DataFrame, filters: list[bytes]) -> DataFrame:
    """``lang, phrase, f`` of the phrases of stored shards of one word more than
    ``filters`` covers (one filter a length, from 1 on) that pass them."""
    shared = parts.sparkSession.sparkContext.broadcast(filters)

    def run(batches):
        bits = [np.frombuffer(b, np.uint8) for b in shared.value]
        for lang, words, ids in _read(batches):
            yield from _rows_of(lang, *levels(lang, words, ids, bits))
    return _summed(parts.mapInArrow(run, "lang string, phrase string, n long"))


def frequent_phrases(df: DataFrame, min_count: int = MIN_COUNT, depth: int = DEPTH,
                     shard_words: int = SHARD_WORDS) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, len, f`` of all phrases of 1 to ``depth`` words with at
    least ``min_count`` occurrences, and ``lang, n`` (all words)."""
    parts = stored_shards(df, shard_words)
    words = stored(word_counts(parts), "phrase-words")
    sizes = words.groupBy("lang").agg(F.sum("f").alias("n"))
    out = kept = words.filter(F.col("f") >= min_count).withColumn("len", F.lit(1))
    filters = []
    for k in range(2, depth + 1):
        filters.append(filter_bits(kept))
        kept = stored(phrase_counts(parts, filters).filter(F.col("f") >= min_count).withColumn("len", F.lit(k)), f"phrase-{k}")
        out = out.unionByName(kept)
    return out, sizes


def _part(first, n):
    return F.array_join(F.slice("w", first, n), " ")


def collocations(df: DataFrame, min_count: int = MIN_COUNT, depth: int = DEPTH, top: int | None = TOP, scale: int = SCALE,
                 absorbed: int = ABSORBED, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the collocations of
    ``df`` (``lang``, ``text``), the first ``top`` of each language."""
    found, sizes = frequent_phrases(df, min_count, depth, shard_words)
    found = stored(found, "phrase-frequent")
    cand = found.filter("len > 1").withColumnRenamed("f", "a").withColumn("w", F.split("phrase", " "))
    # every part of a candidate is as frequent as it, so both joins find all
    cuts = cand.select("lang", "phrase", "a", "len", F.explode(F.sequence(F.lit(1), F.col("len") - 1)).alias("k"), "w").select(
        "lang", "phrase", "a", "k", _part(F.lit(1), F.col("k")).alias("p"), _part(F.col("k") + 1, F.col("len") - F.col("k")).alias("q"))
    f = found.select("lang", "phrase", "f")
    cuts = (cuts.join(f.select("lang", F.col("phrase").alias("p"), F.col("f").alias("l")), ["lang", "p"])
            .join(f.select("lang", F.col("phrase").alias("q"), F.col("f").alias("r")), ["lang", "q"]))
    score = F.expr(f"(cast({scale} as decimal(18,0)) * cast(a as decimal(19,0))) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")
    best = (cuts.withColumn("score", score).groupBy("lang", "phrase")
            .agg(F.min(F.struct("score", "k", "l", "r")).alias("b"), F.first("a").alias("a")))
    longer = cand.filter("len > 2").select("lang", F.explode(F.array(
        _part(F.lit(1), F.col("len") - 1), _part(F.lit(2), F.col("len") - 1))).alias("phrase"), "a")
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longest"))
    wide = "decimal(38,0)"
    left = best.join(longer, ["lang", "phrase"], "left").filter(
        F.col("longest").isNull() | (F.lit(100).cast("decimal(18,0)") * F.col("longest").cast("decimal(19,0)")
                                     < (F.lit(absorbed).cast("decimal(18,0)") * F.col("a").cast("decimal(19,0)")).cast(wide)))
    order = Window.partitionBy("lang").orderBy(F.desc("b.score"), F.desc("a"), F.asc("phrase"))
    ranked = left.withColumn("rank", F.row_number().over(order).cast("long"))
    if top is not None:                 # each task sends its first ``top`` of a language only
        ranked = ranked.filter(F.col("rank") <= top)
    return ranked.join(F.broadcast(sizes) if top is not None else sizes, "lang").select(
        "lang", "rank", "phrase", "a", F.col("b.l").alias("l"), F.col("b.r").alias("r"), "n", F.col("b.score").alias("score"))


def op12_phrases(spark, sf_dir) -> DataFrame:
    """The first 2000 collocations of each language over all documents."""
    return collocations(table(spark, sf_dir, "documents"))


OP12_SQL = r"""WITH doc AS (SELECT row_number() OVER () AS rid, coalesce(lang, 'und') AS lang,
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT rid, lang, unnest(p) AS piece, generate_subscripts(p, 1) AS pi FROM
  (SELECT rid, lang, string_split_regex(t, '[.,;:!?\x0A-\x0D]') AS p FROM doc)),
ws AS (SELECT rid, lang, pi, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
occ AS (SELECT rid, lang, pi, unnest(w) AS w1, generate_subscripts(w, 1) AS i FROM ws),
ahead AS (SELECT lang, w1, lead(w1, 1) OVER o AS w2, lead(w1, 2) OVER o AS w3, lead(w1, 3) OVER o AS w4
  FROM occ WINDOW o AS (PARTITION BY rid, pi ORDER BY i)),
f AS (SELECT lang, w1 AS p, 1 AS len, count(*) AS f FROM ahead GROUP BY ALL
  UNION ALL SELECT lang, w1 || ' ' || w2, 2, count(*) FROM ahead WHERE w2 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3, 3, count(*) FROM ahead WHERE w3 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4, 4, count(*) FROM ahead WHERE w4 IS NOT NULL GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM f WHERE len = 1 GROUP BY lang),
cand AS (SELECT lang, p, len, f AS a, string_split(p, ' ') AS w FROM f WHERE len > 1 AND f >= 30),
cut AS (SELECT lang, p, a, len, w, unnest(range(1, len)) AS k FROM cand),
sc AS (SELECT c.lang, c.p, c.a, c.k, x.f AS l, y.f AS r, (2000000::HUGEINT * c.a) // (x.f + y.f) AS score
  FROM cut c JOIN f x ON x.lang = c.lang AND x.p = array_to_string(c.w[1:c.k], ' ')
  JOIN f y ON y.lang = c.lang AND y.p = array_to_string(c.w[c.k + 1:c.len], ' ')),
best AS (SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
inner_ AS (SELECT lang, array_to_string(w[s:e], ' ') AS p, a FROM (SELECT lang, w, a, 1 AS s, len - 1 AS e FROM cand WHERE len > 2
  UNION ALL SELECT lang, w, a, 2, len FROM cand WHERE len > 2 UNION ALL SELECT lang, w, a, 1, 2 FROM cand WHERE len > 3
  UNION ALL SELECT lang, w, a, 2, 3 FROM cand WHERE len > 3 UNION ALL SELECT lang, w, a, 3, 4 FROM cand WHERE len > 3)),
big AS (SELECT lang, p, max(a) AS a FROM inner_ GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN big g ON g.lang = b.lang AND g.p = b.p WHERE g.a IS NULL OR 100::HUGEINT * g.a < 80::HUGEINT * b.a),
r AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(p)) AS rank, p, a, l, r, score FROM kept)
SELECT r.lang, CAST(rank AS BIGINT) AS rank, p AS phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
  CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM r JOIN n ON n.lang = r.lang WHERE rank <= 2000"""
