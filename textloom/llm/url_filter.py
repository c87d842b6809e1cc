"""URL filters (operator 2): Bloom filter cascade.

Rules are ``host + path prefix`` keys; the candidate keys of a URL are every
host suffix joined with every path prefix of a length that some rule has. All
candidate keys of the corpus are the key universe. Level 1 encodes the listed
keys; level 2 the universe's keys that pass level 1 without being listed;
level 3 the listed keys that pass level 2; and so on until a level has no
false positives. A key of the universe is listed exactly when the first level
it fails has an even number (counting from 1). Levels are sized by the listed
count and the universe count (first rate ``r * sqrt(0.5) / s``, then 0.5), so a
cascade grows with the list, not with the corpus; its bytes are checked.

Defined results: null URL, or one without ``://``, has empty host and path;
no rule fits an empty host; repeated rows stay; an empty table gives no rows;
other input columns are kept, the results replace columns of the same name.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import lower_ascii, stored, table

# Fixed values of the contract.
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]
MAX_FILTER_BYTES = 256 << 20
SALT = np.uint64(0x9E3779B97F4A7C15)


def with_parts(df: DataFrame, url_col: str = "url") -> DataFrame:
    """Add ``host`` (A-Z lower-cased) and ``path``."""
    u = F.coalesce(F.col(url_col), F.lit(""))
    pat = r"://([^/?#]*)([^?#]*)"
    return df.withColumns({"host": lower_ascii(F.regexp_extract(u, pat, 1)),
                           "path": F.regexp_extract(u, pat, 2)})


def candidates(host: Column, path: Column, lengths: list[int]) -> Column:
    """Candidate keys, longest first: host suffixes x path prefixes."""
    labels = F.split(host, r"\.", -1)
    suffixes = F.when(host == "", F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.size(labels)),
                    lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    cuts = F.filter(F.array(*[F.lit(n) for n in sorted(lengths)]), lambda n: n <= F.length(path))
    keys = F.flatten(F.transform(suffixes, lambda h: F.transform(
        cuts, lambda n: F.concat(h, F.substr(path, F.lit(1), n)))))
    return F.reverse(F.array_sort(F.transform(F.array_distinct(keys), lambda k: F.struct(F.length(k).alias("n"), k.alias("k")))))


def _positions(h1: np.ndarray, h2: np.ndarray, level: int, k: int, m: int):
    """k bit positions per key; each level mixes both hashes with its salt."""
    with np.errstate(over="ignore"):
        a = (h1 + np.uint64(level) * SALT) * np.uint64(0xBF58476D1CE4E5B9)
        a ^= a >> np.uint64(31)
        b = (h2 ^ (np.uint64(level) * SALT)) * np.uint64(0x94D049BB133111EB)
        b = (b ^ (b >> np.uint64(29))) | np.uint64(1)
        for i in range(k):
            yield (a + np.uint64(i) * b) % np.uint64(m)


def passes(h1, h2, level, bits, k, m) -> np.ndarray:
    ok = np.ones(len(h1), bool)
    for p in _positions(h1, h2, level, k, m):
        ok &= (bits[(p >> np.uint64(3)).astype(np.int64)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return ok


def member(h1, h2, levels) -> np.ndarray:
    """Exact membership of universe keys: parity of the first level failed."""
    out = np.zeros(len(h1), bool)
    alive = np.arange(len(h1))
    for n, (bits, k, m) in enumerate(levels, 1):
        ok = passes(h1[alive], h2[alive], n, bits, k, m)
        out[alive[~ok]] = n % 2 == 0
        alive = alive[ok]
    out[alive] = len(levels) % 2 == 1
    return out


def _bloom(keys: DataFrame, n: int, rate: float, level: int):
    """Distributed build: tasks set bits, equal bytes are OR-ed by Spark."""
    k = max(1, round(-math.log2(rate)))
    m = max(64, math.ceil(n * k / math.log(2)))
    if m > 8 * MAX_FILTER_BYTES:
        raise ValueError(f"Bloom level of {m} bits exceeds the bound; split the rule list")

    def bits(batches):
        for b in batches:
            h1, h2 = (b.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in (0, 1))
            pos = np.unique(np.concatenate([*_positions(h1, h2, level, k, m), np.empty(0, np.uint64)]))
            yield pa.RecordBatch.from_arrays([pa.array((pos >> np.uint64(3)).astype(np.int64)),
                                              pa.array((1 << (pos & np.uint64(7)).astype(np.int64)))], ["byte", "bit"])
    rows = (keys.select("h1", "h2").mapInArrow(bits, "byte long, bit long")
            .groupBy("byte").agg(F.bit_or("bit").alias("bit")).toPandas())
    out = np.zeros((m + 7) // 8, np.uint8)
    out[rows["byte"].to_numpy(dtype=np.int64)] = rows["bit"].to_numpy(dtype=np.uint8)
    return out, k, m


def _passing(keys: DataFrame, level: int, filt) -> DataFrame:
    """Rows of ``keys`` (with h1, h2, key) that pass one level."""
    sc = keys.sparkSession.sparkContext
    shared = sc.broadcast(filt)

    def run(batches):
        for b in batches:
            h1, h2 = (b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("h1", "h2"))
            yield b.filter(pa.array(passes(h1, h2, level, *shared.value)))
    return keys.mapInArrow(run, keys.schema)


def _hashed(keys: DataFrame) -> DataFrame:
    return keys.select("key", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def build_cascade(listed: DataFrame, universe: DataFrame, size: int, max_levels: int = 64) -> list:
    """Levels for the listed keys over the universe of ``size`` keys (both
    have a column ``key``; the universe may hold repeats)."""
    inside = stored(_hashed(listed.select("key").distinct()), "cascade-listed")
    r = inside.count()
    if not r:
        return []
    rate = min(0.5, r * math.sqrt(0.5) / max(1, size))
    levels = [_bloom(inside, r, rate, 1)]
    # the only pass over the universe: its keys that level 1 lets through
    through = _passing(_hashed(universe.select("key")), 1, levels[0]).distinct()
    outside = stored(through.join(inside.select("key"), "key", "left_anti"), "cascade-false")
    n, sides = outside.count(), [inside, outside]
    while n:
        if len(levels) == max_levels:
            raise ValueError("cascade does not end: two keys share both hashes")
        level = len(levels) + 1
        levels.append(_bloom(sides[1], n, 0.5, level))
        sides = [sides[1], stored(_passing(sides[0], level, levels[-1]), "cascade-level")]
        n = sides[1].count()
    return levels


def filter_urls(df: DataFrame, rules=RULES, url_col: str = "url", default: str = "allow") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` (null if none) and ``verdict``.

    The longest fitting rule decides; a key listed both ways is blocked."""
    spark = df.sparkSession
    lengths = sorted({len(p) for _, p, _ in rules}) or [0]
    parts = with_parts(df, url_col)
    cand = candidates(F.col("host"), F.col("path"), lengths)
    keys = parts.select(F.explode(F.transform(cand, lambda c: c.k)).alias("key"))
    size = keys.agg(F.approx_count_distinct("key")).first()[0]
    cascades = [build_cascade(spark.createDataFrame([(h + p,) for h, p, v in rules if v == kind] or [("",)], "key string")
                              .filter("key <> ''"), keys, size) for kind in ("block", "allow")]
    shared = spark.sparkContext.broadcast(cascades)

    @F.pandas_udf("struct<at: int, verdict: string>")
    def decide(h1, h2):
        import pandas as pd

        n = np.array([len(x) for x in h1], np.int64)
        flat = [np.concatenate([*map(np.asarray, h), np.empty(0, np.int64)]).astype(np.int64).view(np.uint64) for h in (h1, h2)]
        start = np.concatenate([[0], np.cumsum(n)])
        block, allow = (member(*flat, c) if c else np.zeros(len(flat[0]), bool) for c in shared.value)
        hits = np.flatnonzero(block | allow)
        first = np.searchsorted(hits, start[:-1])
        at = np.where(first < len(hits), hits[np.minimum(first, max(len(hits) - 1, 0))] if len(hits) else -1, -1)
        found = (at >= start[:-1]) & (at < start[1:])
        kind = np.where(found, np.where(block[at] if len(block) else False, "block", "allow"), default)
        return pd.DataFrame({"at": np.where(found, at - start[:-1], -1).astype(np.int32), "verdict": kind})

    out = parts.withColumn("_c", F.transform(cand, lambda c: c.k))
    out = out.withColumn("_d", decide(F.transform("_c", lambda k: F.xxhash64(k)),
                                      F.transform("_c", lambda k: F.xxhash64(F.lit(1), k))))
    return (out.withColumn("rule", F.when(F.col("_d.at") >= 0, F.get("_c", F.col("_d.at"))))
            .withColumn("verdict", F.col("_d.verdict")).drop("_c", "_d"))


def op2_url_filter(spark, sf_dir) -> DataFrame:
    """Verdict on every page URL."""
    return filter_urls(table(spark, sf_dir, "pages").select("page_id", "url")).select(
        "page_id", "host", "path", "rule", "verdict")


OP2_SQL = """
WITH p AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 1),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
r AS (SELECT page_id, host, path, CASE
  WHEN ('.' || host) LIKE '%.www.example.com' AND starts_with(path, '/en/') THEN 'www.example.com/en/'
  WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/en/') THEN 'example.com/en/'
  WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/es/') THEN 'net/es/'
  WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/fr/') THEN 'net/fr/'
  WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/') THEN 'com/' END AS rule FROM p)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict FROM r"""
