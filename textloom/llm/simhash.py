"""SimHash near-dedup (operator 4): generalised pigeonhole.

Bits are grouped into partitions of correlated bits (their correlations are
counted over all fingerprints). For ``r`` differing bits and ``m`` partitions,
thresholds ``t_i`` (-1 skips a partition) with sum ``r - m + 1`` guarantee that
two linked fingerprints are within ``t_i`` in some partition; dynamic
programming picks the thresholds with the least estimated work (signature rows
plus candidate pairs), and the least of all ``m`` wins. Signatures are probed
by an equi-join of distinct fingerprints and every candidate is verified.

A bucket of over ``BUCKET`` fingerprints is not paired out. Its members link
through shared neighbours instead: each lists itself and its 64 one-bit
neighbours; fingerprints that list the same value are within two bits, and any
two within two bits list a common value. At most 65 fingerprints list a value,
so this exact way is linear (it needs ``max_bits`` 2; other limits pair all).

Components are found by alternating large and small stars on distinct
fingerprints, whose copies were merged before.

Defined results: null or empty text has fingerprint zero, linked like any
other; repeated rows share fingerprint and component; null ``doc_id`` takes
part, but is never a component's smallest id unless all are null; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import numbered, stored, table, without_rows

SEED = 42        # fixed value of the contract
BUCKET = 32
CHUNK = 1 << 15


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash (signed) of a whole text."""
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    votes, n = np.zeros(64, np.int64), max(1, len(w) - shingle + 1)
    for a in range(0, n, CHUNK):
        b = min(n, a + CHUNK)
        h = np.array([xxhash.xxh64_intdigest(b" ".join(w[i:i + shingle]), SEED) for i in range(a, b)], "<u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<i8")[0])


def fingerprints(df: DataFrame, shingle: int = 3) -> DataFrame:
    """``doc_id, fp`` of every row, stored."""
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 64):
                part = b.slice(at, 64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(
                    [fingerprint(x.as_py(), shingle) for x in part.column(1)], pa.int64())], ["doc_id", "fp"])
    return stored(df.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long"), "simhash-fp")


def bit_counts(distinct: DataFrame) -> np.ndarray:
    """64 x 64 counts of bits set together, over all distinct fingerprints."""
    def run(batches):
        total = np.zeros((64, 64))
        for b in batches:
            x = np.ascontiguousarray(b.column(0).to_numpy(zero_copy_only=False).astype("<i8"))
            for at in range(0, len(x), CHUNK):
                bits = np.unpackbits(x[at:at + CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
                total += bits.T @ bits
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(4096)), pa.array(total.ravel())], ["cell", "n"])
    rows = distinct.select("fp").mapInArrow(run, "cell long, n double").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(4096)
    out[rows["cell"].to_numpy(dtype=int)] = rows["n"]
    return out.reshape(64, 64)


def partitions(corr: np.ndarray, m: int) -> list[list[int]]:
    """m groups of even width; each grows by the bit most correlated to it."""
    left, out = set(range(64)), []
    for i in range(m):
        width = len(left) // (m - i)
        group = [max(sorted(left), key=lambda b: corr[b, sorted(left)].sum())]
        left.discard(group[0])
        while len(group) < width:
            nxt = max(sorted(left), key=lambda b: corr[b, group].sum())
            group.append(nxt)
            left.discard(nxt)
        out.append(sorted(group))
    return out


def plan(both: np.ndarray, n: int, r: int) -> list[tuple[list[int], int]]:
    """Partitions with thresholds of least estimated work."""
    p = np.diag(both) / max(1, n)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs((both / max(1, n) - np.outer(p, p)) / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    differ, best = 2 * p * (1 - p), None
    for m in range(1, r + 3):
        groups, costs = partitions(corr, m), []
        for g in groups:
            near = np.zeros(r + 1)      # chance that a pair differs in exactly j of the bits
            near[0] = 1
            # correlated bits differ together: fewer effective bits
            weight = 1 / (1 + corr[np.ix_(g, g)].sum(1) / 2)
            for b, w in zip(g, weight, strict=True):
                q = 1 - (1 - differ[b]) ** w
                near[1:], near[0] = near[1:] * (1 - q) + near[:-1] * q, near[0] * (1 - q)
            costs.append([0.0] + [n * (1 + sum(math.comb(len(g), j) for j in range(t + 1))) + n * n / 2 * near[:t + 1].sum()
                                  for t in range(r + 1)])
        # dynamic programming over partitions and the thresholds' sum so far
        table_ = {0: (0.0, [])}
        for c in costs:
            new = {}
            for s, (cost, ts) in table_.items():
                for t in range(-1, r + 1):
                    got = (cost + c[t + 1], [*ts, t])
                    if s + t not in new or got < new[s + t]:
                        new[s + t] = got
            table_ = new
        cost, ts = table_[r - m + 1]
        if best is None or cost < best[0]:
            best = (cost, [(g, t) for g, t in zip(groups, ts, strict=True) if t >= 0])
    return best[1]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def links(distinct: DataFrame, max_bits: int = 2, bucket: int = BUCKET) -> DataFrame:
    """Pairs ``a, b`` of distinct fingerprints that connect all that link."""
    n = distinct.count()
    parts = plan(bit_counts(distinct), n, max_bits)
    masks = [_signed(sum(1 << b for b in g)) for g, _ in parts]
    keys = F.array(*[F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(x)).alias("key")) for i, x in enumerate(masks)])
    own = stored(distinct.select("fp", F.explode(keys).alias("k")).select("k.part", "k.key", "fp"), "simhash-keys")
    crowded = stored(own.groupBy("part", "key").agg(F.count("*").alias("n")).filter(F.col("n") > bucket), "simhash-crowded")
    hot = own.join(crowded.select("part", "key"), ["part", "key"], "left_semi") if max_bits == 2 else own.limit(0)
    cold = own.join(crowded.select("part", "key"), ["part", "key"], "left_anti") if max_bits == 2 else own
    probes = cold
    wide = [(i, g, t) for i, (g, t) in enumerate(parts) if t > 0]
    for i, g, t in wide:
        import itertools

        flips = [_signed(sum(1 << b for b in c)) for j in range(1, t + 1) for c in itertools.combinations(g, j)]
        probes = probes.unionByName(own.filter(F.col("part") == i).select(
            "part", F.explode(F.transform(F.array(*[F.lit(x) for x in flips]), lambda x: x.bitwiseXOR(F.col("key")))).alias("key"), "fp"))
    pairs = (probes.alias("p").join(cold.alias("c"), ["part", "key"])
             .filter((F.col("p.fp") != F.col("c.fp")) & (F.bit_count(F.col("p.fp").bitwiseXOR(F.col("c.fp"))) <= max_bits))
             .select(F.least("p.fp", "c.fp").alias("a"), F.greatest("p.fp", "c.fp").alias("b")))
    if not wide:
        pairs = pairs.distinct()
    if max_bits != 2:
        return pairs.distinct()
    # members of crowded buckets (and, for flips into them, whoever is near) by shared neighbours
    members = hot.select("fp").distinct()
    if wide:
        reach = probes.join(crowded.select("part", "key"), ["part", "key"], "left_semi").select("fp")
        members = members.unionByName(reach).distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << b)) for b in range(64)])
    near = stored(members.select("fp", F.explode(F.transform(flips, lambda x: x.bitwiseXOR(F.col("fp")))).alias("v")), "simhash-near")
    low = near.groupBy("v").agg(F.min("fp").alias("low"), F.count("*").alias("n")).filter("n > 1")
    stars = near.join(low, "v").filter("fp > low").select(F.col("low").alias("a"), F.col("fp").alias("b"))
    return pairs.unionByName(stars).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, root`` (smallest reachable) for every node of an edge."""
    e = stored(edges.select("a", "b"), "star")
    mark = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = stored(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), "star-low")
        large = stored(both.filter("b > a").join(low, "a").select(F.col("m").alias("a"), "b")
                       .distinct(), "star-large")          # larger neighbours to the minimum
        down = large.groupBy("b").agg(F.min("a").alias("m"))
        down = stored(down, "star-low")
        e = stored(large.join(down, "b").select(F.least("a", "m").alias("m"), F.col("a"), "b")
                   .select(F.explode(F.array(F.struct(F.col("m").alias("a"), F.col("b").alias("b")),
                                             F.struct(F.col("m").alias("a"), F.col("a").alias("b")))).alias("x"))
                   .select("x.*").filter("a != b").distinct(), "star")
        new = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == mark:
            break
        mark = new
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("b").alias("node"), F.col("a").alias("root"))


def near_duplicates(df: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``doc_id, fp, component_id`` of every row."""
    fps = fingerprints(df, shingle)
    ids = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-distinct")
    comp = stored(components(links(ids.select("fp"), max_bits)), "simhash-comp")
    rooted = ids.join(comp.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = stored(rooted, "simhash-rooted")
    least = stored(rooted.groupBy("root").agg(F.min("low").alias("component_id")), "simhash-least")
    # written before the join: Spark can split a hot fingerprint in it
    label = stored(rooted.join(least, "root").select("fp", "component_id"), "simhash-label")
    return fps.join(label, "fp")


def keep_first(docs: DataFrame, shingle: int = 3, max_bits: int = 2, scan: bool = False) -> DataFrame:
    """One document of each group: the first row with the smallest id. Rows
    that go are listed and left out of ``docs``; ``scan``: see ``numbered``."""
    rows, row = numbered(docs, "simhash-docs", scan)
    # rows are numbered apart from their ids, which may be null or repeated
    found = near_duplicates(rows.select(F.col(row).alias("doc_id"), "text"), shingle, max_bits)
    ids = rows.select(F.col(row).alias("row"), "doc_id").join(found.select(F.col("doc_id").alias("row"), "component_id"), "row")
    ids = stored(ids, "simhash-members")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))
    kept = ids.groupBy("component_id").agg(F.min_by("row", order).alias("row")).select("row")
    return without_rows(rows, row, ids.select("row").join(kept, "row", "left_anti"))


def op4_simhash_dedup(spark, sf_dir) -> DataFrame:
    """Fingerprint and component of every document."""
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
