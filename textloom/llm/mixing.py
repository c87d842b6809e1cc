"""Mixing sources to target weights (operator 1): soft-membership mixing.

A classifier trained on the labelled table gives each document a posterior
over domains (quality x toxic). Nonnegative document rates are then fitted so
that the expected tokens of each domain, ``T_k = sum_d rate_d n_d p_dk``, match
``weight_k x budget``: projected gradient steps on the least-squares misfit,
``rate <- max(0, rate - step * p_d . P (T - target))``, where the misfit is
weighted by ``P``, the inverse of the domains' second-moment matrix (that makes
a step of 1 a Newton step while no rate is at zero). Rates are not stored per
step: a rate follows from the document's posterior and the list of step
vectors (one number per domain and step), so a step is one aggregation of K
sums and the driver holds K x steps numbers.

The classifier is a softmax on hashed words (presence), fitted on a bounded
sample of labelled rows (``LABEL_ROWS``, smallest hash of the id first).

Defined results: null or empty text has posterior at the classifier's bias and
no tokens; documents that are not labelled are like others; repeated labels
of an id are used as they are, null labels are dropped; with no labels, one
domain posterior is uniform; repeated rows get equal rates; targets that no
rates can reach give the least-squares rates; an empty table gives no rows;
other input columns are kept, the results replace columns of the same name.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.common import Shared, fresh, small_batches, stored, table

LABEL_ROWS = 8000     # bound of the classifier's sample
BUCKETS = 1 << 16
# domains: 2 * quality + toxic; target shares of the mixture's tokens
DOMAINS = ("low_clean", "low_toxic", "high_clean", "high_toxic")
TARGETS = (0.10, 0.02, 0.86, 0.02)
ROWS = 64             # texts that a worker holds as Python objects at once
STEPS = 30
TOLERANCE = 1e-6


def features(text: str | None) -> tuple[np.ndarray, int]:
    """Sorted distinct word buckets of a whole text, and its word count."""
    w = (text or "").encode().lower().split()
    crc = zlib.crc32
    return np.unique(np.array([crc(x.strip(b".,;:!?")) for x in set(w)], np.int64) & (BUCKETS - 1)), len(w)


class Softmax:
    """Sparse softmax by AdaGrad on word presence; rare buckets are damped."""

    def __init__(self, k: int):
        self.w, self.b = np.zeros((BUCKETS, k), np.float32), np.zeros(k, np.float32)

    def fit(self, rows: list[tuple[np.ndarray, int]], epochs: int = 12, rate: float = 0.15, l2: float = 1e-4, seed: int = 7):
        k = len(self.b)
        if not rows:
            return self
        share = np.bincount([y for _, y in rows], minlength=k) + 1.0
        self.b[:] = np.log(share / share.sum())
        # a bucket must occur in enough labelled rows to say anything
        seen = np.bincount(np.concatenate([f for f, _ in rows]), minlength=BUCKETS)
        use = seen >= 8
        rows = [(f[use[f]], y) for f, y in rows]
        g2, rng = np.full_like(self.w, 1e-2), np.random.default_rng(seed)
        for _ in range(epochs):
            for at in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // 64)):
                f = np.concatenate([rows[i][0] for i in at])
                n = np.array([len(rows[i][0]) for i in at])
                doc = np.repeat(np.arange(len(at)), n)
                y = np.array([rows[i][1] for i in at])
                z = np.stack([np.bincount(doc, self.w[f, c], len(at)) for c in range(k)], 1) + self.b
                p = np.exp(z - z.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                p[np.arange(len(at)), y] -= 1
                p /= len(at)
                u, inv = np.unique(f, return_inverse=True)
                g = np.stack([np.bincount(inv, p[doc, c], len(u)) for c in range(k)], 1) + l2 * self.w[u]
                g2[u] += g * g
                self.w[u] -= rate * g / np.sqrt(g2[u])
                self.b -= 0.1 * p.sum(0)
        return self

    def posterior(self, f: np.ndarray) -> np.ndarray:
        z = self.w[f].sum(0, dtype=np.float64) + self.b
        p = np.exp(z - z.max())
        return p / p.sum()


def train(docs: DataFrame, labels: DataFrame, limit: int = LABEL_ROWS) -> Softmax:
    """Fit the domain classifier on a bounded sample of labelled rows."""
    some = (labels.filter("doc_id is not null and quality in (0, 1) and toxic in (0, 1)")
            .select("doc_id", (F.col("quality") * 2 + F.col("toxic")).cast("int").alias("y"))
            .orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(limit))
    some = stored(some, "mix-labels")

    def run(batches):
        for b in batches:
            got = [features(x.as_py())[0] for x in b.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(got, pa.list_(pa.int64())), b.column(1), b.column(2)], ["f", "y", "doc_id"])
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(some), "doc_id")
            .select("text", "y", "doc_id").mapInArrow(run, "f array<long>, y int, doc_id long")
            .orderBy(F.xxhash64("doc_id"), "y", F.xxhash64("f")).limit(limit).select("f", "y").toPandas())
    return Softmax(len(DOMAINS)).fit([(np.asarray(f, np.int64), int(y)) for f, y in zip(rows["f"], rows["y"], strict=True)])


POSTERIOR = T.StructType([T.StructField("p", T.ArrayType(T.DoubleType())), T.StructField("n_tokens", T.LongType())])


def with_posteriors(docs: DataFrame, model: Softmax, keep: list[str] | None = None) -> DataFrame:
    """Add ``p`` (domain posteriors) and ``n_tokens`` to the columns ``keep`` (all)
    of ``docs``. Rows stream through the worker ``ROWS`` at a time. With all columns
    kept, a plain UDF gets the texts (Spark hands it a hundred rows at once, whatever
    the session's Arrow batches) and the rows stay with Spark."""
    shared = Shared(docs.sparkSession, model)
    if keep is None:
        def score(text):
            f, size = features(text)
            return shared.value.posterior(f).tolist(), size
        s = fresh(docs, "_s")
        scored = docs.withColumn(s, F.udf(score, POSTERIOR, useArrow=False)("text"))
        return scored.withColumns({"p": F.col(f"{s}.p"), "n_tokens": F.col(f"{s}.n_tokens")}).drop(s)
    kept = docs.select(*keep)
    p, n = fresh(docs, "_p"), fresh(docs, "_n")
    names, text = [*kept.columns, p, n], len(kept.columns)

    def run(batches):
        for b in (x.slice(at, ROWS) for x in batches for at in range(0, x.num_rows, ROWS)):
            ps, ns = [], []
            for t in b.column(text):
                f, size = features(t.as_py())
                ps.append(shared.value.posterior(f))
                ns.append(size)
            yield pa.RecordBatch.from_arrays([*b.columns[:text], pa.array(ps, pa.list_(pa.float64())), pa.array(ns, pa.int64())], names)
    schema = T.StructType([*[T.StructField(f.name, f.dataType, True, f.metadata) for f in kept.schema],
                           *[T.StructField(c, f.dataType) for c, f in zip((p, n), POSTERIOR, strict=True)]])
    # the text goes in as the last column; only kept ones come back
    scored = docs.select(*kept.columns, F.col("text").alias(fresh(docs, "_text"))).mapInArrow(run, schema)
    return scored.withColumns({"p": F.col(p), "n_tokens": F.col(n)}).drop(p, n)


def _stored_posteriors(docs: DataFrame, model: Softmax, keep: list[str]) -> DataFrame:
    with small_batches(docs.sparkSession):
        return stored(with_posteriors(docs, model, keep), "mix-posteriors")


def _rate(steps: list[np.ndarray]):
    """Rate of a document after the given projected steps, from 1."""
    if not steps:
        return F.lit(1.0)
    vec = F.array(*[F.array(*[F.lit(float(x)) for x in s]) for s in steps])
    return F.aggregate(vec, F.lit(1.0), lambda r, v: F.greatest(F.lit(0.0), r - sum(
        (F.get(F.col("p"), F.lit(k)) * F.get(v, F.lit(k)) for k in range(len(steps[0]))), F.lit(0.0))))


def fit_rates(docs: DataFrame, targets=TARGETS, max_steps: int = STEPS, tolerance: float = TOLERANCE) -> list[np.ndarray]:
    """Step vectors of the fitted rates for rows with ``p`` and ``n_tokens``."""
    k = len(targets)
    row = docs.agg(F.sum("n_tokens"), *[F.sum(F.col("n_tokens") * F.get("p", F.lit(i)) * F.get("p", F.lit(j)))
                                        for i in range(k) for j in range(k)]).first()
    total = float(row[0] or 0)
    if not total:
        return []
    moment = np.array([float(x or 0) for x in row[1:]]).reshape(k, k) / total
    weight = np.linalg.inv(moment + 1e-9 * np.trace(moment) * np.eye(k))
    want, steps = np.array(targets) / sum(targets), []
    best, kept, step = np.inf, [], 1.0
    for _ in range(max_steps):
        got = docs.select("p", "n_tokens", _rate(steps).alias("r")).agg(
            *[F.sum(F.col("r") * F.col("n_tokens") * F.get("p", F.lit(i))) for i in range(k)]).first()
        miss = np.array([float(x) for x in got]) / total - want
        size = float(miss @ weight @ miss)
        if size < best:
            best, kept = size, list(steps)
        else:
            step *= 0.5         # overshoot at the bound: shorter steps from the best
            steps = list(kept)
        if np.abs(miss).max() < tolerance:
            break
        if size <= best:
            grad = weight @ miss
        steps.append(step * grad)
    return kept


def mix(docs: DataFrame, labels: DataFrame, targets=TARGETS) -> DataFrame:
    """Add ``p``, ``n_tokens`` and ``rate`` to every document."""
    model = train(docs, labels)
    small = _stored_posteriors(docs, model, [])
    return with_posteriors(docs, model).withColumn("rate", _rate(fit_rates(small, targets)))


def op1_mixing(spark, sf_dir) -> DataFrame:
    """Posterior and rate of every document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = _stored_posteriors(docs, train(docs, labels), ["doc_id"])
    return scored.withColumn("rate", _rate(fit_rates(scored))).select(
        "doc_id", "n_tokens", *[F.get("p", F.lit(i)).alias(f"p_{d}") for i, d in enumerate(DOMAINS)], "rate")
