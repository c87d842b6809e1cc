"""A softmax layer over hashed tokens, trained by distributed steps (M7).

A text is its basic tokens (P15), hashed natively to ``num_features`` buckets; a
row's features are ``1 + ln(count)`` of its buckets, scaled to length 1, so long
texts stay in range. Rows are kept sparse throughout.

A step sums the gradient of one global batch: every task adds up the sparse
gradients of its rows chunk by chunk, sends the touched blocks of
``BLOCK`` weights, and blocks are added by key, in two rounds where there are
many tasks. The batch a row belongs to is a hash of its id, not of its
partition, so a result depends on partitioning through the order of sums only.
Weights and their step are ``num_features * n_classes`` numbers, which bounds
what is broadcast and what the driver holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.text import basic_tokens
from textloom.sources.corpus import ROW_ID, TEXT

BLOCK = 4096              # weights of a block
CHUNK = 1 << 18           # tokens worked on at once
FAN_IN = 64               # tasks whose blocks are added in one round
STEP = "step"
FEATURES = f"{ROW_ID} bigint, code int, idx array<int>, val array<double>"


class Softmax(NamedTuple):
    """``weights[c, f]``; the last column is the bias."""
    weights: np.ndarray
    max_length: int | None = None

    @property
    def num_features(self) -> int:
        return self.weights.shape[1] - 1


class Rules(NamedTuple):
    """How a summed gradient becomes a step (AdamW with a linear schedule)."""
    rate: float = 0.1             # reached after the warm-up, falling to 0 at the last step
    warmup: float = 0.1           # share of all steps
    clip: float | None = 1.0      # greatest norm of a step's gradient
    decay: float = 0.0            # weight decay (not of the bias)
    accumulate: int = 1           # global batches summed before a step
    beta1: float = 0.9
    beta2: float = 0.999
    eps: float = 1e-8


class Optimizer:
    """Adam moments and the step rules."""

    def __init__(self, shape, rules: Rules, total_steps: int):
        self.rules, self.total, self.t = rules, max(1, total_steps), 0
        self.m, self.v = np.zeros(shape), np.zeros(shape)

    def rate(self, t: int) -> float:
        """Learning rate of step ``t`` (from 1)."""
        warm = int(np.ceil(self.rules.warmup * self.total))
        if t <= warm:
            return self.rules.rate * t / warm
        return self.rules.rate * (self.total - t + 1) / (self.total - warm)

    def step(self, weights: np.ndarray, gradient: np.ndarray) -> np.ndarray:
        r, self.t = self.rules, self.t + 1
        norm = float(np.sqrt((gradient * gradient).sum()))
        if r.clip is not None and norm > r.clip:
            gradient = gradient * (r.clip / norm)
        self.m = r.beta1 * self.m + (1 - r.beta1) * gradient
        self.v = r.beta2 * self.v + (1 - r.beta2) * gradient * gradient
        rate = self.rate(self.t)
        move = (self.m / (1 - r.beta1 ** self.t)) / (np.sqrt(self.v / (1 - r.beta2 ** self.t)) + r.eps)
        kept = weights * (1 - rate * r.decay)
        kept[:, -1] = weights[:, -1]
        return kept - rate * move


# -- features ------------------------------------------------------------------
def token_buckets(text, num_features: int, max_length: int | None = None) -> Column:
    """Bucket of every basic token; ``max_length`` keeps the first
    ``max_length - 2``, as an encoder with a fixed input would."""
    tokens = basic_tokens(text)
    if max_length is not None:
        tokens = F.slice(tokens, 1, max_length - 2)
    hashed = F.transform(tokens, lambda t: F.pmod(F.xxhash64(t), F.lit(num_features)).cast("int"))
    return F.coalesce(hashed, F.array().cast("array<int>"))


def sparse_rows(lengths: np.ndarray, buckets: np.ndarray, num_features: int):
    """``row, bucket, value`` of rows given by their lists of buckets."""
    row = np.repeat(np.arange(len(lengths)), lengths)
    key, n = np.unique(row * num_features + buckets, return_counts=True)
    row, idx = np.divmod(key, num_features)
    val = 1 + np.log(n)
    norm = np.sqrt(np.bincount(row, val * val, minlength=len(lengths)))
    return row, idx, val / norm[row]


def _chunks(lengths: np.ndarray):
    """Ranges of rows of at most ``CHUNK`` entries (or one row)."""
    a, ends = 0, np.cumsum(lengths)
    while a < len(lengths):
        start = ends[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(ends, start + CHUNK, "right")))
        yield a, b, int(start), int(ends[b - 1])
        a = b


def _lists(lengths: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), values)


def featurize(df: DataFrame, num_features: int, path: str, steps: int | None = None, seed: int = 0,
              text_col: str = TEXT, max_length: int | None = None) -> DataFrame:
    """``row_id, code, idx, val`` of every row, written once below ``path``;
    with ``steps``, in one folder a global batch (``step``)."""
    cols = [F.col(ROW_ID).cast("bigint").alias(ROW_ID), F.col("code").cast("int").alias("code"),
            token_buckets(F.col(text_col), num_features, max_length).alias("ids")]
    if steps:
        cols.append(F.pmod(F.xxhash64(F.lit(seed), F.col(ROW_ID)), F.lit(steps)).cast("int").alias(STEP))

    def run(batches):
        for batch in batches:
            lengths = batch.column(2).value_lengths().to_numpy().astype(np.int64)
            flat = batch.column(2).flatten().to_numpy()
            for a, b, at, end in _chunks(lengths):
                row, idx, val = sparse_rows(lengths[a:b], flat[at:end], num_features)
                n = np.bincount(row, minlength=b - a)
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), _lists(n, pa.array(idx, pa.int32())), _lists(n, pa.array(val, pa.float64())),
                     *part.columns[3:]], ["row_id", "code", "idx", "val", *part.schema.names[3:]])

    out = df.select(*cols).mapInArrow(run, FEATURES + (f", {STEP} int" if steps else ""))
    writer = out.write.mode("overwrite")
    (writer.partitionBy(STEP) if steps else writer).parquet(path)
    return df.sparkSession.read.schema(out.schema).parquet(path)


# -- scoring ------------------------------------------------------------------
def _logits(weights: np.ndarray, n: int, row: np.ndarray, idx: np.ndarray, val: np.ndarray) -> np.ndarray:
    out = np.empty((n, len(weights)))
    for c, w in enumerate(weights):
        out[:, c] = np.bincount(row, val * w[idx], minlength=n) + w[-1]
    return out


def _entries(lists: pa.Array):
    return lists.value_lengths().to_numpy().astype(np.int64), lists.flatten().to_numpy()


def logits(model: Softmax, spark: SparkSession, *inputs: Column) -> Column:
    """``array<double>`` of class logits, from a column of token buckets or
    from ``idx, val``."""
    shared = spark.sparkContext.broadcast(model.weights)
    num_features, n_classes = model.num_features, len(model.weights)

    def finished(parts):
        z = np.concatenate(parts) if parts else np.empty((0, n_classes))
        return _lists(np.full(len(z), n_classes), pa.array(z.ravel(), pa.float64()))

    def from_buckets(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        def scored(lists):
            lengths, flat = _entries(lists)
            return finished([_logits(shared.value, b - a, *sparse_rows(lengths[a:b], flat[at:end], num_features))
                             for a, b, at, end in _chunks(lengths)])
        yield from map(scored, batches)       # holds no batch while the next is read

    def from_entries(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        def scored(pair):
            idx, val = pair
            lengths, flat = _entries(idx)
            values = val.flatten().to_numpy()
            return finished([_logits(shared.value, b - a, np.repeat(np.arange(b - a), lengths[a:b]), flat[at:end], values[at:end])
                             for a, b, at, end in _chunks(lengths)])
        yield from map(scored, batches)

    return F.arrow_udf(from_buckets if len(inputs) == 1 else from_entries, "array<double>")(*inputs)


# -- training ------------------------------------------------------------------
def _gradients(batches, weights: np.ndarray):
    """Blocks of the summed gradient of all rows; block -1 has their number,
    summed loss and hits."""
    total, stats = np.zeros_like(weights), np.zeros(3)
    for batch in batches:
        lengths, flat = _entries(batch.column(1))
        values, codes = batch.column(2).flatten().to_numpy(), batch.column(0).to_numpy()
        for a, b, at, end in _chunks(lengths):
            n, y = b - a, codes[a:b]
            row, idx, val = np.repeat(np.arange(n), lengths[a:b]), flat[at:end], values[at:end]
            z = _logits(weights, n, row, idx, val)
            hits = (z.argmax(1) == y).sum()
            z -= z.max(1, keepdims=True)
            e = np.exp(z)
            s = e.sum(1)
            stats += n, (np.log(s) - z[np.arange(n), y]).sum(), hits
            e /= s[:, None]
            e[np.arange(n), y] -= 1
            for c in range(len(weights)):
                total[c, :-1] += np.bincount(idx, val * e[row, c], minlength=weights.shape[1] - 1)
            total[:, -1] += e.sum(0)
    flat = np.append(total.ravel(), np.zeros(-total.size % BLOCK)).reshape(-1, BLOCK)
    touched = np.flatnonzero(flat.any(1))
    for a in range(0, len(touched), 256):
        part = touched[a:a + 256]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array([flat[k].tobytes() for k in part], pa.binary())],
                                         ["block", "sums"])
    yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([stats.tobytes()], pa.binary())], ["block", "sums"])


def _added(batches):
    """One row a block of what reaches this task."""
    held: dict = {}
    for batch in batches:
        for block, sums in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            x = np.frombuffer(sums.as_buffer())
            held[block] = held[block] + x if block in held else x.copy()
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([x.tobytes() for x in held.values()], pa.binary())],
                                         ["block", "sums"])


def gradient(rows: DataFrame, weights: np.ndarray, many: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Mean gradient over ``rows`` (``code, idx, val``), and their number,
    summed loss and hits."""
    shared = rows.sparkSession.sparkContext.broadcast(weights)
    schema = "block int, sums binary"
    parts = rows.select("code", "idx", "val").mapInArrow(lambda batches: _gradients(batches, shared.value), schema)
    if many:
        parts = parts.repartition(F.col("block"), F.pmod(F.spark_partition_id(), F.lit(FAN_IN))).mapInArrow(_added, schema)
    table = parts.repartition("block").mapInArrow(_added, schema).toArrow()
    shared.destroy()
    flat, stats = np.zeros(-(-weights.size // BLOCK) * BLOCK).reshape(-1, BLOCK), np.zeros(3)
    for block, sums in zip(table.column(0).to_pylist(), table.column(1), strict=True):
        if block < 0:
            stats = np.frombuffer(sums.as_buffer()).copy()
        else:
            flat[block] = np.frombuffer(sums.as_buffer())
    return flat.ravel()[:weights.size].reshape(weights.shape) / max(1.0, stats[0]), stats


class Trainer:
    """Epochs over the global batches that ``featurize`` wrote."""

    def __init__(self, features: DataFrame, path: str, n_classes: int, num_features: int, epochs: int,
                 rules: Rules | None = None, weights: np.ndarray | None = None, seed: int = 0):
        self.spark, self.path, self.seed = features.sparkSession, path, seed
        self.schema = features.drop(STEP).schema
        self.rules = rules or Rules()
        # folder names only: which global batches have rows
        self.steps = sorted(r[0] for r in features.select(STEP).distinct().collect())
        self.many = features.rdd.getNumPartitions() > FAN_IN * max(1, len(self.steps))
        self.weights = np.zeros((n_classes, num_features + 1)) if weights is None else weights.copy()
        self.optimizer = Optimizer(self.weights.shape, self.rules, epochs * -(-len(self.steps) // self.rules.accumulate))

    def batch(self, step: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{STEP}={step}")

    def epoch(self, number: int) -> tuple[float, float]:
        """One pass in an order of its own; mean batch loss and accuracy, as
        the batches are met. A loss that is not finite is an error."""
        order = np.random.default_rng((self.seed, number)).permutation(self.steps).tolist()
        losses, seen = [], np.zeros(3)
        for at in range(0, len(order), self.rules.accumulate):
            total = np.zeros_like(self.weights)
            group = order[at:at + self.rules.accumulate]
            for step in group:
                mean, stats = gradient(self.batch(step), self.weights, self.many)
                total += mean / len(group)
                losses.append(stats[1] / max(1.0, stats[0]))
                seen += stats
            if not np.isfinite(losses).all():
                raise ArithmeticError(f"the loss of epoch {number} is not finite")
            self.weights = self.optimizer.step(self.weights, total)
        return float(np.mean(losses)) if losses else 0.0, float(seen[2] / max(1.0, seen[0]))
