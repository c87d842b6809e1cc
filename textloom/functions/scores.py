"""Numeric column expressions.

Array math uses Spark's higher-order functions (``transform`` /
``aggregate``), which are evaluated in the JVM without Python workers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's behaviour)
# ---------------------------------------------------------------------------
# Token-length bins: right-closed (lo, hi]; 0 falls in no bin.
LENGTH_BIN_EDGES = (0, 32, 64, 128, 192, 256, 384, 512)
LENGTH_BIN_LABELS = ("0-32", "32-64", "64-128", "128-192", "192-256",
                     "256-384", "384-512", "512+")
# Per-class status words of the cleaning report.
STATUS_KEEP = "保留"
STATUS_DELETE = "删除"
# ---------------------------------------------------------------------------


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def keep_flag(n, min_samples: int) -> Column:
    """P5: keep/delete status of a class with ``n`` rows (inclusive)."""
    return F.when(_c(n) >= F.lit(min_samples), F.lit(STATUS_KEEP)).otherwise(F.lit(STATUS_DELETE))


def _with(value, fn) -> Column:
    """``fn(value)`` with ``value`` evaluated once a row: inside a lambda a
    plain column expression would be evaluated again for every element."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def _exp_sum(e) -> Column:
    return F.aggregate(e, F.lit(0.0).cast("double"), lambda acc, v: acc + v)


def softmax(logits) -> Column:
    """Row softmax with max subtraction, linear in the classes."""
    return _with(_c(logits), lambda z: _with(F.array_max(z), lambda m: _with(
        F.transform(z, lambda v: F.exp(v - m)), lambda e: _with(
            _exp_sum(e), lambda s: F.transform(e, lambda v: v / s)))))


def argmax(logits) -> Column:
    """0-based index of the largest value; lowest index wins ties."""
    z = _c(logits)
    return (F.array_position(z, F.array_max(z)) - F.lit(1)).cast("int")


def row_cross_entropy(logits, label) -> Column:
    """-log softmax(z)[label] computed as logsumexp(z) - z[label]."""
    lse = _with(_c(logits), lambda z: _with(F.array_max(z), lambda m: F.log(
        F.aggregate(z, F.lit(0.0).cast("double"), lambda acc, v: acc + F.exp(v - m))) + m))
    return lse - F.element_at(_c(logits), _c(label).cast("int") + F.lit(1))


def length_bin(n) -> Column:
    """Label of the right-closed length bin (null for 0 and below)."""
    c = _c(n)
    expr = F.when(c > F.lit(LENGTH_BIN_EDGES[-1]), F.lit(LENGTH_BIN_LABELS[-1]))
    for lo, hi, lab in zip(LENGTH_BIN_EDGES[:-1], LENGTH_BIN_EDGES[1:], LENGTH_BIN_LABELS):
        expr = expr.when((c > F.lit(lo)) & (c <= F.lit(hi)), F.lit(lab))
    return expr


def length_bin_ord(n) -> Column:
    """Ordinal (1..8) of ``length_bin``; null when no bin applies."""
    c = _c(n)
    expr = F.when(c > F.lit(LENGTH_BIN_EDGES[-1]), F.lit(len(LENGTH_BIN_LABELS)))
    for i, (lo, hi) in enumerate(zip(LENGTH_BIN_EDGES[:-1], LENGTH_BIN_EDGES[1:]), start=1):
        expr = expr.when((c > F.lit(lo)) & (c <= F.lit(hi)), F.lit(i))
    return expr
