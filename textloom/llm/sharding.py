"""Sharding (operator 13): histogram sort into shards of near equal bytes.

Documents are ordered by a key of four integers: 60 bits of the text's MD5 (so
equal texts lie side by side), the two halves of ``doc_id``, and a row number
that breaks ties. Shard ``s`` should begin where ``s / shards`` of all bytes lie
below. Each round counts, over all partitions, the exact bytes below up to
``PROBES`` even boundaries inside every open splitter's interval, and narrows
the interval to the one probe that holds the wanted byte. An interval of a
single value goes on in the next integer of the key, so a text or id that holds
a third of all rows is cut like any other. A splitter is met when its bytes are
within ``tolerance`` of a shard's mean size, or at the nearest edge of the one
document that holds the wanted byte; tolerance 0, the default, always goes down
to that document, so the result follows from the rows alone. The driver sees at most
``shards * PROBES`` counts a round. Then rows cross one exchange, a range
partitioning by shard and key.

Defined results: null text counts as empty; null ``doc_id`` is ordered behind
all ids of the same text; rows equal in text and id are told apart by position
only; an empty table gives no rows; with fewer documents than shards some
shards stay empty; clashing column names raise in ``with_shards``.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import positions, stored, table

SHARDS = 24
OVERHEAD = 8          # bytes of a document beside its text
PROBES = 4096
TOLERANCE = 0.0
LAW = "bytes"
KEYS = ("_k0", "_k1", "_k2", "_k3")
# least and greatest value of each integer of the key
SPANS = ((0, (1 << 60) - 1), (-(1 << 31), 1 << 31), (0, (1 << 32) - 1), (0, (1 << 63) - 1))


class Cell(NamedTuple):
    """Keys that begin with ``prefix`` and go on with ``lo`` to ``hi``."""
    prefix: tuple
    lo: int
    hi: int


class Splitter(NamedTuple):
    """Right of it lie keys that begin with at least ``key``; with ``after``
    only those behind all that begin with it."""
    key: tuple
    after: bool


def size_of(text: str = "text") -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(OVERHEAD)


def key_columns(text: str = "text", doc_id: str = "doc_id") -> dict[str, Column]:
    """The four integers of the order key."""
    i = F.col(doc_id).cast("long")
    return dict(zip(KEYS, (
        F.conv(F.substring(F.md5(F.coalesce(text, F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long"),
        F.coalesce(F.shiftright(i, 32), F.lit(1 << 31)),
        F.coalesce(i.bitwiseAND(F.lit((1 << 32) - 1)), F.lit(0)),
        F.monotonically_increasing_id()), strict=True))


def _inside(cell: Cell) -> Column:
    at = F.col(KEYS[len(cell.prefix)])
    ok = at.between(cell.lo, cell.hi)
    for k, v in zip(KEYS, cell.prefix):
        ok = ok & (F.col(k) == v)
    return ok


def _histogram(keys: DataFrame, cells: list[Cell]) -> dict[int, list]:
    """``(bytes, least, greatest value)`` of each filled probe, by cell."""
    probe = None
    for i, c in enumerate(cells):
        at = KEYS[len(c.prefix)]
        width = max(1, -(-(c.hi - c.lo + 1) // PROBES))
        found = F.struct(F.lit(i).alias("cell"), F.expr(f"({at} - ({c.lo}L)) div {width}L").alias("probe"), F.col(at).alias("v"))
        probe = F.when(_inside(c), found) if probe is None else probe.when(_inside(c), found)
    rows = (keys.select("size", probe.alias("p")).filter("p is not null")
            .groupBy("p.cell", "p.probe").agg(F.sum("size").alias("bytes"), F.min("p.v").alias("lo"), F.max("p.v").alias("hi")).collect())
    out: dict[int, list] = {}
    for r in sorted(rows, key=lambda r: (r["cell"], r["probe"])):
        out.setdefault(r["cell"], []).append((int(r["bytes"]), r["lo"], r["hi"]))
    return out


def splitters(keys: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> list[Splitter]:
    """``shards - 1`` splitters over ``keys`` (``_k0`` to ``_k3`` and ``size``)."""
    total = int(keys.agg(F.sum("size")).first()[0] or 0)
    if not total:
        return []
    slack = tolerance * total               # times shards, as all sums below
    open_ = {s: (Cell((), *SPANS[0]), 0) for s in range(1, shards)}
    done: dict[int, Splitter] = {}
    while open_:
        cells = sorted({c for c, _ in open_.values()})
        counted = _histogram(keys, cells)
        for s, (cell, below) in list(open_.items()):
            want = s * total
            for size, lo, hi in counted[cells.index(cell)]:
                if (below + size) * shards > want:
                    break
                below += size
            left, right = want - below * shards, (below + size) * shards - want
            last = lo == hi and len(cell.prefix) == len(KEYS) - 1
            if left <= slack or right <= slack or last:
                after = right <= slack < left or (last and left > slack and right < left)
                done[s] = Splitter((*cell.prefix, hi if after else lo), after)
                del open_[s]
            elif lo == hi:
                open_[s] = Cell((*cell.prefix, lo), *SPANS[len(cell.prefix) + 1]), below
            else:
                open_[s] = Cell(cell.prefix, lo, hi), below
    return [done[s] for s in range(1, shards)]


def _right_of(b: Splitter) -> Column:
    cols = [F.col(k) for k in KEYS[:len(b.key)]]
    out = cols[-1] > b.key[-1] if b.after else cols[-1] >= b.key[-1]
    for c, v in list(zip(cols, b.key))[-2::-1]:
        out = (c > v) | ((c == v) & out)
    return out


def shard_of(bounds: list[Splitter]) -> Column:
    """The shard of a key: a binary search over the splitters."""
    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(_right_of(bounds[mid]), search(mid + 1, hi)).otherwise(search(lo, mid))
    return search(0, len(bounds))


def with_shards(df: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE, text: str = "text",
                doc_id: str = "doc_id") -> DataFrame:
    """``df`` with ``size`` and ``shard``; only keys and sizes are stored."""
    clash = {"size", "shard", *KEYS} & set(df.columns)
    if clash:
        raise ValueError(f"column(s) {sorted(clash)} would be replaced; rename them")
    rows = df.withColumns({**key_columns(text, doc_id), "size": size_of(text)})
    bounds = splitters(stored(rows.select(*KEYS, "size"), "shard-keys"), shards, tolerance)
    return rows.withColumn("shard", shard_of(bounds))


def write_shards(df: DataFrame, path: str, shards: int = SHARDS, tolerance: float = TOLERANCE) -> str:
    """Write ``df`` with its texts as Parquet, a folder a shard: whole rows
    cross one exchange and lie in key order."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = with_shards(df, shards, tolerance)
    (rows.repartitionByRange(n, "shard", *KEYS).sortWithinPartitions("shard", *KEYS).drop(*KEYS)
     .write.partitionBy("shard").parquet(path))
    return path


def assign(df: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of every row: ``slot`` is the
    place in the shard, by key and without gaps."""
    keys = stored(df.select(F.col("doc_id").cast("long"), size_of().alias("size"),
                            F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
                            *[c.alias(k) for k, c in key_columns().items()]), "shard-keys")
    rows = keys.withColumn("shard", shard_of(splitters(keys, shards, tolerance)))
    placed = positions(rows, ["shard", *KEYS], "shard-rows")
    held = {r["shard"]: r["n"] for r in placed.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    first = [sum(held.get(t, 0) for t in range(s)) for s in range(shards)]
    start = F.array(*[F.lit(x).cast("long") for x in first])
    return placed.select("doc_id", "size", "text_crc32", "shard", (F.col("pos") - F.get(start, "shard")).alias("slot"))


def op13_histogram_sort(spark, sf_dir) -> DataFrame:
    """Shard and slot of every document."""
    out = assign(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), F.col("shard").cast("int"), "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


# The wanted byte of shard s falls on the left half of the document that begins shard s or on the
# right half of the one before it, so a document's middle byte gives its shard. CRC-32 byte by byte.
OP13_SQL = r"""WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
d AS (SELECT rid, doc_id, CAST(octet_length(encode(t)) + 8 AS BIGINT) AS size, substr(md5(t), 1, 15) AS k, hex(encode(t)) AS x FROM docs),
c AS (SELECT *, sum(size) OVER (ORDER BY k, doc_id NULLS LAST, rid) AS upto, sum(size) OVER () AS total FROM d),
s AS (SELECT *, CAST(least(23, (12 * (2 * upto - size)) // total) AS INTEGER) AS shard FROM c),
tab AS (SELECT list(c ORDER BY i) AS tab FROM (SELECT i, list_reduce(range(8), lambda c, j:
  CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c FROM (SELECT unnest(range(256)) AS i)))
SELECT doc_id, size,
  CAST(xor(list_reduce(list_transform(regexp_extract_all(x, '..'), lambda h: CAST('0x' || h AS BIGINT)),
    lambda a, b: xor(tab[CAST(xor(a, b) & 255 AS BIGINT) + 1], a >> 8), 4294967295), 4294967295) AS BIGINT) AS text_crc32,
  'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY k, doc_id NULLS LAST, rid) - 1 AS slot,
  CAST(NULL AS INTEGER) AS grown_shard
FROM s, tab"""
