"""Substring dedup (operator 7): sliding sentence spans.

A text is cut into pieces that join back to it: sentences with the white space
behind them, a sentence of over ``MAX_WORDS`` words before every word whose hash
is the least of some ``WINDOW`` neighbouring words of the sentence. Such cuts
depend on the words around them only, so equal text gets equal cuts wherever it
starts, and no piece holds more than ``WINDOW`` words.
A run has at least ``RUN`` consecutive pieces and ``MIN_RUN_WORDS`` words. The
shortest run from every piece on and the shortest run up to every piece are
hashed (128 bits of the ASCII-lowered words) and joined globally; with both, a
repeated stretch of whole pieces of that size is covered from end to end.
The first occurrence (smallest ``doc_id``, then row, then place) of a repeated
run stays; pieces covered by any other occurrence are removed from the text.

Each text is cut once, into a stored table of its runs. Of all runs only the
first 64 bits of the hash are exchanged and counted; those found more than once
are kept as bits of a filter of fixed size (``FILTER_BITS``), and only runs that pass
it give rows with whole hashes and places. A run's first place is a minimum, so
occurrences of a hot run are never brought together: a text loses the passing
runs it holds, less those it holds first (a run that passed by chance is held first
by its only text). What a text loses is joined to it by row number, by broadcast
while all of it stays within ``BROADCAST_BYTES``, else by shuffle.

Defined results: null text stays null and has no pieces; empty or short texts
stay whole; repeated rows count as occurrences, the first row keeps its text;
rows with null ``doc_id`` come last; an empty table gives no rows; all input
columns are kept (``n_chars``, where present, follows the new text), but that
``n_sentences`` and ``n_removed`` replace columns of these names.
"""

from __future__ import annotations

import re
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.common import numbered, small_batches, small_side, stored, table

RUN = 3
MAX_WORDS = 12
WINDOW = 8
MIN_RUN_WORDS = 15
COMBINE = 100_000         # hashes counted in a task at once
FILTER_BITS = 1 << 26
ROWS = 256                # rows whose runs or texts a worker unfolds at once
# a sentence ends behind . ! ? and white space, or at a line end
_END = re.compile(rb"(?<=[.!?])[\x20\x09-\x0D]+|\n[\x20\x09-\x0D]*")
_WORD = re.compile(rb"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+[\x20\x09-\x0D]*")


def _cut(words: list[bytes], plain: list[bytes]) -> list[bytes]:
    """The words of a long sentence, joined to pieces; ``plain`` has them
    lowered and without white space."""
    h = [crc32(w) for w in plain]
    out, at, least = [], 0, -1
    for end in range(WINDOW, len(h) + 1):
        if least < end - WINDOW:        # left the window; of equal words the last
            part = h[end - WINDOW:end]
            part.reverse()
            least = end - 1 - part.index(min(part))
        elif h[end - 1] <= h[least]:
            least = end - 1
        if least > at:
            out.append(b"".join(words[at:least]))
            at = least
    out.append(b"".join(words[at:]))
    return out


def _pieces(text: bytes) -> list[bytes]:
    out, at = [], 0
    for m in _END.finditer(text):
        end = m.end()
        out.append(text[at:end])
        at = end
    out.append(text[at:])
    cut = []
    for s in out:
        if len(s) > 2 * MAX_WORDS and len(plain := s.lower().split()) > MAX_WORDS:
            cut += _cut(_WORD.findall(s), plain)
        elif s:
            cut.append(s)
    return cut


def pieces(text: str) -> list[str]:
    """Pieces whose concatenation is ``text``."""
    return [p.decode() for p in _pieces(text.encode())]


def runs(text: str):
    """``(place, last place, high, low)`` of every run, by place."""
    full = [(i, w) for i, p in enumerate(_pieces(text.encode().lower())) if (w := p.split())]
    words, total = [], [0]
    for _, w in full:
        words += w
        total.append(len(words))
    found, j = set(), 0
    for i in range(len(full)):          # shortest from piece i on
        while j < len(full) and (j - i < RUN or total[j] - total[i] < MIN_RUN_WORDS):
            j += 1
        if j - i < RUN or total[j] - total[i] < MIN_RUN_WORDS:
            break
        found.add((i, j))
    i = 0
    for j in range(1, len(full) + 1):   # shortest up to piece j
        while j - i > RUN and total[j] - total[i + 1] >= MIN_RUN_WORDS:
            i += 1
        if j - i >= RUN and total[j] - total[i] >= MIN_RUN_WORDS:
            found.add((i, j))
    for i, j in sorted(found):
        d = xxhash.xxh3_128_intdigest(b" ".join(words[total[i]:total[j]]))
        yield full[i][0], full[j - 1][0], (d >> 64) - (1 << 63), (d & (1 << 64) - 1) - (1 << 63)


def _run_rows(batches):
    """``doc, row, n`` (pieces), ``spans`` and ``hashes`` (high and low halves, by
    turns) of each document. A span is start << 20 | length: places of a text are
    far below 2^43."""
    for part in (b.slice(at, 32) for b in batches for at in range(0, b.num_rows, 32)):
        spans, hashes = [], []
        for text in part.column(2).to_pylist():
            found = list(runs(text or ""))
            spans.append(np.array([i << 20 | j - i for i, j, _, _ in found], np.int64).tobytes())
            hashes.append(np.array([x for _, _, hi, lo in found for x in (hi, lo)], np.int64).tobytes())
        yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(spans, pa.binary()), pa.array(hashes, pa.binary())],
                                         ["doc", "row", "spans", "hashes"])


def _counts(batches):
    """``h, n``: first halves of hashes, equal ones combined within
    ``COMBINE``."""
    def counted(held):
        h, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(h), pa.array(np.minimum(n, 2).astype(np.int8))], ["h", "n"])

    held, size = [], 0
    for batch in batches:
        for hashes in batch.column(0):
            held.append(np.frombuffer(hashes.as_buffer(), np.int64)[::2])
            size += len(held[-1])
            if size >= COMBINE:
                yield counted(held)
                held, size = [], 0
    if size:
        yield counted(held)


def repeated_filter(found: DataFrame) -> bytes:
    """Bits of the first halves that occur more than once."""
    twice = found.select("hashes").mapInArrow(_counts, "h long, n byte").groupBy("h").agg(F.sum("n").alias("n")).filter("n > 1")
    shift = 65 - FILTER_BITS.bit_length()
    at = twice.select(F.shiftrightunsigned("h", shift).alias("at"))
    longs = (at.groupBy(F.shiftright("at", 6).alias("k")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits"))
             .toArrow())
    out = np.zeros(FILTER_BITS // 64, "<i8")
    out[longs.column("k").to_numpy()] = longs.column("bits").to_numpy()
    return out.tobytes()


def _passing(batches, bits: np.ndarray):
    """``hi, lo, doc, row, span`` of the runs that pass the filter."""
    shift = np.uint64(65 - FILTER_BITS.bit_length())
    for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
        docs, rows = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        parts = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column(3)]
        which = np.repeat(np.arange(len(parts)), [len(p) // 2 for p in parts])
        both = np.concatenate([*parts, np.empty(0, np.int64)]).reshape(-1, 2)
        spans = np.concatenate([*[np.frombuffer(x.as_buffer(), np.int64) for x in batch.column(2)], np.empty(0, np.int64)])
        at = both[:, 0].astype(np.uint64) >> shift
        ok = (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (both[ok, 0], both[ok, 1], docs[which[ok]], rows[which[ok]], spans[ok])],
                                         ["hi", "lo", "doc", "row", "span"])


def _merged(batches):
    """Each row's spans, those that meet joined to one (of under 2^20 pieces)."""
    for batch in batches:
        out = []
        for spans in batch.column(1):
            x = np.sort(spans.values.to_numpy())
            start, end = x >> 20, (x >> 20) + (x & 0xFFFFF)
            reach = np.maximum.accumulate(end)
            at = np.flatnonzero(np.concatenate([[True], start[1:] > reach[:-1] + 1]))
            out.append([a << 20 | min(b, a + 0xFFFFE) - a for first, b in zip(start[at].tolist(), np.append(reach[at[1:] - 1], reach[-1]).tolist(), strict=True)
                        for a in range(first, b + 1, 0xFFFFF)])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.int64()))], ["row", "spans"])


def covered_spans(texts: DataFrame) -> DataFrame:
    """``row, spans`` of the rows of ``texts`` (``doc``, ``row``, ``text``) that
    lose something; stored."""
    with small_batches(texts.sparkSession):
        found = stored(texts.mapInArrow(_run_rows, "doc long, row long, spans binary, hashes binary"), "span-runs", "zstd")
    shared = texts.sparkSession.sparkContext.broadcast(repeated_filter(found))
    held = stored(found.mapInArrow(lambda batches: _passing(batches, np.frombuffer(shared.value, np.uint8)),
                                   "hi long, lo long, doc long, row long, span long"), "span-passing", "zstd")
    first = held.groupBy("hi", "lo").agg(F.min(F.struct("doc", "row", "span")).alias("at")).select("at.row", "at.span")
    # a span of a row is one run: it stays where it is that run's first place
    sides = held.select("row", "span", F.lit(False).alias("first")).unionByName(first.withColumn("first", F.lit(True)))
    lost = sides.groupBy("row", "span").agg(F.bool_or("first").alias("first")).filter("not first")
    lost = lost.groupBy("row").agg(F.collect_list("span").alias("spans"))
    return stored(lost.mapInArrow(_merged, "row long, spans array<long>"), "span-covered", "zstd")


_REWRITTEN = T.StructType([T.StructField("text", T.StringType()), T.StructField("n", T.LongType()), T.StructField("gone", T.LongType())])


def _without(text: pa.Array, spans: pa.Array) -> pa.Array:
    """The texts less their covered pieces, their pieces, and those covered."""
    done = []
    for at in range(0, max(1, len(text)), ROWS):
        out = []
        for t, lost in zip(text.slice(at, ROWS).to_pylist(), spans.slice(at, ROWS).to_pylist(), strict=True):
            if t is None:
                out.append((None, 0, 0))
                continue
            p, gone = _pieces(t.encode()), set()
            for s in lost or ():
                gone.update(range(s >> 20, (s >> 20) + (s & 0xFFFFF) + 1))
            out.append((b"".join(x for i, x in enumerate(p) if i not in gone).decode() if gone else t, len(p), len(gone)))
        cols = [pa.array([r[i] for r in out], kind) for i, kind in enumerate((text.type, pa.int64(), pa.int64()))]
        done.append(pa.StructArray.from_arrays(cols, ["text", "n", "gone"]))
    return pa.concat_arrays(done)


def dedup_spans(df: DataFrame, scan: bool = False) -> DataFrame:
    """The rows of ``df`` without covered pieces, plus ``n_sentences`` (pieces
    before) and ``n_removed`` (pieces removed). ``scan``: see ``numbered``."""
    rows, row = numbered(df, "span-docs", scan)
    lost = covered_spans(rows.select(F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("doc"),
                                     F.col(row).alias("row"), "text"))
    lost = small_side(lost, 32 + 8 * F.size("spans")).select(F.col("row").alias(row), F.col("spans").alias(row + "_spans"))
    out = rows.join(lost, row, "left").withColumn(row + "_x", F.arrow_udf(_without, _REWRITTEN)("text", row + "_spans"))
    new = {"n_sentences": F.col(f"{row}_x.n"), "n_removed": F.col(f"{row}_x.gone"), "text": F.col(f"{row}_x.text")}
    if "n_chars" in df.columns:
        new["n_chars"] = F.when(F.col(f"{row}_x.gone") > 0, F.length(f"{row}_x.text").cast("long")).otherwise(F.col("n_chars"))
    kept = [c for c in df.columns if c not in ("n_sentences", "n_removed")]
    return out.select(*[new[c].alias(c) if c in new else F.col(c) for c in kept], new["n_sentences"].alias("n_sentences"),
                      new["n_removed"].alias("n_removed"))


def op7_substring_dedup(spark, sf_dir) -> DataFrame:
    """Every document with its text after removal."""
    out = dedup_spans(table(spark, sf_dir, "documents"), scan=True)
    return out.select("doc_id", "text", "n_sentences", "n_removed")
