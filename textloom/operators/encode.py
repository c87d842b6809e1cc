"""Vocabulary and fixed-length encoding.

The vocabulary's size is a parameter, so it is small enough to be shared.
Tokens are looked up in place: each Arrow batch of token arrays is probed against
a hash table of the shared vocabulary, and ids are turned back by reading an
id-ordered token array. Rows stay where they are; nothing is exploded or regrouped.
A batch is worked on ``PIECE`` entries at a time and let go before the next one
is read, so a Python worker's memory does not follow the table or its texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.functions.text import basic_tokens
from textloom.session import cut_lineage, local_table
from textloom.sources.corpus import ROW_ID, TEXT

# ---------------------------------------------------------------------------
# Fixed values (special tokens of the reference's tokenizer configuration)
# ---------------------------------------------------------------------------
PAD_ID, UNK_ID, CLS_ID, SEP_ID, MASK_ID = 0, 100, 101, 102, 103
SPECIAL_TOKENS = (("[PAD]", PAD_ID), ("[UNK]", UNK_ID), ("[CLS]", CLS_ID), ("[SEP]", SEP_ID), ("[MASK]", MASK_ID))
MAX_LENGTH = 128
VOCAB_SIZE = 21128
# ---------------------------------------------------------------------------

TOKEN = "token"
ID = "id"
PIECE = 1 << 18           # entries looked up at once


def _rank_to_id(r: Column) -> Column:
    """Ranks 1.. fill the free ids: 1..99, then 104.. (100-103 are special)."""
    return F.when(r < F.lit(UNK_ID), r).otherwise(r + F.lit(MASK_ID - UNK_ID + 1)).cast("int")


def special_tokens(spark: SparkSession) -> DataFrame:
    return local_table(spark, SPECIAL_TOKENS, f"{TOKEN} STRING, {ID} INT")


def build_vocab(df: DataFrame, size: int = VOCAB_SIZE, tokens_col: str | None = None,
                text_col: str = TEXT, materialize: bool = True) -> DataFrame:
    """The ``size`` most frequent tokens (count desc, token asc) with
    ids around the special tokens, plus the special tokens themselves.

    Counting is a partial + final aggregate over exploded tokens; the
    top-``size`` is a TakeOrderedAndProject, and the rank window runs over
    those ``size`` rows only. With ``materialize`` the (size-bounded) result
    is checkpointed, so size checks and broadcasts do not re-tokenise.
    """
    toks = F.col(tokens_col) if tokens_col else basic_tokens(F.col(text_col))
    counts = (df.select(F.explode(toks).alias(TOKEN))
              .groupBy(TOKEN).agg(F.count(F.lit(1)).alias("n")))
    order = [F.desc("n"), F.col(TOKEN)]
    top = counts.orderBy(*order).limit(size)
    ranked = top.select(TOKEN, _rank_to_id(F.row_number().over(Window.orderBy(*order))).alias(ID))
    vocab = ranked.unionByName(special_tokens(df.sparkSession))
    return cut_lineage(vocab) if materialize else vocab


def _looked_up(lists: pa.ListArray, look, kind: pa.DataType) -> pa.ListArray:
    """Lists of the same lengths with ``look`` of their entries, a piece at a time."""
    flat, lengths = lists.flatten(), lists.value_lengths().to_numpy()
    pieces = [look(flat.slice(a, PIECE)) for a in range(0, len(flat), PIECE)]
    ends = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), pa.concat_arrays(pieces) if pieces else pa.array([], kind))


def lookup_ids(tokens: Column, vocab: DataFrame) -> Column:
    """Token array -> id array in place; unknown -> [UNK], null -> empty."""
    table = vocab.select(TOKEN, F.col(ID).cast("int")).toArrow()
    shared = vocab.sparkSession.sparkContext.broadcast(
        (table.column(0).combine_chunks(), table.column(1).combine_chunks()))

    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known, ids = shared.value

        def look(flat):
            return pc.fill_null(ids.take(pc.index_in(flat, value_set=known)), UNK_ID)
        # map holds no batch while the next is read
        yield from map(lambda lists: _looked_up(lists, look, pa.int32()), batches)
    return F.arrow_udf(find, "array<int>")(F.coalesce(tokens, F.array().cast("array<string>")))


def ids_by_vocab(df: DataFrame, vocab: DataFrame, tokens, max_tokens: int | None = None,
                 keep=(ROW_ID,), out_col: str = "ids") -> DataFrame:
    """Token array -> id array in position order; unknown -> [UNK]."""
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    if max_tokens is not None:
        t = F.slice(t, 1, max_tokens)
    return df.select(*keep, lookup_ids(t, vocab).alias(out_col))


def with_special_and_padding(ids, max_length: int = MAX_LENGTH) -> tuple[Column, Column]:
    """[CLS] + ids + [SEP], padded with [PAD] to ``max_length``; and the mask."""
    i = F.col(ids) if isinstance(ids, str) else ids
    pad = F.lit(max_length) - F.size(i) - F.lit(2)
    input_ids = F.concat(F.array(F.lit(CLS_ID)), i, F.array(F.lit(SEP_ID)), F.array_repeat(F.lit(PAD_ID), pad))
    mask = F.concat(F.array_repeat(F.lit(1), F.size(i) + F.lit(2)), F.array_repeat(F.lit(0), pad))
    return input_ids, mask


def encode_fixed_length(df: DataFrame, vocab: DataFrame, max_length: int = MAX_LENGTH,
                        text_col: str = TEXT, keep=(ROW_ID,)) -> DataFrame:
    """M4: ``input_ids`` and ``attention_mask`` of exactly ``max_length``;
    only the first ``max_length - 2`` tokens are looked up."""
    toks = basic_tokens(F.col(text_col))
    ids = ids_by_vocab(df, vocab, toks, max_tokens=max_length - 2, keep=keep)
    input_ids, mask = with_special_and_padding("ids", max_length)
    return ids.select(*keep, input_ids.alias("input_ids"), mask.alias("attention_mask"))


def lookup_tokens(ids: Column, vocab: DataFrame) -> Column:
    """Id array -> token array in place, read from one array that holds each
    token at its id; unknown -> [UNK], null -> empty."""
    rows = vocab.select(ID, TOKEN).collect()
    names: list = [None] * (max((r[ID] for r in rows), default=-1) + 1)
    for r in rows:
        names[r[ID]] = r[TOKEN] if names[r[ID]] is None else min(names[r[ID]], r[TOKEN])
    shared = vocab.sparkSession.sparkContext.broadcast(pa.array(names, pa.string()))

    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        held = shared.value

        def look(flat):
            inside = pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(held)))
            return pc.fill_null(held.take(pc.if_else(inside, flat, None)), "[UNK]")
        yield from map(lambda lists: _looked_up(lists, look, pa.string()), batches)
    return F.arrow_udf(find, "array<string>")(F.coalesce(ids.cast("array<int>"), F.array().cast("array<int>")))


def decode_ids(df: DataFrame, vocab: DataFrame, ids_col: str = "input_ids",
               keep=(ROW_ID,), out_col: str = "tokens") -> DataFrame:
    """M5: id array -> token strings (unknown ids -> [UNK])."""
    return df.select(*keep, lookup_tokens(F.col(ids_col), vocab).alias(out_col))
