"""Corpus cleaning jobs."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import first_label, first_label_ascii
from textloom.operators.clean import (
    cleaning_classes, cleaning_stats, counts_from_summary, drop_null_rows,
    filter_rare_classes, label_summary,
)
from textloom.session import cut_lineage
from textloom.sources.corpus import LABEL, TEXT, normalize_na, read_corpus, write_corpus
from textloom.sources.reports import write_stats_report


class Cleaned(NamedTuple):
    corpus: DataFrame    # kept rows, label replaced by its first label
    counts: DataFrame    # label, n  (after null removal)
    stats: DataFrame     # one row, A18
    classes: DataFrame   # section, rank, label, n, status (A19)


def _finish(prepared: DataFrame, min_samples: int, materialize: bool) -> Cleaned:
    summary = label_summary(prepared)
    if materialize:
        # One small row per class; cut lineage so the corpus scan behind it
        # runs once and survives executor loss.
        summary = cut_lineage(summary)
    counts = counts_from_summary(summary)
    corpus = filter_rare_classes(drop_null_rows(prepared), min_samples, counts)
    return Cleaned(corpus, counts, cleaning_stats(summary, min_samples),
                   cleaning_classes(counts, min_samples))


def clean_corpus(df: DataFrame, min_samples: int = 100, null_label: str = "drop",
                 materialize: bool = True) -> Cleaned:
    """M1: first label -> drop nulls -> drop rare classes, plus audit tables.

    ``null_label='literal_nan'`` keeps a null label as the class ``nan``
    (the single-script behaviour); the default drops it.
    """
    prepared = df.withColumn(LABEL, first_label(F.col(LABEL), null_label))
    return _finish(prepared, min_samples, materialize)


def clean_corpus_two_stage(df: DataFrame, min_samples: int = 100,
                           materialize: bool = True, intermediate_path: str | None = None) -> Cleaned:
    """M2: ASCII-comma first label with null as ``nan``; the CSV round trip
    between the two old jobs turns null words back into nulls (S2).

    With ``intermediate_path`` the stage-1 result is really written as CSV
    there and read back by stage 2 (two jobs, as in the old flow);
    otherwise the round trip is applied as the equivalent null mapping.
    """
    stage1 = df.withColumn(LABEL, first_label_ascii(F.col(LABEL), "literal_nan"))
    if intermediate_path is not None:
        write_corpus(stage1, intermediate_path, "csv")
        stage1 = read_corpus(df.sparkSession, intermediate_path, "csv", row_id_col="row_id")
        stage1 = stage1.withColumn("row_id", F.col("row_id").cast("bigint"))
    return _finish(normalize_na(stage1, (TEXT, LABEL)), min_samples, materialize)


def process_dataset(spark, input_path: str, output_path: str, min_samples: int = 100,
                    fmt: str = "csv", out_fmt: str = "csv", text_col: str = TEXT,
                    label_col: str = LABEL, row_id_col: str | None = None, null_label: str = "drop",
                    null_words: bool = True, multiline: bool = True) -> Cleaned:
    """M1 end to end: read the corpus, turn null words into nulls (S2, as the
    reference's scan does), clean it, write the cleaned corpus to
    ``output_path`` and the audit report to ``output_path + '_stats'``."""
    raw = read_corpus(spark, input_path, fmt, text_col, label_col, row_id_col, multiline)
    if null_words:
        raw = normalize_na(raw)
    res = clean_corpus(raw, min_samples, null_label)
    write_corpus(res.corpus, output_path, out_fmt)
    write_stats_report(res.stats, res.classes, output_path.rstrip("/") + "_stats")
    return res
