"""A training-data pipeline of five of the operators.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``. All but the last
return the columns of their input. As ``docs`` is a plain scan, its rows have
places in their files: stages pass on what goes, by row, and copy no texts. Stages read nothing else but ``benchmark``
and ``labels``.
"""

from __future__ import annotations

from textloom.llm.common import stored, table
from textloom.llm.decontam import drop_contaminated
from textloom.llm.mixing import mix
from textloom.llm.quality import keep_quality
from textloom.llm.simhash import keep_first
from textloom.llm.spans import dedup_spans


def quality_rules(spark, docs, sf_dir):
    """Documents that pass the base rules and are no outliers of their group."""
    return keep_quality(docs, scan=True)


def simhash_dedup(spark, docs, sf_dir):
    """One document (the smallest id) of each near-duplicate group."""
    return keep_first(docs, shingle=3, max_bits=2, scan=True)


def substring_dedup(spark, docs, sf_dir):
    """All documents, without sentences of non-first repeated spans."""
    return dedup_spans(docs, scan=True).select(*docs.columns)


def decontaminate(spark, docs, sf_dir):
    """Documents that hold no benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"), scan=True)


def mix_sources(spark, docs, sf_dir):
    """All documents with domain posteriors and the rate to sample them at."""
    return mix(docs, table(spark, sf_dir, "labels"))


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_dedup", simhash_dedup),
    ("substring_dedup", substring_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
]

# Robust covariance, fingerprints, retrieval and a trained classifier: not SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
