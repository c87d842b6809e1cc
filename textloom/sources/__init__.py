"""Scans, sinks and report writers; report writers live in
``textloom.sources.reports``."""

from textloom.sources.corpus import normalize_na, preview, read_corpus, write_corpus

__all__ = ["read_corpus", "normalize_na", "write_corpus", "preview"]
