"""DataFrame -> DataFrame operators, one module per area."""

from textloom.operators import clean, encode, history, labels, metrics, profile, split

__all__ = ["clean", "encode", "history", "labels", "metrics", "profile", "split"]
