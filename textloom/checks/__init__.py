"""Registered queries (Spark) and their oracles (DuckDB SQL) by area."""

from textloom.checks import cleaning, evaluation, profiling, splitting, training

QUERIES: dict = {}
ORACLES: dict = {}
for _m in (cleaning, profiling, splitting, evaluation, training):
    QUERIES.update(_m.QUERIES)
    ORACLES.update(_m.ORACLES)
