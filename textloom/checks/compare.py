"""Spark-vs-DuckDB comparison used by the oracle script and the tests."""

from __future__ import annotations

import math
import os

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT", "date": "DATE",
                 "timestamp": "TIMESTAMP WITH TIME ZONE", "timestamp_ntz": "TIMESTAMP"}


def duck_type(spark_type: str) -> str:
    if spark_type.startswith("array<") and spark_type.endswith(">"):
        return duck_type(spark_type[6:-1]) + "[]"
    return SPARK_TO_DUCK.get(spark_type, spark_type)


def duck_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)


def compare(sdf, con, sql: str) -> list[str]:
    """Problems found between a Spark DataFrame and a DuckDB query."""
    scols, stypes = sdf.columns, dict(sdf.dtypes)
    srows = [tuple(r) for r in sdf.collect()]
    res = con.sql(sql)
    dcols, dtypes = res.columns, dict(zip(res.columns, [str(t) for t in res.types]))
    drows = res.fetchall()
    problems = []
    if sorted(scols) != sorted(dcols):
        problems.append(f"columns spark={sorted(scols)} duck={sorted(dcols)}")
    tdiff = {c: (stypes[c], dtypes[c]) for c in scols if c in dtypes and duck_type(stypes[c]) != dtypes[c]}
    if tdiff:
        problems.append(f"types {tdiff}")
    if len(srows) != len(drows):
        problems.append(f"rows spark={len(srows)} duck={len(drows)}")
    if not problems:
        a, b = _rows(scols, srows), _rows(dcols, drows)
        if a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            problems.append(f"values differ, e.g. {diff}")
    return problems
