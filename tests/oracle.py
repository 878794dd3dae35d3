"""Compare a query with its SQL check run by DuckDB on the same parquet tables."""

import math
import os
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(float(f"{v:.10g}") + 0.0)
    if hasattr(v, "isoformat"):
        return v.replace(tzinfo=None).isoformat()
    return repr(v)


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
         "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP"}


def difference(df, con, sql):
    """None if equal, else a description."""
    rel = con.sql(sql)
    theirs = dict(zip(rel.columns, map(str, rel.types)))
    ours = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    if ours != theirs:
        return f"schema {sorted(set(ours.items()) ^ set(theirs.items()))}"
    names = sorted(ours)
    a = Counter(tuple(_cell(r[c]) for c in names) for r in df.collect())
    at = [rel.columns.index(c) for c in names]
    b = Counter(tuple(_cell(r[i]) for i in at) for r in rel.fetchall())
    if a == b:
        return None
    only_a, only_b = a - b, b - a
    return (f"rows {sum(a.values())} / {sum(b.values())}, {sum(only_a.values())} differ; {names}: "
            f"{sorted(only_a)[:2]} / {sorted(only_b)[:2]}")
