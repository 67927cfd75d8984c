"""Compare a query's result with its checking SQL, as multisets of rows."""

from __future__ import annotations

import math
import os
from collections import Counter

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return v


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> tuple[int, int, list, list, list[str]]:
    """(rows of df, rows of sql, some rows only in df, some only in sql, column or type differences)"""
    mine = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    theirs = cur.fetchall()
    notes = [] if sorted(names) == sorted(df.columns) else [f"columns {sorted(df.columns)} != {sorted(names)}"]
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}
    types = {c[0]: str(c[1]) for c in cur.description}
    for name, typ in df.dtypes:
        if name in types and kinds.get(typ, typ) != types[name]:
            notes.append(f"{name}: {typ} != {types[name]}")
    a, b = _rows(df.columns, mine), _rows(names, theirs)
    return len(mine), len(theirs), list((a - b).items())[:4], list((b - a).items())[:4], notes
