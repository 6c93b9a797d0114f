"""Runs a registered query in Spark and its oracle in DuckDB and compares the rows."""

from decimal import Decimal
from pathlib import Path

import duckdb


def duck(folder):
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


INTS = {"TINYINT", "SMALLINT", "INTEGER", "BIGINT", "HUGEINT"}


def kind_of_spark(kind):
    return {"tinyint": "int", "smallint": "int", "int": "int", "bigint": "int", "double": "double",
            "string": "text", "boolean": "bool"}.get(kind, kind)


def kind_of_duck(kind):
    kind = str(kind)
    if kind in INTS:
        return "int"
    return {"DOUBLE": "double", "VARCHAR": "text", "BOOLEAN": "bool"}.get(kind, kind)


def _key(row):
    return tuple((v is None, str(type(v).__name__), str(v)) for v in row)


def differences(df, sql, con, limit=3):
    """Empty when schema and values agree exactly; otherwise a description."""
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    types = {d[0]: kind_of_duck(d[1]) for d in result.description}
    rows = result.fetchall()
    spark_types = {n: kind_of_spark(k) for n, k in df.dtypes}
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    wrong = {n: (spark_types[n], types[n]) for n in columns if spark_types[n] != types[n]}
    if wrong:
        return f"types {wrong}"
    order = sorted(columns)
    got = sorted(([r[c] for c in order] for r in df.collect()), key=_key)
    where = [columns.index(c) for c in order]
    want = sorted(([r[i] for i in where] for r in rows), key=_key)
    assert not any(isinstance(v, Decimal) for r in got + want for v in r)
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        cells = [[(c, a, b) for c, a, b in zip(order, g, w) if a != b] for g, w in bad[:limit]]
        return f"{len(bad)} of {len(got)} rows differ: {cells}"
    return ""
