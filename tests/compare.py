"""Run a named query in Spark and its SQL in DuckDB and compare columns, types and values."""

from __future__ import annotations

import glob
import math
import os

import duckdb

TYPES = {
    "bigint": {"BIGINT"},
    "int": {"INTEGER"},
    "double": {"DOUBLE"},
    "string": {"VARCHAR"},
    "boolean": {"BOOLEAN"},
}


def duck(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return float(f"{v:.9g}") + 0.0
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(cell(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(df, con, sql) -> list[str]:
    """Differences as text; empty when both sides agree."""
    problems = []
    spark_types = dict(df.dtypes)
    cur = con.execute(sql)
    duck_types = {d[0]: str(d[1]).upper() for d in cur.description}
    expected = cur.fetchall()
    if set(spark_types) != set(duck_types):
        return [f"columns {sorted(spark_types)} vs {sorted(duck_types)}"]
    for name, t in spark_types.items():
        if duck_types[name] not in TYPES.get(t, {t}) and duck_types[name] not in ("NUMBER", "STRING", "BOOL"):
            problems.append(f"type of {name}: {t} vs {duck_types[name]}")
    got = rows_of(df.columns, df.collect())
    want = rows_of([d[0] for d in cur.description], expected)
    if len(got) != len(want):
        problems.append(f"rows {len(got)} vs {len(want)}")
    if got != want:
        both = set(got) & set(want)
        a = [r for r in got if r not in both][:3]
        b = [r for r in want if r not in both][:3]
        problems.append(f"columns {sorted(df.columns)}\n    spark {a}\n    duck  {b}")
    return problems
