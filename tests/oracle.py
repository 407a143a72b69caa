"""Run registered queries and their oracle SQL side by side."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _kind(type_text: str) -> str:
    text = type_text.upper()
    for name, marks in {
        "int": ("BIGINT", "INT", "LONG", "HUGEINT"),
        "double": ("DOUBLE", "FLOAT"),
        "time": ("TIMESTAMP",),
        "bool": ("BOOL",),
        "text": ("VARCHAR", "STRING"),
    }.items():
        if any(text.startswith(m) for m in marks):
            return name
    return text


def _cell(x):
    if x is None:
        return None
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 9)
    if hasattr(x, "isoformat"):
        return x.isoformat()
    return x


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_cell(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def differences(spark_df, con, sql: str) -> list[str]:
    """Empty when schema, row count and values agree."""
    result = con.execute(sql)
    duck_cols = [d[0] for d in result.description]
    duck_types = {d[0]: _kind(str(d[1])) for d in result.description}
    duck = _rows(duck_cols, result.fetchall())
    spark_types = {f.name: _kind(f.dataType.simpleString()) for f in spark_df.schema.fields}
    problems = []
    if duck_types != spark_types:
        diff = {k: (spark_types.get(k), duck_types.get(k)) for k in {*duck_types, *spark_types} if spark_types.get(k) != duck_types.get(k)}
        problems.append(f"schema (spark, oracle): {diff}")
    mine = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if len(mine) != len(duck):
        problems.append(f"rows: spark {len(mine)}, oracle {len(duck)}")
    elif mine != duck:
        bad = [(a, b) for a, b in zip(mine, duck) if a != b]
        problems.append(f"{len(bad)} of {len(mine)} rows differ, e.g. {bad[0]} (columns {sorted(duck_cols)})")
    if not duck:
        problems.append("oracle returned no rows")
    return problems
