"""Run one catalogue query on Spark and its reference SQL on DuckDB, and compare names, types and rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()

KINDS = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float) and not isinstance(value, bool):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return value


def differences(df, con, sql: str) -> list[str]:
    """Empty when both sides agree."""
    names = sorted(df.columns)
    cursor = con.execute(sql)
    described = {d[0]: str(d[1]) for d in cursor.description}
    if sorted(described) != names:
        return [f"columns {names} vs {sorted(described)}"]
    out = []
    for field in df.schema.fields:
        want, have = KINDS.get(field.dataType.simpleString()), described[field.name]
        if have not in (want, "NULL", '"NULL"'):
            out.append(f"type {field.name}: {want} vs {have}")
    order = [list(described).index(n) for n in names]
    theirs = Counter(tuple(_cell(row[i]) for i in order) for row in cursor.fetchall())
    ours = Counter(tuple(_cell(v) for v in row) for row in df.select(*names).collect())
    if ours != theirs:
        only_ours = list((ours - theirs).elements())
        only_theirs = list((theirs - ours).elements())
        out.append(f"rows {sum(ours.values())} vs {sum(theirs.values())}, {len(only_ours)} differ")
        key = lambda r: tuple(map(str, r))
        out += [f"  ours   {dict(zip(names, r))}" for r in sorted(only_ours, key=key)[:2]]
        out += [f"  theirs {dict(zip(names, r))}" for r in sorted(only_theirs, key=key)[:2]]
    return out
