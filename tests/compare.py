"""Order-insensitive comparison of a Spark result with DuckDB's."""

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()

KINDS = {"STRING": "VARCHAR", "INT": "INTEGER", "LONG": "BIGINT"}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, decimal.Decimal):
        return str(value.normalize())
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return value if value is None else str(value)


def canonical_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql: str) -> list[str]:
    """Differences in columns, types, row count and values; empty when equal."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    expected = canonical_rows(names, cursor.fetchall())
    got = canonical_rows(df.columns, [tuple(r) for r in df.collect()])
    problems = []
    if sorted(names) != sorted(df.columns):
        problems.append(f"columns differ: {sorted(set(names) ^ set(df.columns))}")
    own = {f.name: f.dataType.simpleString().upper().replace("BIGINT", "LONG") for f in df.schema.fields}
    for name, kind in kinds.items():
        if name in own and KINDS.get(own[name], own[name]) != kind:
            problems.append(f"type of {name}: {own[name]} / {kind}")
    if len(expected) != len(got):
        problems.append(f"rows: {len(got)} / {len(expected)}")
    if not problems and expected != got:
        ordered = sorted(names)
        diff = [(g, e) for g, e in zip(got, expected) if g != e]
        g, e = diff[0]
        problems.append(f"{len(diff)} rows differ, first in {[(n, a, b) for n, a, b in zip(ordered, g, e) if a != b][:6]}")
    return problems
