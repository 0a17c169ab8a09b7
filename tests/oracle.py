"""Compares a query's rows with those of its SQL, regardless of order."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(folder: str):
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return db


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (float, decimal.Decimal)):
        value = float(value)
        return "NaN" if math.isnan(value) else round(value, 6)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def _family(name: str) -> str:
    name = name.lower()
    for family, kinds in {
        "int": ("tinyint", "smallint", "int", "integer", "bigint"),
        "text": ("string", "varchar"),
        "timestamp": ("timestamp_ntz", "timestamp"),
    }.items():
        if name in kinds:
            return family
    return "decimal" if name.startswith("decimal") else name


def differences(query, sql: str, spark, db, folder: str) -> str | None:
    """None when schema and rows agree, else what differs."""
    frame = query(spark, folder)
    names = sorted(frame.columns)
    result = db.sql(sql)
    if sorted(result.columns) != names:
        return f"columns {names} against {sorted(result.columns)}"
    kinds = {f.name: _family(f.dataType.simpleString()) for f in frame.schema}
    others = {name: _family(str(kind)) for name, kind in zip(result.columns, result.types)}
    if kinds != others:
        return f"types {[(n, kinds[n], others[n]) for n in names if kinds[n] != others[n]]}"
    mine = Counter(tuple(plain(v) for v in row) for row in frame.select(*[f"`{n}`" for n in names]).collect())
    places = [result.columns.index(n) for n in names]
    theirs = Counter(tuple(plain(row[i]) for i in places) for row in result.fetchall())
    if not mine:
        return "no rows"
    if mine != theirs:
        return (f"{sum(mine.values())} rows against {sum(theirs.values())}; only here "
                f"{list((mine - theirs).items())[:3]}; only in SQL {list((theirs - mine).items())[:3]}")
    return None
