"""Run a registered query and its SQL on the same files and compare rows."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
DATA = os.environ.get("OPSLAKE_TESTDATA", "/root/testdata")


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shown = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(shown, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def compare(spark, con, key, build, sql, sf_dir):
    """None when equal, else a description of the difference."""
    df = build(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    want = rows_of(columns, cursor.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} / {sorted(columns)}"
    if len(got) != len(want):
        mine, theirs = set(got), set(want)
        return (f"{len(got)} rows / {len(want)} expected; only here {[r for r in mine if r not in theirs][:2]}; "
                f"only there {[r for r in theirs if r not in mine][:2]}")[:1500]
    if not got:
        return "no rows"
    off = [(g, w) for g, w in zip(got, want) if g != w]
    if off:
        mine, theirs = set(got), set(want)
        return (f"{len(off)} of {len(got)} rows differ; here {[r for r in got if r not in theirs][:2]} "
                f"there {[r for r in want if r not in mine][:2]}")[:1500]
    return None
