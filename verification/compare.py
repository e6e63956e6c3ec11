"""Run a registered query and its oracle side by side on one data folder."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, Decimal):
        return ("decimal", value)
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def _rows(names, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark: SparkSession, con, query, sql: str, sf_dir: str) -> tuple[bool, str]:
    """Whether names and the bag of rows agree exactly; a short account otherwise."""
    df = query(spark, sf_dir)
    got_names, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want_names, want = _rows([d[0] for d in cur.description], cur.fetchall())
    if got_names != want_names:
        return False, f"columns {got_names} against {want_names}"
    if got != want:
        missing, extra = list((want - got).elements()), list((got - want).elements())
        show = lambda rows: sorted(rows, key=repr)[:3]
        return False, (f"{sum(got.values())} rows against {sum(want.values())}; missing {len(missing)} "
                       f"{show(missing)}; extra {len(extra)} {show(extra)}")
    return True, f"{sum(got.values())} rows"
