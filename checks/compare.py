"""Runs every query beside its SQL and compares them: python -m checks.compare [sf_dir] [name...]"""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks.queries import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value: object) -> object:
    return round(value, 6) if isinstance(value, float) and not math.isnan(value) else value


def rows_of(names: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    values = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(values, key=repr)


def compare(spark: SparkSession, con, sf_dir: str, name: str) -> str:
    df = QUERIES[name](spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLES:
        return f"rows only ({len(got[1])})"
    relation = con.sql(ORACLES[name])
    want = rows_of(relation.columns, relation.fetchall())
    if got == want:
        return f"equal ({len(want[1])})"
    if got[0] != want[0]:
        return f"COLUMNS DIFFER {got[0]} {want[0]}"
    extra = [r for r in got[1] if r not in set(want[1])][:2]
    missing = [r for r in want[1] if r not in set(got[1])][:2]
    return f"ROWS DIFFER {len(got[1])} {len(want[1])}\n  spark only: {str(extra)[:700]}\n  sql only:   {str(missing)[:700]}"


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in names or QUERIES:
        start = time.time()
        try:
            verdict = compare(spark, con, sf_dir, name)
        except Exception as error:  # a failing query must not hide the others
            verdict = f"FAILED {type(error).__name__}: {str(error)[:1500]}"
        bad += verdict.split()[0] not in ("equal", "rows")
        print(f"{name:32s} {time.time() - start:6.1f}s  {verdict}", flush=True)
    return bad


if __name__ == "__main__":
    raise SystemExit(main(*sys.argv[1:]))
