"""Run queries beside their SQL and compare: python tests/check_queries.py [sf] [names..]."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb
import pandas as pd

import __spark_entry__ as entry
from loanlark.plans.standins import TABLES
from loanlark.session import build_session


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def normal(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]

    def cell(v):
        if v is None or (not isinstance(v, (list, tuple)) and pd.isna(v)):
            return "null"
        if isinstance(v, float):
            return repr(v)
        return str(v)

    return sorted(tuple(cell(v) for v in row) for row in df.itertuples(index=False))


def compare(got: pd.DataFrame, want: pd.DataFrame) -> str:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns: only spark {sorted(set(got) - set(want))}, only sql {sorted(set(want) - set(got))}"
    for c in got.columns:
        kinds = {got[c].dtype.kind, want[c].dtype.kind}
        if len(kinds) > 1:
            return f"type of {c}: {got[c].dtype} / {want[c].dtype}"
    a, b = normal(got), normal(want)
    if a == b:
        return ""
    if len(a) != len(b):
        return f"rows: {len(a)} / {len(b)}"
    cols = sorted(got.columns)
    for x, y in zip(a, b):
        if x != y:
            return "first difference: " + str([(c, p, q) for c, p, q in zip(cols, x, y) if p != q][:6])
    return "?"


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    sf_dir = f"/root/testdata/{sf}"
    spark = build_session("check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            got = entry.queries()[name](spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            failed += 1
            print(f"ERROR {name}: {str(e)[:1500]}", flush=True)
            continue
        took = time.time() - start
        sql = entry.oracle_sql().get(name)
        if sql is None:
            print(f"rows  {name}: {len(got)} rows, {took:.1f}s", flush=True)
            continue
        try:
            said = compare(got, con.sql(sql).df())
        except Exception as e:  # noqa: BLE001
            said = f"SQL error {str(e)[:800]}"
        failed += bool(said)
        print(f"{'FAIL ' if said else 'ok   '} {name}: {len(got)} rows, {took:.1f}s {said}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
