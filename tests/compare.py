"""Run registered queries next to their SQL in DuckDB and compare rows, columns and values."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
          " conversations").split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def rows_of(frame) -> list[tuple]:
    cols = sorted(frame.columns)
    data = frame[cols].astype(object).where(frame[cols].notna(), None)
    return sorted((tuple(r) for r in data.itertuples(index=False)), key=lambda r: tuple(map(repr, r)))


def differences(got, want) -> str | None:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} / {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}"
    a, b = rows_of(got), rows_of(want)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ, first: {str(bad[0])[:600]}"
    kinds = [(c, got[c].dtype.kind, want[c].dtype.kind) for c in got.columns if got[c].dtype != want[c].dtype
             and not (got[c].dtype.kind in "OTS" and want[c].dtype.kind in "OTS")]
    return f"types {kinds} {got.dtypes.to_dict()} {want.dtypes.to_dict()}" if kinds else None


def check(spark, con, folder: str, name: str, fn, sql: str | None) -> str:
    start = time.time()
    got = fn(spark, folder).toPandas()
    took = time.time() - start
    if sql is None:
        return f"rows  {name:24s} {len(got):7d} rows {took:6.1f}s"
    start = time.time()
    problem = differences(got, con.execute(sql).df())
    other = time.time() - start
    state = "FAIL " if problem else "ok   "
    return f"{state} {name:24s} {len(got):7d} rows {took:6.1f}s duck {other:5.1f}s {problem or ''}"


if __name__ == "__main__":
    from quillspark.session import local_session

    import __spark_entry__ as e

    folder = sys.argv[1]
    wanted = sys.argv[2:]
    spark, con = local_session(), duck(folder)
    sqls = e.oracle_sql()
    for name, fn in e.queries().items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        try:
            print(check(spark, con, folder, name, fn, sqls.get(name)), flush=True)
        except Exception as err:  # report and go on
            print(f"ERROR {name} {str(err)[:1500]}", flush=True)
