"""Compare queries with their oracle: ``python tests/oracle.py [--sf 0.01] [name ...]``."""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=lambda r: tuple((v is None, str(type(v)), v) if v is not None else (True, "", 0) for v in r))


def compare(spark, con, name: str, sf_dir: str) -> str | None:
    """None when results agree exactly, else what differs."""
    from __spark_entry__ import oracle_sql, queries

    df = queries()[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "NestedLoopJoin"):
        if bad in plan:
            return f"the plan holds a {bad}"
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    sql = oracle_sql().get(name)
    if sql is None:
        return None if got else "no rows"
    cur = con.execute(sql)
    want_cols, want = rows_of([c[0] for c in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} against {want_cols}"
    if not want:
        return "oracle has no rows"
    if len(got) != len(want):
        extra = list(set(got) - set(want))[:2], list(set(want) - set(got))[:2]
        return f"rows {len(got)} against {len(want)}: {extra}"
    if got != want:
        bad = [(g, w) for g, w in zip(got, want) if g != w]
        return f"{len(bad)} of {len(got)} rows differ {got_cols}, first {bad[0]}"
    return None


def main() -> None:
    from martkit.session import local_session
    from martkit.plans.queries import REGISTRY

    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--sf", default="0.01")
    args = parser.parse_args()
    sf_dir = f"/root/testdata/sf{args.sf}"
    spark, con = local_session(), duck(sf_dir)
    failed = 0
    for name in args.names or REGISTRY:
        start = time.time()
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
