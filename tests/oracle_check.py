"""Run registered queries beside their DuckDB text and compare the rows."""

from __future__ import annotations

import math
import pathlib
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if v is None or v is pd.NaT or v is pd.NA:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if hasattr(v, "item"):
        return _cell(v.item())
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime()
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_cell(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=repr)


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want_cols, want = rows_of([c[0] for c in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}; first {got[:1]} / {want[:1]}"
    for a, b in zip(got, want):
        if a != b:
            return f"{[(c, x, y) for c, x, y in zip(got_cols, a, b) if x != y]}"
        odd = [(c, type(x), type(y)) for c, x, y in zip(got_cols, a, b) if x is not None and type(x) is not type(y)]
        if odd:
            return f"types {odd}"
    return None


def main(sf_dir: str, names: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from riskengine.session import local_session

    spark, con = local_session(8), connect(sf_dir)
    sqls, bad = oracle_sql(), 0
    for name, run in queries().items():
        if names and not any(n in name for n in names):
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if name in sqls:
                diff = compare(df, con, sqls[name])
            else:
                diff = None if (n := len(df.collect())) else f"{n} rows"
        except Exception as e:  # report and go on with the next query
            causes = [line for line in str(e).splitlines() if line.startswith("Caused by") or "- object" in line or "- field" in line]
            diff = f"{type(e).__name__}: {str(e)[:300]} ... {causes[:12]}"
        bad += diff is not None
        print(f"{'ok  ' if diff is None else 'BAD '} {name} {'' if name in sqls else '(rows only) '}{time.time() - start:.1f}s {diff or ''}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
