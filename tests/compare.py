"""Runs registered queries against DuckDB: ``python tests/compare.py FOLDER [names...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _norm(value):
    if isinstance(value, float):
        return 0.0 if value == 0 else value
    return value


def difference(spark_df, con, sql: str) -> str | None:
    """None when both sides agree, else a short description."""
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    expected = cur.fetchall()
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(set(names) ^ set(spark_df.columns))}"
    order = sorted(names)
    at = [names.index(c) for c in order]
    want = [tuple(_norm(r[i]) for i in at) for r in expected]
    got = [tuple(_norm(r[c]) for c in order) for r in spark_df.collect()]
    if len(want) != len(got):
        return f"rows spark={len(got)} duckdb={len(want)}"
    key = lambda r: tuple((v is None, str(type(v)) if v is None else "", str(v)) for v in r)
    want.sort(key=key)
    got.sort(key=key)
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        g, w = bad[0]
        diff = [(c, a, b) for c, a, b in zip(order, g, w) if a != b]
        return f"{len(bad)} of {len(got)} rows differ, e.g. {diff[:4]} in {g[:4]}"
    kinds = [(c, type(a).__name__, type(b).__name__) for g, w in zip(got[:50], want[:50])
             for c, a, b in zip(order, g, w) if a is not None and b is not None and type(a) is not type(b)]
    return f"types {sorted(set(kinds))}" if kinds else None


def main() -> int:
    import __spark_entry__ as entry
    from trolley.session import build_session

    folder, names = sys.argv[1], sys.argv[2:]
    spark = build_session("compare", "local[8]", 8, {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    queries, sqls = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            if name in sqls:
                problem = difference(df, con, sqls[name])
            else:
                n = df.count()
                problem = None if n else "no rows"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:1200]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main())
