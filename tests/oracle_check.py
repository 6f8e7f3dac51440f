"""Runs registered queries against DuckDB and prints one line per query.

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def duck(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _cell(v):
    if isinstance(v, decimal.Decimal):
        return ("decimal", str(v))
    if isinstance(v, float):
        return ("float", "nan" if math.isnan(v) else v)
    return (type(v).__name__, v)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, name, run, sql, sf_dir):
    """None when equal, else what differs."""
    df = run(spark, sf_dir)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    expected = _rows(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if got != expected:
        extra, missing = got - expected, expected - got
        return (
            f"rows {sum(got.values())} vs {sum(expected.values())}; "
            f"only Spark {sum(extra.values())}: {list(extra)[:2]}; "
            f"only DuckDB {sum(missing.values())}: {list(missing)[:2]}"
        )
    if not got:
        return "empty result"
    return None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from tapeflow.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = local_session(8), duck(sf_dir)
    sqls, failed = oracle_sql(), 0
    for name, run in queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, name, run, sqls[name], sf_dir)
        except Exception as e:  # reported, and the check goes on
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        print(f"{name:28s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
