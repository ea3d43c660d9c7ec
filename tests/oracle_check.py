"""Run registered queries against their SQL twins: python tests/oracle_check.py [sf_dir] [key ...]."""

from __future__ import annotations

import os
import sys
import time
import traceback
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _rows(columns, tuples):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(t[i] for i in order) for t in tuples)


def compare(df, con, sql: str) -> str | None:
    """None when equal, else a short description of the difference."""
    result = con.execute(sql)
    expected_columns = [d[0] for d in result.description]
    expected_types = {d[0]: str(d[1]) for d in result.description}
    columns, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    names, want = _rows(expected_columns, result.fetchall())
    if columns != names:
        return f"columns {columns} vs {names}"
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    odd = [f"{n}: {t} vs {expected_types[n]}" for n, t in df.dtypes if kinds.get(t) != expected_types[n]]
    if got != want:
        return f"{sum(got.values())} vs {sum(want.values())} rows; only here {list((got - want))[:2]}; only there {list((want - got))[:2]}"
    return f"types {odd}" if odd else None


def main() -> int:
    from conftest import session
    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con, failed = session(), connect(sf_dir), 0
    oracle = entry.oracle_sql()
    for key, fn in entry.queries().items():
        if len(sys.argv) > 2 and key not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            problem = compare(fn(spark, sf_dir), con, oracle[key]) if key in oracle else "no SQL twin"
        except Exception as error:
            problem = "".join(traceback.format_exception_only(error))[:1500]
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {key} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed; without query: {sorted(set(oracle) - set(entry.queries()))}")
    return failed


if __name__ == "__main__":
    sys.exit(main())
