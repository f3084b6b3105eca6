"""Run registered queries against their SQL checks: python tests/compare.py [folder] [name ...]"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(folder: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def differences(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """None if both hold the same rows in any order."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} / {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}"
    columns = sorted(got.columns)

    def keyed(frame):
        text = frame[columns].map(lambda v: "" if v is None or v != v else repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v))
        return text.sort_values(columns).reset_index(drop=True)

    a, b = keyed(got), keyed(want)
    if a.equals(b):
        return None
    wrong = (a != b).any(axis=1)
    return f"{int(wrong.sum())} of {len(a)} rows differ, first:\n{a[wrong].head(3).to_string()}\n{b[wrong].head(3).to_string()}"


def main() -> None:
    import __spark_entry__ as entry
    from tastegraph.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8, **{"spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    checks, registry = entry.oracle_sql(), entry.queries()
    names = sys.argv[2:] or list(registry)
    missing = set(checks) - set(registry)
    if missing:
        print("SQL without query:", sorted(missing))
    connection, failed = duck(folder), 0
    for name in names:
        start = time.time()
        try:
            got = registry[name](spark, folder).toPandas()
            took = time.time() - start
            if name in checks:
                want = connection.execute(checks[name]).df()
                problem = differences(got, want)
                status = "ok" if problem is None else "FAIL " + problem
            else:
                status = "rows only"
        except Exception as error:  # noqa: BLE001
            took, got, status = time.time() - start, [], f"ERROR {type(error).__name__}: {str(error)[:600]}"
        failed += status.startswith(("FAIL", "ERROR"))
        print(f"{name:32s} {took:6.1f}s {len(got):8d} {status}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
