"""Run registered queries next to their SQL and compare schema, row count and values."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def cell(value) -> str:
    if value is None or (not isinstance(value, (list, dict)) and pd.isna(value)):
        return "NULL"
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, pd.Timestamp):
        return value.isoformat()
    return str(value)


def canonical(rows, columns) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def differences(spark, con, name, run, sql, folder) -> list[str]:
    """Empty when both sides agree."""
    df = run(spark, folder)
    left_columns = df.columns
    left = canonical([tuple(r) for r in df.collect()], left_columns)
    con.execute(sql)
    right_columns = [d[0] for d in con.description]
    right = canonical(con.fetchall(), right_columns)
    found = []
    if sorted(left_columns) != sorted(right_columns):
        found.append(f"columns {sorted(set(left_columns) ^ set(right_columns))}")
        return found
    if len(left) != len(right):
        found.append(f"rows {len(left)} != {len(right)}")
    if left != right:
        a, b = set(left), set(right)
        found.append(f"values: {len(a - b)} only here, {len(b - a)} only in SQL; e.g. {sorted(a - b)[:2]} / {sorted(b - a)[:2]}")
    return found


def main() -> int:
    import __spark_entry__ as contract
    from tidemark.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session("compare", "local[8]", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    oracles, bad = contract.oracle_sql(), 0
    for name, run in contract.queries().items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        started = time.time()
        try:
            if name in oracles:
                found = differences(spark, con, name, run, oracles[name], folder)
            else:
                found = [] if run(spark, folder).count() > 0 else ["no rows"]
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:700]}"]
        bad += bool(found)
        print(f"{'ok  ' if not found else 'FAIL'} {time.time() - started:6.2f}s {name} {'; '.join(found)}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
