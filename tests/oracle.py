"""Compare named queries with their SQL in DuckDB.

    python tests/oracle.py [--dir /root/testdata/sf0.01] [name ...]
"""

from __future__ import annotations

import argparse
import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import oracle_sql, queries  # noqa: E402


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(normal(v) for v in value)
    return value


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(
        (tuple(normal(r[i]) for i in order) for r in rows), key=repr
    )


def kinds(rows):
    """Python types seen per column."""
    return [{type(v).__name__ for v in col if v is not None} for col in zip(*rows)]


def difference(spark, con, name: str, folder: str) -> str | None:
    """None if both engines agree, else what differs."""
    df = queries()[name](spark, folder)
    got = table(df.columns, [tuple(r) for r in df.collect()])
    sql = oracle_sql().get(name)
    if sql is None:
        return None if got[1] else "no rows"
    cur = con.execute(sql)
    want = table([d[0] for d in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}"
    if not got[1]:
        return "no rows"
    if kinds(got[1]) != kinds(want[1]):
        return f"types {list(zip(got[0], kinds(got[1]), kinds(want[1])))}"
    wrong = [(g, w) for g, w in zip(got[1], want[1]) if g != w]
    return f"{len(wrong)} of {len(got[1])} rows differ, first {wrong[0]}" if wrong else None


def main() -> int:
    from vejrkraft.session import build_session

    args = argparse.ArgumentParser()
    args.add_argument("--dir", default="/root/testdata/sf0.01")
    args.add_argument("names", nargs="*")
    args = args.parse_args()
    spark = build_session(
        "oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(args.dir)
    bad = 0
    for name in args.names or queries():
        begin = time.time()
        try:
            said = difference(spark, con, name, args.dir)
        except Exception as e:  # noqa: BLE001  report and go on
            said = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += said is not None
        print(f"{'ok  ' if said is None else 'BAD '} {name} {time.time() - begin:.2f}s {said or ''}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
