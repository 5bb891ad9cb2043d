"""Compare registered queries with their SQL on DuckDB: ``python tests/oracle.py [folder] [names...]``."""

from __future__ import annotations

import os
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def expected(con, sql: str) -> tuple[list[str], Counter, list]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = [str(d[1]) for d in result.description]
    at = sorted(range(len(names)), key=names.__getitem__)
    rows = Counter(tuple(r[i] for i in at) for r in result.fetchall())
    return [names[i] for i in at], rows, [types[i] for i in at]


def actual(df) -> tuple[list[str], Counter, list]:
    names = sorted(df.columns)
    types = dict(df.dtypes)
    return names, Counter(tuple(r) for r in df.select(*names).collect()), [types[n] for n in names]


if __name__ == "__main__":
    import __spark_entry__ as entry_module

    from tallybrook.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = build_session(
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": os.environ.get("PARTS", "8"),
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.sql.session.timeZone": os.environ.get("ZONE", "UTC"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = database(folder)
    oracles = entry_module.oracle_sql()
    for name, run in entry_module.queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            names, rows, types = actual(run(spark, folder))
        except Exception as e:  # report and go on with the next query
            print(f"{name:32s} FAILED {type(e).__name__}: {str(e)[:600]}", flush=True)
            continue
        took = time.time() - start
        if name not in oracles:
            print(f"{name:32s} rows only: {rows.total()} {took:.1f}s", flush=True)
            continue
        want_names, want, want_types = expected(con, oracles[name])
        verdict = "ok" if names == want_names and rows == want else "DIFFERENT"
        print(f"{name:32s} {verdict} {rows.total()}/{want.total()} {took:.1f}s {list(zip(names, types, want_types))}", flush=True)
        if verdict != "ok":
            print("  only here:", list((rows - want).items())[:3], "\n  only SQL: ", list((want - rows).items())[:3])
