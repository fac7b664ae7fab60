"""Run queries and their SQL twins side by side.

``python -m tests.oracle [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime
import math
import sys
import tempfile
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from catalog.base import TABLES  # noqa: E402


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def _canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql: str) -> str:
    """Empty if both give the same rows, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = _canon(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    got = _canon(df.columns, [tuple(r) for r in df.collect()])
    if len(got) != len(expected):
        return f"rows {len(got)} != {len(expected)}"
    for g, e in zip(got, expected):
        if g != e or [type(x) for x in g] != [type(x) for x in e]:
            return f"first difference\n   spark  {g}\n   sql    {e}"
    return ""


def session(name: str = "strata-check", cpus: str = "8"):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName(name)
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g")
        .config("spark.sql.adaptive.enabled", "true").config("spark.checkpoint.dir", f"file://{tempfile.mkdtemp(prefix='strata-')}")
        # Recording the call site of every expression doubles the time to build a plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(argv: list[str]) -> int:
    import __spark_entry__ as contract

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    queries, sqls = contract.queries(), contract.oracle_sql()
    spark, con, bad = session(), database(folder), 0
    for name in argv[1:] or queries:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            problem = compare(df, con, sqls[name]) if name in sqls else ("" if df.count() else "no rows")
        except Exception as e:  # noqa: BLE001 - reported per query
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {'' if name in sqls else '(rows only)'} {problem}", flush=True)
    print(f"{len(queries)} registered, {len(sqls)} with SQL, {bad} failing")
    return bool(bad)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
