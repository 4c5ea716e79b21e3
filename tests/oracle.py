"""Runs registered queries next to their SQL and compares the rows."""

from __future__ import annotations

import datetime
import decimal
import glob
import os
import sys
import time
from collections import Counter

import duckdb


def connect(sf_dir: str):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(df, connection, sql):
    """(rows, problem): problem is None where both sides agree."""
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    got = df.collect()
    if sorted(names) != sorted(df.columns):
        return len(got), f"columns {sorted(df.columns)} != {sorted(names)}"
    left, right = bag(df.columns, got), bag(names, expected)
    if left != right:
        extra, missing = list((left - right).items())[:3], list((right - left).items())[:3]
        return len(got), f"{len(got)} rows vs {len(expected)}; extra {extra}; missing {missing}"
    return len(got), None


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from stratalake.session import build_session

    folder = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
    spark = build_session("oracle", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g", "spark.sql.warehouse.dir": "/tmp/stratalake-warehouse",
    })
    spark.sparkContext.setLogLevel("OFF")
    database = connect(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    chosen = [q for q in queries if not sys.argv[1:] or any(a in q for a in sys.argv[1:])]
    bad = 0
    for name in chosen:
        started = time.time()
        try:
            df = queries[name](spark, folder)
            if name in oracles:
                count, problem = compare(df, database, oracles[name])
            else:
                count, problem = len(df.collect()), None
        except Exception as error:  # report and go on with the next query
            count, problem = -1, str(error)[:700]
        bad += problem is not None
        verdict = "ok" if problem is None else f"BAD {problem[:900]}"
        print(f"{name:28s} {count:8d} {time.time() - started:6.2f}s {verdict}", flush=True)
    print(f"{len(chosen)} queries, {bad} bad")
