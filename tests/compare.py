"""Run registered queries beside their SQL twins and compare whole results.

    python -m tests.compare [sf_dir] [query ...]
"""

import math
import sys
import time
from pathlib import Path

import duckdb

import __spark_entry__ as entry
from machpulse.session import build_session


def normal(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, float):
        return f"{value + 0.0:.6f}" if value else "0.000000"
    return str(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(normal(r[i]) for i in order) for r in rows)


def sql_tables(sf_dir):
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(spark, con, sf_dir, name):
    """(equal, message, seconds of Spark, seconds of SQL)"""
    began = time.time()
    df = entry.queries()[name](spark, sf_dir)
    got = canonical(df.columns, df.collect())
    spent = time.time() - began
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return True, f"{len(got[1])} rows, no SQL", spent, 0.0
    began = time.time()
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    want = canonical(columns, result.fetchall())
    sql_spent = time.time() - began
    if got[0] != want[0]:
        return False, f"columns {got[0]} != {want[0]}", spent, sql_spent
    if got[1] != want[1]:
        extra = sorted(set(got[1]) - set(want[1]))[:3]
        lacking = sorted(set(want[1]) - set(got[1]))[:3]
        return False, f"{len(got[1])} rows vs {len(want[1])}; only Spark {extra}; only SQL {lacking}", spent, sql_spent
    return True, f"{len(got[1])} rows", spent, sql_spent


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(entry.queries())
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = sql_tables(sf_dir)
    failed = 0
    for name in names:
        try:
            equal, message, spent, sql_spent = compare(spark, con, sf_dir, name)
        except Exception as error:  # report and go on with the other queries
            equal, message, spent, sql_spent = False, f"{type(error).__name__}: {str(error)[:600]}", 0.0, 0.0
        failed += not equal
        print(f"{'ok  ' if equal else 'FAIL'} {name:26s} {spent:6.2f}s sql {sql_spent:5.2f}s  {message}", flush=True)
    print(f"{len(names) - failed} of {len(names)} equal")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
