"""Runs registered queries and their DuckDB SQL on the same tables and compares rows.

    python tests/oracle_check.py [sf dir] [query ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def oracle_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(row[i] for i in order) for row in result.fetchall()]
    return sorted(names), sorted(rows, key=repr)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    rows = [tuple(row) for row in df.select(*names).collect()]
    return names, sorted(rows, key=repr)


if __name__ == "__main__":
    from wirestar.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(contract.queries())
    spark, con = local_session(8), connect(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    for name in wanted:
        begin = time.time()
        try:
            got = spark_rows(contract.queries()[name](spark, sf_dir))
            took = time.time() - begin
            want = oracle_rows(con, contract.oracle_sql()[name])
            same = got == want
            print(f"{'ok  ' if same else 'DIFF'} {name}: {len(got[1])} rows, {took:.2f} s", flush=True)
            if not same:
                print("  ", got[0], want[0], len(got[1]), len(want[1]))
                odd = [(g, w) for g, w in zip(got[1], want[1]) if g != w][:3]
                for g, w in odd:
                    print("    spark ", g)
                    print("    duckdb", w)
        except Exception as error:
            print(f"FAIL {name}: {str(error)[:1500]}", flush=True)
