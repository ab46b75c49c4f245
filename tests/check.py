"""Compare each query with its SQL: ``python tests/check.py [sf_dir] [query ...]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__  # noqa: E402

QUERIES, ORACLES = __spark_entry__.queries(), __spark_entry__.oracle_sql()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def _rows(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        (tuple(_cell(r[i]) for i in order) for r in rows),
        key=lambda r: tuple((v is not None, str(type(v)), v) if v is not None else (False, "", 0) for v in r),
    )


def compare(spark, con, sf_dir, name):
    """Spark result against SQL result; returns the row count."""
    df = QUERIES[name](spark, sf_dir)
    got = _rows([tuple(r) for r in df.collect()], df.columns)
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    want = _rows(cursor.fetchall(), columns)
    assert sorted(df.columns) == sorted(columns), (df.columns, columns)
    assert len(got) == len(want), (name, len(got), len(want))
    for g, w in zip(got, want):
        assert g == w, (name, g, w)
    return len(got)


def main():
    from cellmeter.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(ORACLES)
    spark = local_session(
        8, **{"spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-", dir="/tmp")}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            n = compare(spark, con, sf_dir, name)
            print(f"ok   {name:24s} {n:8d} rows {time.time() - start:6.1f} s", flush=True)
        except Exception as error:  # noqa: BLE001
            failed += 1
            print(f"FAIL {name:24s} {str(error)[:600]}", flush=True)
    sys.exit(bool(failed))


if __name__ == "__main__":
    main()
