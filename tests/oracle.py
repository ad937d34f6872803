"""Compares registered queries with their SQL: ``python tests/oracle.py sf_dir [name ...]``."""

import math
import os
import sys

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows_of(columns, rows):
    """Rows with columns in name order, numbers made alike, sorted."""
    order = sorted(range(len(columns)), key=lambda k: columns[k])

    def plain(x):
        if isinstance(x, float):
            return None if math.isnan(x) else round(x, 6) + 0.0
        return float(x) if isinstance(x, int) and not isinstance(x, bool) else str(x) if x is not None and not isinstance(x, (bool, str)) else x

    return [columns[k] for k in order], sorted((tuple(plain(r[k]) for k in order) for r in rows), key=str)


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    return con


def difference(spark, con, sf_dir, query, sql):
    """None if both give the same rows, else what differs."""
    df = query(spark, sf_dir)
    a = rows_of(df.columns, [tuple(r) for r in df.collect()])
    found = con.execute(sql)
    b = rows_of([d[0] for d in found.description], found.fetchall())
    if a == b:
        return None
    extra = [x for x in a[1] if x not in set(b[1])][:3] if a[0] == b[0] else []
    lacking = [x for x in b[1] if x not in set(a[1])][:3] if a[0] == b[0] else []
    return f"columns {a[0]} and {b[0]}; {len(a[1])} and {len(b[1])} rows; only Spark: {extra}; only SQL: {lacking}"


if __name__ == "__main__":
    import time

    from pyspark.sql import SparkSession

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry

    spark = SparkSession.builder.master(os.environ.get("ORACLE_MASTER", "local[4]")).config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "6g").getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    con, sql = connect(sys.argv[1]), entry.oracle_sql()
    for name, query in entry.queries().items():
        if name in sql and (len(sys.argv) < 3 or name in sys.argv[2:]):
            began = time.time()
            try:
                result = difference(spark, con, sys.argv[1], query, sql[name])
            except Exception as error:
                result = f"{type(error).__name__}: {str(error)[:600]}"
            print(f"{name}: {result or 'same'} ({time.time() - began:.1f} s)", flush=True)
