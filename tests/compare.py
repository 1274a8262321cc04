"""Run registered queries against DuckDB on the same Parquet files."""

from __future__ import annotations

import math
import sys
import time

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def oracle(sf: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def _norm(v):
    import datetime
    import decimal

    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf, name, fn, sql):
    """None if equal, else a short description of the difference."""
    df = fn(spark, sf)
    mine = canonical(df.columns, df.collect())
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    theirs = canonical(cols, cur.fetchall())
    if sorted(df.columns) != sorted(cols):
        return f"columns {sorted(df.columns)} != {sorted(cols)}"
    if mine != theirs:
        left, right = set(mine), set(theirs)
        a, b = [r for r in mine if r not in right][:3], [r for r in theirs if r not in left][:3]
        return f"{len(mine)} vs {len(theirs)} rows; only spark {a}; only sql {b}"
    types = [type(v) for r in mine[:1] for v in r], [type(v) for r in theirs[:1] for v in r]
    if types[0] != types[1] and None.__class__ not in types[0] + types[1]:
        return f"types {types}"
    return None if mine else "EMPTY"


def main(sf: str, only: list[str]) -> None:
    from pyspark.sql import SparkSession

    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    import __spark_entry__ as e

    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    con = oracle(sf)
    queries, sqls = e.queries(), e.oracle_sql()
    bad = 0
    for name, fn in queries.items():
        if only and not any(o in name for o in only):
            continue
        t0 = time.time()
        try:
            if name in sqls:
                diff = compare(spark, con, sf, name, fn, sqls[name])
            else:
                diff = None if fn(spark, sf).count() else "EMPTY"
        except Exception as ex:  # report and go on
            diff = f"{type(ex).__name__}: {str(ex)[:600]}"
        bad += diff is not None
        print(f"{'ok  ' if diff is None else 'FAIL'} {name:<40} {time.time() - t0:6.2f}s {'' if name in sqls else '(rows only)'} {diff or ''}",
              flush=True)
    print(f"{bad} differ")


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001", sys.argv[2:])
