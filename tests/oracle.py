"""Compare registered queries with their SQL oracles on DuckDB."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def compare(spark, con, name: str, sf_dir: str, query, sql: str) -> str | None:
    """None when both sides agree, else what differs."""
    df = query(spark, sf_dir)
    left_columns = df.columns
    left = normal([tuple(r) for r in df.collect()], left_columns)
    result = con.execute(sql)
    right_columns = [d[0] for d in result.description]
    right = normal(result.fetchall(), right_columns)
    if sorted(left_columns) != sorted(right_columns):
        return f"columns {sorted(left_columns)} != {sorted(right_columns)}"
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)} rows"
    for a, b in zip(left, right):
        if a != b:
            return f"{a} != {b}"
    return None


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from rivulet.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = build_session("oracle", master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    oracles = oracle_sql()
    bad = 0
    for name, query in queries().items():
        if name not in oracles or (only and name not in only):
            continue
        start = time.time()
        try:
            problem = compare(spark, con, name, sf, query, oracles[name])
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print("failed:", bad)
