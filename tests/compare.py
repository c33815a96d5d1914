"""Run a named query and its SQL counterpart on the same tables and compare them as bags."""

from collections import Counter
import glob
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def spark_bag(df):
    columns = sorted(df.columns)
    return columns, Counter(tuple(r) for r in df.select(*columns).collect())


def sql_bag(con, sql):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(row[i] for i in order) for row in result.fetchall())
