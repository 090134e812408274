"""Run queries in Spark and DuckDB over the same tables and compare the rows."""

import glob
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(str(row[i]) for i in order) for row in rows])


def spark_rows(df):
    return sorted(df.columns), _rows(df.columns, df.collect())


def duck_rows(con, sql):
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return sorted(columns), _rows(columns, result.fetchall())
