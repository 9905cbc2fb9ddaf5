"""Values of column expressions, and comparison of queries with their SQL."""

import os

import duckdb
from pyspark.sql import functions as F

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def value(spark, expression, **columns):
    """What `expression`, a function of columns, gives for one row of texts."""
    row = spark.range(1).select(*[F.lit(v).cast("string").alias(k) for k, v in columns.items()])
    return row.select(expression(*[F.col(k) for k in columns]).alias("v")).first()["v"]


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if hasattr(v, "tolist"):
        v = v.tolist()
    return f"{v:.9g}" if isinstance(v, float) else repr(v)


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in found)


def same_rows(spark, query, sql, sf_dir):
    df = query(spark, sf_dir)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = connect(sf_dir).execute(sql)
    want = rows([c[0] for c in cursor.description], cursor.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]


SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
