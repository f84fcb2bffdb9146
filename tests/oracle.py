"""Spark rows against DuckDB rows of the same query."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def value(v):
    if isinstance(v, float):
        return round(v, 6)
    return list(v) if isinstance(v, (list, tuple)) else v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(str([value(r[i]) for i in order]) for r in data)


def same(spark_df, con, sql):
    got = spark_df.collect()
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    assert sorted(spark_df.columns) == sorted(names)
    assert rows(spark_df.columns, got) == rows(names, cur.fetchall())
