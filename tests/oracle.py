"""A query's rows in Spark and its SQL's in DuckDB."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def views(sf_dir):
    c = duckdb.connect()
    c.sql("SET timezone = 'UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return c


def rows(found, columns):
    value = lambda v: round(v, 6) if isinstance(v, float) else v
    return sorted(([value(v) for v in r] for r in found), key=lambda r: [(v is None, str(v)) for v in r]), columns


def compare(spark, query, sql, sf_dir):
    df = query(spark, sf_dir)
    columns = sorted(df.columns)
    got = rows([tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()], columns)
    r = views(sf_dir).sql(sql)
    wanted = sorted(r.columns)
    want = rows(r.select(*[f'"{c}"' for c in wanted]).fetchall(), wanted)
    assert got[1] == want[1]
    assert len(got[0]) == len(want[0])
    assert got[0] == want[0]
