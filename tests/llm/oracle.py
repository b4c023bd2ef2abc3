"""Compare a registered query with its SQL in DuckDB on the smallest tables."""

import os

import duckdb

SF = "/root/testdata/sf0.001"


def frames(spark, query, sql, sf=SF, tables=None):
    con = duckdb.connect()
    for f in os.listdir(sf):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{sf}/{f}'")
    want = con.execute(sql).df()
    got = query(spark, sf).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)
    key = lambda df: sorted(map(tuple, df[cols].astype(object).where(df[cols].notna(), None).values.tolist()), key=repr)
    return key(got), key(want)
