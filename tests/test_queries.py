"""Every registered query against its SQL in DuckDB."""

import os

import duckdb
import pytest

from terrasift.plans import load
from terrasift.plans.registry import ORACLE, QUERIES

load()
SF = os.environ.get("TEST_SF", "/root/testdata/sf0.001")


def canonical(rows):
    def cell(v):
        return None if v is None or v != v else round(float(v), 9) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    return sorted((tuple(map(cell, r)) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = canonical(df.select(*(f"`{c}`" for c in cols)).collect())
    if name in ORACLE:
        cur = con.execute(ORACLE[name])
        names = [d[0] for d in cur.description]
        assert sorted(names) == cols
        at = [names.index(c) for c in cols]
        assert got == canonical([[r[i] for i in at] for r in cur.fetchall()])
