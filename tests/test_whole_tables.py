import re

import duckdb

from terrasift.plans import load
from terrasift.plans.registry import QUERIES

load()
SF = "/root/testdata/sf0.001"


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_fuzzy_words_all(spark):
    con = duckdb.connect()
    words = lambda t: {w for (x,) in con.execute(f"SELECT text FROM '{SF}/{t}.parquet' WHERE text IS NOT NULL").fetchall() for w in re.split("[ \t\n\x0b\f\r]+", x.lower()) if len(w) >= 6}
    a, b = words("conversations"), words("benchmark")
    got = {(r.word, r.ref): r.edits for r in QUERIES["fuzzy_words_all"](spark, SF).collect()}
    sample = set(sorted(a - b)[::20])
    want = {(w, v): d for w in sample for v in b if abs(len(w) - len(v)) <= 2 and (d := edits(w, v)) <= 2}
    assert want and {k: d for k, d in got.items() if k[0] in sample} == want
    assert all(w in a - b and v in b for w, v in got)


def test_status_rank_sort_all(spark):
    rows = [tuple(r) for r in QUERIES["status_rank_sort_all"](spark, SF).select("rank", "o_orderkey").collect()]
    assert rows == sorted(rows) and len(rows) == spark.read.parquet(f"{SF}/orders.parquet").count()
