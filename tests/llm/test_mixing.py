import re
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from terrasift.llm import registry
from terrasift.llm.mixing import UNIT, exchange, flight, land, mix, repaired

SF = "/root/testdata/sf0.01"


def brute_targets(size_of):
    order = sorted((s for s in size_of if s is not None), key=lambda s: s.encode()) + ([None] if None in size_of else [])
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, open_, target = 1.5 * sum(size_of.values()), set(order), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        over = {s for s in open_ if w[s] * level > 2 * size_of[s]}
        if not over:
            return target | {s: w[s] * level for s in open_}
        for s in over:
            target[s] = 2.0 * size_of[s]
            left -= target[s]
        open_ -= over
    return target


def held(docs, rows, near=None):
    """docs: (id, text, source). near: how far a source's tokens may be from its target."""
    size, source = {}, {}
    for i, t, s in docs:
        size[i], source[i] = len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), s
    of = defaultdict(int)
    for i, s in source.items():
        of[s] += size[i]
    target, taken, most = brute_targets(of), defaultdict(int), defaultdict(int)
    assert len(rows) == len(docs)
    for r in rows:
        s = source[r.doc_id]
        assert r.size == size[r.doc_id] and r.source_size == of[s] and abs(r.target - target[s]) < 1e-6 * max(1, target[s])
        assert 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
        most[s] = max(most[s], r.size)
    for s in of:
        assert abs(taken[s] - target[s]) <= (most[s] if near is None else near(s, target[s])), (s, taken[s], target[s])


def test_query(spark):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = registry.QUERIES["op4_mixing"](spark, SF).collect()
    held(docs, rows, lambda s, t: max(1, 0.001 * t))
    assert sorted(rows) == sorted(registry.QUERIES["op4_mixing"](spark, SF).collect())


def test_blocks_nulls_and_ties(spark):
    rng = np.random.default_rng(1)
    docs = [(i, None if i % 50 == 0 else "w " * int(rng.integers(0, 60)), None if i % 4 == 0 else f"s{i % 3}", "clash") for i in range(600)]
    docs += [(600, "x " * 9000, "s1", ""), (601, None, "empty", ""), (602, "a b", "one", "")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, size string")
    rows = mix(df, block=16).collect()
    held([d[:3] for d in docs], rows)
    again = mix(df.orderBy(F.rand(3)).repartition(3), block=16).collect()
    assert sorted(rows) == sorted(again)
    twice = df.where("doc_id < 5").unionByName(df.where("doc_id < 5")).withColumn("doc_id", F.when(F.col("doc_id") > 2, F.col("doc_id")))
    assert mix(twice).count() == 10
    assert mix(df.limit(0)).collect() == []


def test_flight_keeps_totals():
    rng = np.random.default_rng(7)
    for n in (0, 1, 2, 3, 50, 1000):
        p, sizes = rng.random(n).tolist(), rng.integers(0, 5, n).tolist()
        q = flight(p, sizes, rng)
        assert abs(sum(p) - sum(q)) < 1e-6 and abs(np.dot(p, sizes) - np.dot(q, sizes)) < 1e-6
        assert sum(0 < x < 1 for x in q) <= 2
        assert set(land(q, sizes)) <= {0.0, 1.0}
    hits = sum(flight([0.3] * 9, list(range(9)), np.random.default_rng(s))[4] for s in range(2000)) / 2000
    assert abs(hits - 0.3) < 0.04  # inclusion probabilities are kept on average


def test_exchange_is_the_best_one():
    """Against all pairs of sizes; a size of 0 stands for none."""
    rng = np.random.default_rng(3)
    for _ in range(300):
        a, b = rng.integers(0, 60, rng.integers(0, 8)), rng.integers(0, 60, rng.integers(0, 8))
        over = int(rng.integers(-70, 70)) * UNIT + int(rng.integers(-UNIT // 2, UNIT // 2))
        left = {abs(over - (x - y) * UNIT) for x in [*a, 0] for y in [*b, 0]}
        got = exchange(a, b, over)
        assert min(left) >= abs(over) if got is None else abs(over - (got[0] - got[1]) * UNIT) == min(left) < abs(over)


def test_repair_flips_one_unit_of_each_size(spark):
    rows = [("s", i, z, p) for i, (z, p) in enumerate([(10, 1.0), (10, 1.0), (7, 0.0), (7, 0.0), (0, 0.0)])] + [(None, 9, 5, 0.0), ("t", 8, 4, 1.0)]
    units = spark.createDataFrame(rows, "source string, id long, size long, p double")
    wanted = spark.createDataFrame([("s", 17 * UNIT), (None, 4 * UNIT), ("t", 4 * UNIT)], "w_source string, wanted long")
    got = repaired(units, wanted).collect()
    assert sorted(r.size * r.p for r in got if r.source == "s") == [0.0, 0.0, 0.0, 7.0, 10.0] and len(got) == 7
    assert [r.p for r in got if r.source is None] == [1.0] and [r.p for r in got if r.source == "t"] == [1.0]
