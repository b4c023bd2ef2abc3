import random

from pyspark.sql import functions as F

from terrasift.operators import spatial as S
from terrasift.operators.components import components
from terrasift.operators.rows import numbered


def in_order(pairs):
    by, used, want = {}, set(), {}
    for a, b, d, dx, dy in pairs:
        by.setdefault(a, []).append((d, dx, dy, b))
    for i in sorted(by):
        free = sorted(x for x in by[i] if x[3] not in used)
        if free:
            want[i] = free[0][3]
            used.add(free[0][3])
    return want


def test_rounds_run_out(spark):
    """40 rows of a at one place, and others around whose matches depend on them; fewer rounds than they need."""
    rng = random.Random(3)
    rows = [(a, b, float(b), 0, 0) for a in range(0, 80, 2) for b in range(50)]
    rows += [(a, b, rng.uniform(0, 60), 0, 0) for a in range(1, 80, 2) for b in rng.sample(range(40, 120), 6)]
    pairs = spark.createDataFrame(rows, "a_id long, b_id long, d double, dx int, dy int")
    for rounds in (0, 1, 3):
        got = S.greedy_match(pairs, rounds).collect()
        assert {r.a_id: r.b_id for r in got} == in_order(rows) and len({r.b_id for r in got}) == len(got)


def test_large_components_go_in_blocks(spark):
    """Components beyond the limit are served block by block, with the same matches; no round before."""
    rng = random.Random(5)
    rows = [(a, b, rng.choice([1.0, 2.0, rng.uniform(0, 9)]), 0, 0) for a in range(120) for b in rng.sample(range(150), 9)]
    pairs = spark.createDataFrame(rows, "a_id long, b_id long, d double, dx int, dy int")
    for rounds, limit, block in ((0, 1, 50), (2, 100, 45)):
        got = S.greedy_match(pairs, rounds, limit, block).collect()
        assert {r.a_id: r.b_id for r in got} == in_order(rows) and len({r.b_id for r in got}) == len(got)


def test_one_place_is_settled_in_a_round(spark):
    """300 rows of a and of b at one place: the k-th takes the k-th, without a round for each."""
    a = spark.range(300).select("id")
    pairs = a.select(F.col("id").alias("a_id")).join(a.select(F.col("id").alias("b_id")), F.lit(True)).select("a_id", "b_id", F.lit(1.0).alias("d"), F.lit(0).alias("dx"), F.lit(0).alias("dy"))
    got = S.greedy_match(pairs, most_rounds=2, most_pairs=0, block=1).collect()
    assert {r.a_id: r.b_id for r in got} == {k: k for k in range(300)}


def test_a_long_chain(spark):
    """Each row wants what the one before it gets: 100,000 links, which rounds would take one by one."""
    n = 100_000
    i = spark.range(n).select(F.col("id").alias("a_id"))
    pairs = i.select("a_id", F.greatest(F.col("a_id") - 1, F.lit(0)).alias("b_id"), F.lit(1.0).alias("d")).unionByName(i.select("a_id", F.col("a_id").alias("b_id"), F.lit(2.0).alias("d"))).withColumn("dx", F.lit(0)).withColumn("dy", F.lit(0))
    got = S.greedy_match(pairs, most_rounds=2)
    assert got.where("a_id = b_id").count() == n == got.count()


def test_components(spark):
    """Paths, stars and loops in any order of ids, against a search."""
    rng = random.Random(1)
    names = list(range(3000))
    rng.shuffle(names)
    edges = [(names[k], names[k + 1]) for k in range(900)] + [(names[1000], names[k]) for k in range(1001, 1500)] + [(names[2000], names[2000])] + [(names[rng.randrange(2100, 3000)], names[rng.randrange(2100, 3000)]) for _ in range(500)]
    got = {r.node: r.component for r in components(spark.createDataFrame([*edges, (None, 1)], "u long, v long")).collect()}
    near = {}
    for u, v in edges:
        near.setdefault(u, set()).add(v)
        near.setdefault(v, set()).add(u)
    want = {}
    for s in sorted(near):
        todo = [s] if s not in want else []
        while todo:
            x = todo.pop()
            if x not in want:
                want[x] = s
                todo += near[x]
    assert got == want


def test_numbered_with_a_hot_key(spark):
    rng = random.Random(2)
    rows = [(None if k % 9 == 0 else "hot" if k % 3 else f"k{k % 5}", rng.randrange(10**9)) for k in range(2000)]
    got = numbered(spark.createDataFrame(rows, "k string, v long"), ["k"], [F.col("v")]).collect()
    by = {}
    for r in got:
        by.setdefault(r.k, []).append((r.place, r.v))
    assert sum(map(len, by.values())) == 2000
    for k, found in by.items():
        assert [v for _, v in sorted(found)] == sorted(v for x, v in rows if x == k) and sorted(p for p, _ in found) == list(range(len(found)))
