import random

from oracle import frames

from terrasift.llm import registry
from terrasift.llm.near_dedup import MOST, PLACES, components, distance, index_keys, near_duplicates, packed


def brute(rows, shingle, percent):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))} if w else set())
    comp = list(range(len(rows)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both) and root(i) != root(j):
                comp[root(i)] = root(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(rows[i][0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in groups.items()}
    return [(rows[i][0], len(sets[i]), least[root(i)], rows[i][0] == least[root(i)]) for i in range(len(rows))]


def texts():
    rng = random.Random(3)
    base = [[f"w{rng.randrange(5000)}" for _ in range(rng.choice((30, 80, 300)))] for _ in range(12)]
    rows = [(i, " ".join(b)) for i, b in enumerate(base)]
    for i in range(12, 150):  # copies with some words changed, some of copies
        w = rng.choice(rows)[1].split()
        for _ in range(rng.choice((0, 1, 1, 2, 3))):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    rows += [(200, None), (201, ""), (202, " \n"), (203, "A b"), (204, "a  B"), (205, "a b c"), (None, "a b"), (None, "lonely words here now"), (3, rows[3][1]), (7, "é É x"), (206, "long " * 30000), (207, "long " * 20000)]
    rng.shuffle(rows)
    return rows


def test_brute_force(spark):
    rows = texts()
    df = spark.createDataFrame([(*r, "clash", b"x") for r in rows], "doc_id long, text string, id string, node binary")
    for shingle, percent in ((3, 85), (5, 80)):
        got = [tuple(r) for r in near_duplicates(df, shingle, percent).collect()]
        assert sorted(got, key=repr) == sorted(brute(rows, shingle, percent), key=repr)


def test_exact_beyond_the_index(spark):
    """Links far under the signatures' distance: the index alone loses some, the exact way none."""
    rng = random.Random(11)
    rows = [(i, " ".join(f"w{rng.randrange(5000)}" for _ in range(40))) for i in range(25)]
    for i in range(25, 60):
        w = rng.choice(rows[:25])[1].split()
        for _ in range(5):
            w[rng.randrange(len(w))] = f"x{i}y{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(brute(rows, 3, 35))
    assert sorted(tuple(r) for r in near_duplicates(df, 3, 35, exact=True).collect()) == want
    assert sorted(tuple(r) for r in near_duplicates(df, 3, 35).collect()) != want


def test_against_sql(spark):
    got, want = frames(spark, registry.QUERIES["op3_near_dedup"], registry.ORACLE["op3_near_dedup"])
    assert got == want


def test_components_and_empty(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(-5, -4)]
    got = {r.node: r.comp for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == dict.fromkeys(range(41), 0) | {-5: -5, -4: -5}
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_distance(spark):
    import numpy as np
    from pyspark.sql import functions as F

    rng = np.random.default_rng(2)
    rows = []
    for _ in range(50):
        a = rng.integers(0, 1 << 14, PLACES).astype(np.uint64)
        b = a.copy()
        at = rng.permutation(PLACES)[: rng.integers(0, PLACES + 1)]
        b[at] = (b[at] + rng.integers(1, 1 << 14, len(at)).astype(np.uint64)) % np.uint64(1 << 14)
        rows.append((packed(a).tolist(), packed(b).tolist(), len(at)))
    df = spark.createDataFrame(rows, "a array<long>, b array<long>, want int")
    for r in df.select("want", distance(F.col("a"), F.col("b")).alias("got"), F.size(F.array_intersect(index_keys(F.col("a")), index_keys(F.col("b")))).alias("shared")).collect():
        assert r.want == r.got and (r.shared or r.want > MOST)


def test_sets_that_share_a_hash(spark):
    """The second hash tells sets apart that share the first one, in rows and in full sets alike."""
    import terrasift.llm.near_dedup as N

    rng = random.Random(9)
    texts = [(i, " ".join(rng.choice("abcdefgh") * 3 + str(rng.randrange(40)) for _ in range(30))) for i in range(40)]
    texts += [(100 + i, t + " x") for i, t in texts[:10]] + [(200 + i, t) for i, t in texts[:5]]
    rows = spark.createDataFrame([(i, 1 + i % 3, h) for i, h in ((1, 5), (2, 5), (4, 6), (7, 7))], "id long, node long, second long")
    apart, rounds = N.told_apart(rows)
    got = {(r.node, r.second) for r in apart.collect()}
    assert len({n for n, _ in got}) == len({(1 + i % 3, h) for i, h in ((1, 5), (2, 5), (4, 6), (7, 7))}) and len(rounds) == 1
    again = N._renamed(rows, rounds[0])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, apart.collect()))
    df = spark.createDataFrame(texts, "doc_id long, text string")
    assert sorted(map(tuple, N.near_duplicates(df).collect())) == sorted(brute(texts, 5, 80))
