import numpy as np
import pytest
from oracle import frames
from pyspark.sql import functions as F

from terrasift.llm import vector_codes
from terrasift.llm.registry import ORACLE, QUERIES
from terrasift.llm.vector_codes import Codebooks, _down, _next, _pack, _Round, _unpack, _up, compress, decode, with_label_error

SCHEMA = "vec_id long, embedding array<float>, label int, code string, x int"


def lloyd(x, parts, k, rounds):
    """Every distance of every round, in plain integers."""
    n, width = len(x), x.shape[1] // parts
    codes, errors, books = [], np.zeros(n, int), []
    for p in range(parts):
        own = x[:, p * width : (p + 1) * width]
        book = own[:k].copy()
        for r in range(rounds + 1):
            squared = ((own[:, None] - book[None]) ** 2).sum(2)
            near = squared.argmin(1)
            if r < rounds:
                for e in set(near.tolist()):
                    book[e] = np.floor_divide(own[near == e].sum(0), int((near == e).sum()))
        codes.append(near)
        errors += squared.min(1)
        books.append(book)
    return np.stack(codes, 1), errors, np.stack(books)


def rows(rng, n, dims, grid):
    return (rng.integers(-grid, grid + 1, (n, dims)) / 64).astype(np.float32)


@pytest.mark.parametrize("seed,n,grid", [(0, 400, 3), (1, 300, 1), (2, 900, 60), (3, 7, 5)])
def test_every_round_equals_plain_lloyd(spark, seed, n, grid):
    """Coarse grids make many ties and equal entries; with few rows there are fewer entries."""
    v = rows(np.random.default_rng(seed), n, 8, grid)
    df = spark.createDataFrame([(i, v[i].tolist(), i % 3 if i % 5 else None, "clash", 1) for i in range(n)], SCHEMA).repartition(3)
    looked = []
    got, books = compress(df, entries=32, looked=looked)
    want, errors, entries = lloyd(np.floor(v.astype(float) * 1024).astype(int), 4, 32, 4)
    assert books.entries.tolist() == entries.tolist()
    out = {r.id: r for r in got.collect()}
    assert [list(out[i].code) for i in range(n)] == want.tolist() and [out[i].error for i in range(n)] == errors.tolist()
    if seed == 2:
        assert looked[-1] < 0.5 * looked[0], looked


def test_bounds_hold(monkeypatch):
    """Bounds are on their side of the distance, also after the cut to 16 bits and after entries move."""
    rng = np.random.default_rng(5)
    squared = np.concatenate([np.arange(5000), rng.integers(0, 1 << 50, 5000)])
    assert ((_up(squared).astype(np.longdouble) ** 2) >= squared).all() and ((_down(squared).astype(np.longdouble) ** 2) <= squared).all()
    down = _down(squared)
    assert (_unpack(_pack(down)) <= down).all() and (_unpack(_pack(down)) >= down * 0.98).all()
    x, a = rng.integers(-500, 500, (200, 6)), rng.integers(-500, 500, (20, 6))
    b = a + rng.integers(-9, 10, a.shape)
    full = lambda e: ((x[:, None] - e) ** 2).sum(2)
    own, upper, lower, looked = _next(x, _Round.of(b, a), full(a).argmin(1), _up(full(a).min(1)), _down(full(a)))
    assert own.tolist() == full(b).argmin(1).tolist() and looked < x.shape[0] * len(a)
    assert (upper.astype(float) ** 2 >= full(b).min(1)).all() and (lower.astype(float) ** 2 <= full(b)).all()


def test_query_against_sql(spark):
    got, want = frames(spark, QUERIES["op12_vector_codes"], ORACLE["op12_vector_codes"])
    assert got and got == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    data = [
        (1, None, 1, "", 0),
        (2, [0.1] * 7 + [None], 1, "", 0),
        (3, [nan] * 8, 1, "", 0),
        (4, [inf] * 8, 1, "", 0),
        (5, [], 1, "", 0),
        (6, [0.25] * 8, None, "", 0),
        (6, [0.25] * 8, None, "", 0),
        (7, [-0.0001] * 8, 2, "", 0),
        (8, [0.5] * 4, 2, "", 0),
        (9, [0.5] * 6, 2, "", 0),
        (None, [1.0] * 8, None, "", 0),
    ]
    got, books = compress(spark.createDataFrame(data, SCHEMA))
    out = sorted(((r.id, r.label, r.code.hex(), r.error, r.label_error) for r in with_label_error(got).collect()), key=repr)
    assert out == [(6, None, "00000000", 0, 0), (6, None, "00000000", 0, 0), (7, 2, "02020202", 0, 0), (None, None, "03030303", 0, 0)]
    assert books.entries[0].tolist() == [[256, 256], [256, 256], [-1, -1], [1024, 1024]]
    assert sorted(r.vector for r in decode(got, books).where("id = 7").collect()) == [[-1 / 1024] * 8]
    assert decode(spark.createDataFrame([(1, bytearray(b"\xff\0\0\0")), (2, None)], "id long, code binary"), books).where("vector IS NOT NULL").count() == 0


def test_empty_large_and_equal(spark):
    got, books = compress(spark.createDataFrame([], SCHEMA))
    assert got.collect() == [] and with_label_error(got).collect() == [] and books.sha256() == Codebooks(np.zeros((4, 0, 0), int), 1).sha256()
    same = spark.createDataFrame([(i, [0.5] * 8, 0, "", 0) for i in range(300)], SCHEMA)
    got, books = compress(same)
    assert got.select(F.hex("code"), "error").distinct().collect() == [("00000000", 0)] and books.entries.shape == (4, 256, 2)
    with pytest.raises(Exception, match="would not fit"):
        compress(spark.createDataFrame([(1, [1e6] * 8, 0, "", 0)], SCHEMA))


def test_sums_by_label_without_broadcast(spark):
    rows = spark.createDataFrame([(i, None if i % 7 == 0 else i % 40, bytearray([i % 256]), i) for i in range(500)], "id long, label int, code binary, error long")
    key = lambda df: sorted(map(repr, df.collect()))
    assert key(with_label_error(rows, broadcast_rows=3)) == key(with_label_error(rows)) and with_label_error(rows, 3).count() == 500


def test_exact_beyond_doubles():
    x, e = np.array([[1 << 26, -(1 << 26)]]), np.array([[-(1 << 26), (1 << 26) - 1]])
    assert vector_codes._all_squared(x, e).tolist() == [[(1 << 54) + ((1 << 27) - 1) ** 2]]
