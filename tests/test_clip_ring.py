import math

import duckdb
import numpy as np

from terrasift.plans import load
from terrasift.plans.registry import QUERIES

load()
SF = "/root/testdata/sf0.1"


def test_points_beyond_the_published_case(spark):
    """Every 500th of the points after the first 100,000, against all edges of the ring."""
    got = {r.id for r in QUERIES["clip_ring_10k"](spark, SF).collect()}
    k = np.array([x for (x,) in duckdb.connect().execute(f"SELECT DISTINCT l_orderkey * 7 + l_linenumber AS k FROM '{SF}/lineitem.parquet' ORDER BY k OFFSET 100000").fetchall()])[::500]
    lon, lat = -97.0 + (k * 7919) % 80000 / 10000.0, 43.0 + (k * 6271) % 60000 / 10000.0
    t = np.arange(10_000) * (2 * math.pi / 10_000)
    x, y = -93.0 + (2.5 + 0.5 * np.sin(t * 40)) * np.cos(t), 46.0 + (2.0 + 0.4 * np.sin(t * 40)) * np.sin(t)
    u, v = np.roll(x, -1), np.roll(y, -1)
    over = (y > lat[:, None]) != (v > lat[:, None])
    with np.errstate(divide="ignore", invalid="ignore"):
        right = lon[:, None] < (u - x) * (lat[:, None] - y) / (v - y) + x
    want = {int(i) for i, n in zip(k, (over & right).sum(1), strict=True) if n % 2}
    assert len(want) > 100 and got & set(k.tolist()) == want
