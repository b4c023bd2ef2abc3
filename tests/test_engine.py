import math
import random

import pytest
from pyspark.sql import functions as F

from terrasift import reconcile as RC
from terrasift.catalog import Catalog, alternate, fetch_first, parse_aoi, quarters, tiles
from terrasift.functions import geometry as G
from terrasift.functions import scalar as X
from terrasift.operators import rows as R
from terrasift.operators import spatial as S
from terrasift.sinks import packs as K


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first().v


def test_numbers(spark):
    got = lambda v, h=None: one(spark, X.parse_number(F.lit(v), h))
    assert [got("115000;34500"), got("1.2 MW", "W"), got("1,146.4"), got("n/a"), got(""), got("345 kV", "V"), got("345 kV")] == [115000.0, 1.2e6, 1146.4, None, None, 345000.0, 345.0]
    assert got("-5|x") == -5.0 and got("abc") is None
    assert one(spark, X.convert(F.lit("50 MW"), "MW", "W")) == 50.0 and one(spark, X.convert(F.lit("10"), "ft", "m")) == 32.8084
    with pytest.raises(X.UnknownUnit):
        X.convert(F.lit("1"), "ft", "furlong")
    for v in ("NOT AVAILABLE", " unknown ", "-999", "-999.0", "-9999", "-1e30", "", "-", None):
        assert one(spark, X.is_absent(F.lit(v).cast("string"))), v
    assert not one(spark, X.is_absent(F.lit("-998"))) and one(spark, X.is_absent(F.lit("77"), (77,)))


def test_names(spark):
    assert one(spark, X.fold_name(F.lit("Aitkin County, MN"))) == one(spark, X.fold_name(F.lit("<b>AITKIN</b> CO."))) == "aitkin"
    assert [one(spark, X.tone_kind(F.lit(t))) for t in ("114.8", "D023", "CC15", "23.0", " ")] == ["ctcss", "dcs", "colour-code", "unrecognised", "none"]
    assert [one(spark, X.format_unit(F.lit(v), None)) for v in (345.0, 34.5, 0.25)] == ["345", "34.5", "0.25"]
    assert X.resolve_column(["name", "NAME", "Dam Name"], ["NAME"]) == ["NAME", "name"] and X.resolve_column(["Dam Name"], ["DAM_NAME"]) == ["Dam Name"]
    assert one(spark, X.redact(F.lit("u?api_key=abc&x=1"))) == "u?api_key=***&x=1"


def inside(x, y, ring):
    out, j = False, len(ring) - 1
    for i in range(len(ring)):
        (xi, yi), (xj, yj) = ring[i], ring[j]
        if (yi > y) != (yj > y) and x < (xj - xi) * (y - yi) / (yj - yi) + xi:
            out = not out
        j = i
    return out


def test_polygons_against_loop(spark):
    rng = random.Random(2)
    star = lambda cx, cy, n: [(cx + r * math.cos(2 * math.pi * k / n), cy + r * math.sin(2 * math.pi * k / n)) for k in range(n) for r in [rng.uniform(0.5, 2)]]
    rings = [(p, r, r == 1, star(p, 0, 40) if r == 0 else [(p - 0.3, -0.3), (p + 0.3, -0.3), (p + 0.3, 0.3), (p - 0.3, 0.3)]) for p in range(3) for r in (0, 1)]
    df = spark.createDataFrame([(p, r, [{"x": x, "y": y} for x, y in pts]) for p, r, _, pts in rings], "poly_id int, ring_id int, points array<struct<x:double,y:double>>")
    edge = G.edges(df).withColumn("hole", F.col("ring_id") == 1).withColumn("poly_ord", F.col("poly_id"))
    pts = [(i, rng.uniform(-2, 4), rng.uniform(-2, 2)) for i in range(400)]
    got = {r.id: r.poly_id for r in S.points_in_polygons(spark.createDataFrame(pts, "id int, lon double, lat double"), edge).collect()}
    want = {}
    for i, x, y in pts:
        for p in range(3):
            if inside(x, y, rings[2 * p][3]) and not inside(x, y, rings[2 * p + 1][3]):
                want[i] = p
                break
    assert got == want


def test_greedy_against_loop(spark):
    rng = random.Random(7)
    a = [(i, rng.uniform(0, 0.06), rng.uniform(45, 45.04)) for i in range(60)]
    b = [(i, rng.uniform(0, 0.06), rng.uniform(45, 45.04)) for i in range(50)]
    schema = "id long, lon double, lat double"
    pairs = S.near_pairs(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), 800).cache()
    by, used, want = {}, set(), {}
    for r in pairs.collect():
        by.setdefault(r.a_id, []).append((r.d, r.dx, r.dy, r.b_id))
    for i in sorted(by):
        free = sorted(x for x in by[i] if x[3] not in used)
        if free:
            want[i] = free[0][3]
            used.add(free[0][3])
    assert {r.a_id: r.b_id for r in S.greedy_match(pairs).collect()} == want


def test_reconcile(spark):
    s = "id long, lon double, lat double, shape string, capacity_mw double, beds double"
    a = spark.createDataFrame([(1, -93.0, 45.0, None, 120.5, 0.0), (2, -93.0, 46.0, None, 5.0, None), (3, -93.0, 45.0, "marker", 1.0, None)], s)
    b = spark.createDataFrame([(7, -93.001, 45.0, None, 130.0, 3.0), (8, -90.0, 46.0, None, 5.0, None)], s)
    rows = {(r.side, r.a_id, r.b_id): (r.n_compared, r.n_diffs, r.diffs) for r in RC.reconcile(a, b).collect()}
    assert rows == {("both", 1, 7): (1, 1, "capacity_mw 7%"), ("only_a", 2, None): (0, 0, ""), ("only_b", None, 8): (0, 0, "")}
    assert "matched 1" in RC.report(RC.reconcile(a, b))


STATES = {"MN": ("27", (-97.2, 43.5, -89.5, 49.4)), "WI": ("55", (-92.9, 42.5, -86.8, 47.1)), "HI": ("15", (-160.2, 18.9, -154.8, 22.2))}


def test_catalog():
    assert parse_aoi("27", STATES).id == "MN" and parse_aoi("27123", STATES).kind == "county" and parse_aoi("conus", STATES).states == ("MN", "WI")
    assert parse_aoi("bbox:-93.2,44,-92.5,45", STATES).states == ("MN", "WI")
    with pytest.raises(ValueError):
        parse_aoi("state:XX", STATES)
    c = Catalog.load([("national", "us", {"defaults": {"driver": "file", "license": "PD"}, "sources": [{"layer": "dams", "priority": 10}, {"layer": "boundary", "id": "b"}]}), ("state", "state:WI", {"sources": [{"layer": "dams", "driver": "x", "id": "w", "enabled": True}]})])
    mn = parse_aoi("MN", STATES)
    assert [s["layer"] for s in c.select(mn)] == ["boundary", "dams"] and len(c.select(parse_aoi("WI", STATES))) == 3
    assert c.lint({"file"}) == ["w: no license", "w: unknown driver x"]
    with pytest.raises(ValueError):
        Catalog.load([("state", "state", {"sources": [{"id": "a"}, {"id": "a"}]})])
    alt = alternate({"id": "p", "driver": "file", "url": "u", "where": "w", "layer": "l"}, {"url": "v"})
    assert "where" not in alt and alt["url"] == "v" and alt["recovered_from"] == "p"
    tried = []

    def fetch(s):
        tried.append(s.get("url"))
        if s.get("url") == "u":
            raise OSError("first")
        return "df"

    assert fetch_first({"id": "p", "driver": "f", "url": "u", "alternates": [{"url": "v"}]}, fetch)[0] == "df" and tried == ["u", "v"]
    with pytest.raises(OSError, match="first"):
        fetch_first({"id": "p", "driver": "f", "url": "u"}, fetch)
    assert tiles((0, 0, 2.5, 1.5), 1)[-1] == (2, 1, 2.5, 1.5) and len(tiles((0, 0, 2.5, 1.5), 1)) == 6
    assert quarters((0, 0, 2, 2))[1] == (1.0, 0, 2, 1.0) and mn.render("x-{state}") == "x-MN" and mn.render("{nope}") == "{nope}"


def test_build(spark):
    c = Catalog.load([("national", "us", {"defaults": {"driver": "fake", "license": "PD"}, "sources": [{"layer": "plants", "id": "a"}, {"layer": "plants", "id": "b", "provider": "p"}, {"layer": "roads", "id": "bad"}]})])

    def fetch(s):
        if s["id"] == "bad":
            raise OSError("gone")
        return spark.createDataFrame([(0, "k", "[1,2]"), (1, "k", "[1,2]"), (2, None, "[1,2]"), (3, None, "[1,2]")], "ord long, source_id string, coordinates string")

    layers, rows = RC.build(c, parse_aoi("MN", STATES), fetch)
    assert list(layers) == ["plants", "plants__p"] and layers["plants"].count() == 3
    assert [r["error"] for r in rows] == [None, None, "OSError: gone"]


def test_buckets_and_sets(spark):
    df = spark.createDataFrame([("115", "x"), ("345", ""), ("69", None), ("345", "y"), ("n", "z"), (" ", "")], "v string, w string")
    by, counts = R.bucketize(df, ["v"])
    assert by == "v" and [r.bucket for r in counts.orderBy("place").collect()] == ["345", "115", "69", "n", "(blank)"]
    assert R.bucketize(df, ["w"], most=2)[0] is None
    own = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("c", 1), ("c", 2), ("c", 3), ("d", 9)], "o string, i int")
    assert {r.inner: r.outer for r in R.contained_sets(own, "o", "i").collect()} == {"a": "c", "b": "a"}
    assert R.prune_terms([("police station", 5), ("police", 5), ("fire hall", 3)]) == ["police station", "fire hall"]


def test_packs(spark):
    rows = [(0, "d", "345", 0, "A & <b>", "LineString", "[[0,1],[2,3]]"), (1, "d", "345", 0, "B", "LineString", "[[0,1]]"), (2, "d", "115", 1, "C", "Point", "[5,6]"), (3, "d", "115", 1, "P", "Polygon", "[[[0,0],[0,1],[1,1],[0,0]],[[0,0],[0,1],[1,1],[0,0]]]")]
    df = spark.createDataFrame(rows, "ord long, doc string, bucket string, place int, name string, geom_type string, coordinates string")
    marks = K.placemarks(df, F.col("name"), F.array(F.struct(F.lit("k").alias("label"), F.col("bucket").alias("value"))), F.lit("s"))
    f = K.folders(marks).orderBy("place").collect()
    assert [(r.bucket, r.n) for r in f] == [("345", 1), ("115", 2)] and "A &amp; &lt;b&gt;" in f[0].xml and "0.000000,1.000000,0 2.000000,3.000000,0" in f[0].xml and "innerBoundaryIs" in f[1].xml
    [d] = K.write_kmz(K.documents(K.folders(marks))).collect()
    assert d.n == 3 and bytes(d.kmz)[:2] == b"PK"
    import io
    import zipfile

    text = zipfile.ZipFile(io.BytesIO(bytes(d.kmz))).read("doc.kml").decode()
    assert text.index("345 (1)") < text.index("115 (2)")
    assert K.geojson_lines(df, F.struct("name")).count() == 4
    lic = spark.createDataFrame([("x", "ODbL 1.0"), ("y", " "), ("z", "ODbL 1.0")], "layer string, license string")
    assert [(r.license, r.layers, r.odbl) for r in K.attribution(lic).collect()] == [("ODbL 1.0", ["x", "z"], True), ("unspecified", ["y"], False)]


def test_stream_upsert(spark, tmp_path):
    from terrasift.streaming.upsert import upsert_into

    run = upsert_into(str(tmp_path / "t"), ["k"], overwrite=True)
    schema = "k int, v string"
    run(spark.createDataFrame([(1, "a"), (2, "b")], schema), 0)
    run(spark.createDataFrame([(2, "c"), (3, "d")], schema), 1)
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "t/version-1")).collect())) == [(1, "a"), (2, "c"), (3, "d")]
