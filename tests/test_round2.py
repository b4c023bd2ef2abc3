import pytest
from pyspark.sql import functions as F

from terrasift.functions import scalar as X
from terrasift.operators import rows as R
from terrasift.operators import spatial as S
from terrasift.sources import files, rest
from terrasift.sources import osm as O
from terrasift.streaming.upsert import upsert_into


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_names(spark):
    county = {" Polk County": "polk", "St. Louis city": "st. louis", "Orleans Parish": "orleans", "Juneau city and borough": "juneau city and", "Nome Census Area": "nome", "Carson City": "carson", "county": "county"}
    assert {k: one(spark, X.county_name(F.lit(k))) for k in county} == county
    fold = {"Aitkin": "aitkin", "Aitkin County, MN": "aitkin", "<b>AITKIN</b> CO.": "aitkin", "City of the Lakes, <i>mn</i> ": "lakes", "Coon-Rapids,  Mn, x": "coon rapids mn x", "a, MNx": "a mnx"}
    assert {k: one(spark, X.fold_name(F.lit(k))) for k in fold} == fold
    assert one(spark, X.fold_name(F.lit(None).cast("string"))) == ""
    packs = {"A__Current_1.kmz": ("A", "Current_1"), "A_Current.KML": ("A_Current", ""), "A__b__c": ("A", "b__c"), "x.kmz.kml": ("x.kmz", "")}
    assert {k: (one(spark, X.family(F.lit(k))), one(spark, X.family_edition(F.lit(k)))) for k in packs} == packs


def test_absent(spark):
    for v in (None, "", " n/a ", "-999", "-999.0", "-9,999", "-1e30", "gone", "7", "7.0"):
        assert one(spark, X.is_absent(F.lit(v).cast("string"), ("Gone", 7))), v
    assert not any(one(spark, X.is_absent(F.lit(v), ("Gone", 7))) for v in ("0", "x", "-998", "77"))


def test_tones(spark):
    kinds = {"D47": "dcs", "d023": "dcs", "D 023": "dcs", "D172N": "dcs", "cc 3": "colour-code", "CC15": "colour-code", "D1": "unrecognised", "CC123": "unrecognised", "114.8": "ctcss"}
    assert {k: one(spark, X.tone_kind(F.lit(k))) for k in kinds} == kinds
    assert one(spark, X.tone_note(F.lit("47.0"))) == "not a CTCSS tone - looks like DCS 047 read as a number"
    assert one(spark, X.tone_note(F.lit("77.3"))).endswith("a frequency") and one(spark, X.tone_note(F.lit("x"))).startswith("not a CTCSS tone, ") and one(spark, X.tone_note(F.lit("114.8"))) == ""


def test_areas_and_relations():
    assert not O.is_area({"power": "line", "area": "yes"}, True) and O.is_area({"area": "no"}, True, "area") and not O.is_area({"area": "yes"}, False)
    pts = lambda *xy: [{"lat": float(y), "lon": float(x)} for x, y in xy]
    way = lambda role, *xy: {"type": "way", "role": role, "geometry": pts(*xy)}
    square, gap = way("outer", (0, 0), (0, 1), (1, 1), (0, 0)), way("outer", (5, 5), (6, 6))
    assert O.element_geometry("relation", None, None, {"type": "multipolygon"}, None, [square, gap])[0] == "Polygon"
    assert O.element_geometry("relation", None, None, {"type": "multipolygon"}, None, [gap]) == ("Point", [5.5, 5.5])
    assert O.element_geometry("relation", None, None, {"type": "boundary"}, None, [gap]) == ("LineString", [[5.0, 5.0], [6.0, 6.0]])
    assert O.element_geometry("relation", 1.0, 2.0, {"type": "route"}, None, [{"type": "node", "role": "stop", "geometry": pts((1, 1))}]) == ("Point", [2.0, 1.0])
    ring = [[k, (k * k) % 7] for k in range(3000)]
    ways = [ring[k : k + 2] if k % 2 else ring[k : k + 2][::-1] for k in range(2999)] + [[ring[-1], ring[0]]]
    rings, whole = O.stitch(ways[::2] + ways[1::2])
    assert whole and len(rings) == 1 and len(rings[0]) == 3001


def test_delimited_quotes_and_repeated_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text('NAME,LAT,LON\n"A\nB ""x""",45,-93\nNAME,LAT,LON\n,,\n   \nC,46,-94\n')
    rows = files.delimited(spark, str(tmp_path / "a.csv")).collect()
    assert sorted(tuple(r) for r in rows) == [('A\nB "x"', "45", "-93"), ("C", "46", "-94"), ("NAME", "LAT", "LON")]
    (tmp_path / "b.csv").write_text('﻿about this\nNAME;LAT\n"D;\nE";1\nabout this\n')
    rows = files.delimited(spark, str(tmp_path / "b.csv"), sep=";", skip_lines=1).collect()
    assert sorted(tuple(r) for r in rows) == [("D;\nE", "1"), ("about this", "")]


def test_upsert_needs_its_versions(spark, tmp_path):
    run = upsert_into(str(tmp_path / "t"), ["k"], overwrite=True, order="at")
    frame = lambda *rows: spark.createDataFrame(rows, "k long, at long, v string")
    run(frame((1, 5, "new"), (1, 2, "old"), (2, 1, "x")), 0)
    run(frame((2, 3, "z"), (2, 2, "y")), 1)
    assert {r.k: r.v for r in spark.read.parquet(str(tmp_path / "t" / "version-1")).collect()} == {1: "new", 2: "z"}
    with pytest.raises(FileNotFoundError):
        run(frame((3, 1, "q")), 7)


def repeating(url, params):
    if params.get("meta"):
        return {"maxRecordCount": 2}
    if params.get("returnCountOnly"):
        return {"count": 4}
    return {"features": [{"attributes": {"OID": i}, "geometry": {"x": i, "y": 1}} for i in range(2)]}


def test_repeated_page_is_an_error(spark):
    rest.TRANSPORTS["repeating"] = repeating
    reader = rest.ServiceReader({"url": "u", "transport": "repeating"})
    rows = [r for p in reader.partitions() for r in reader.read(p)]
    df = spark.createDataFrame(rows, "ord long, geom_type string, coordinates string, properties map<string,string>")
    with pytest.raises(rest.RepeatedPage):
        rest.unrepeated(df)
    assert rest.unrepeated(df.where("ord < 2")).count() == 2


def test_near_pairs_far_north_and_wide(spark):
    schema = "id long, lon double, lat double"
    for lat, step, radius in ((84.0, 0.05, 800.0), (10.0, 0.04, 9000.0)):
        rows = [(i, i * step, lat) for i in range(12)]
        got = {(r.a_id, r.b_id) for r in S.near_pairs(spark.createDataFrame(rows, schema), spark.createDataFrame(rows, schema), radius).collect()}
        from math import cos, radians

        want = {(i, j) for i in range(12) for j in range(12) if abs(i - j) * step * 111320 * cos(radians(lat)) < radius}
        assert want <= got and len(got) < 144


def test_contained_sets_against_brute_force(spark):
    import random

    rnd = random.Random(3)
    sets = {o: frozenset(rnd.sample("abcdefghij", rnd.randint(1, 5))) for o in range(80)}
    df = spark.createDataFrame([(o, i) for o, s in sets.items() for i in s] + [(200, None)], "o long, i string")
    want = {o: min(p for p, t in sets.items() if s < t) for o, s in sets.items() if any(s < t for t in sets.values())}
    assert {r.inner: r.outer for r in R.contained_sets(df, "o", "i").collect()} == want


def test_clip_shapes(spark):
    """A shape around the whole area, one in its hole, one across an edge without a place inside, empty and null ones, an equal id."""
    from terrasift.operators.spatial import clip_shapes

    area = [(False, [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)]), (True, [(4.0, 4.0), (6.0, 4.0), (6.0, 6.0), (4.0, 6.0)])]
    rows = [
        (1, "Polygon", "[[[-5,-5],[20,-5],[20,20],[-5,20],[-5,-5]]]"),
        (2, "Polygon", "[[[-5,-5],[20,-5],[20,20],[-5,20],[-5,-5]],[[-1,-1],[11,-1],[11,11],[-1,11],[-1,-1]]]"),
        (3, "LineString", "[[-1,5],[11,5]]"),
        (4, "LineString", "[[4.5,4.5],[5.5,5.5]]"),
        (5, "Point", "[5,5]"),
        (6, "Point", "[1,1]"),
        (7, "MultiPolygon", "[[[[20,20],[21,20],[21,21],[20,20]]],[[[8,8],[9,8],[9,9],[8,8]]]]"),
        (8, "LineString", "[[11,0],[11,10]]"),
        (9, "Point", None),
        (10, None, "[1,1]"),
        (6, "Point", "[1,1]"),
        (None, "Point", "[1,1]"),
        (11, "MultiLineString", "[]"),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], "id long, geom_type string, coordinates string, lon string")
    assert sorted(r.id for r in clip_shapes(df, area, 1.0).collect()) == [1, 3, 6, 6, 7]
    assert clip_shapes(df.limit(0), area, 1.0).collect() == []


def test_catalog_lint_of_drivers_fields_and_alternates():
    from terrasift.catalog import Catalog

    base = {"license": "PD", "coverage": "us", "source_name": "n"}
    rows = [
        {**base, "id": "fine", "layer": "l", "driver": "file", "url": "u", "fields": {"height_ft": {"from": ["H@m", "H"]}, "owner": {"const": "x"}, "beds": False}, "style_rules": [{"when": "height_ft >= 5"}, {"when": "other = 1"}], "alternates": [{"note": "none"}]},
        {**base, "id": "a", "layer": "l", "driver": "arcgis", "source_name": ""},
        {**base, "id": "o", "layer": "l", "driver": "overpass", "elements": "blob", "aoi_kinds": ["planet"]},
        {**base, "id": "f", "layer": "l", "driver": "file", "url": "u", "fields": {"height_ft": {"from": "H@furlong"}, "owner": {"from": []}, "nonsense": {}}, "style_rules": [{}, {"when": "beds > 2"}], "alternates": [{}, "x"]},
        {**base, "id": "m", "layer": "l", "driver": "file", "url": "u", "fields": ["x"]},
    ]
    c = Catalog.load([("national", "us", {"sources": rows})])
    found = c.lint({"file", "arcgis", "overpass"}, {"height_ft": "ft", "owner": "", "beds": ""})
    assert found == [
        "a: arcgis without url",
        "a: arcgis without layer_id or layer_match",
        "a: arcgis without source_name",
        "o: overpass without tags or tag",
        "o: elements: 'blob' is unknown",
        "o: aoi_kinds: 'planet' is unknown",
        "f: nonsense is no canonical field",
        "f: owner comes from nothing",
        "f: height_ft in 'furlong', which has no conversion",
        "f: style rule without when",
        "f: style rule on beds, which is never mapped",
        "f: alternate without url",
        "f: alternate is no mapping",
        "m: fields is no mapping",
    ]


def test_area_names():
    from terrasift.catalog import Aoi, sector_slug

    county = Aoi("county", "27025", None, ("MN",), "27025", "Lac qui Parle")
    assert (county.folder, county.prefix, county.describe()) == ("us/mn/27025_lac_qui_parle", "MN-Lac-qui-Parle", "Lac qui Parle County, MN (FIPS 27025)")
    assert (Aoi("county", "27025", None, ("MN",), "27025").prefix, Aoi("state", "MN", None, ("MN",)).folder) == ("MN-27025", "us/mn")
    box = Aoi("bbox", "-93.5,44,-92,45", (-93.5, 44.0, -92.0, 45.0), ("MN", "WI"))
    assert (box.folder, box.prefix, box.state) == ("bbox_m93p500_44p000_m92p000_45p000", "BBOX", None)
    assert Aoi("region", "upper-midwest", None, ("MN", "WI")).describe() == "region upper-midwest: MN, WI" and Aoi("world", "world").prefix == "WORLD"
    assert (sector_slug("Energy - Oil & Gas"), sector_slug(" - ")) == ("Energy-Oil-Gas", "Other")
