import datetime as dt
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from terrasift import cli, demo, health
from terrasift.catalog import Aoi
from terrasift.operators import packs as K
from terrasift.sources import feeds, files, overpass
from terrasift.sources.fetch import Answer, Budget, Client, Mirrors, OutOfTime, Refused, months, newest_month


class Clock:
    def __init__(self):
        self.now, self.slept = 0.0, []

    def __call__(self):
        return self.now

    def sleep(self, s):
        self.slept.append(s)
        self.now += s


def client(answers, clock, **more):
    calls = []

    def opener(url, body, headers, timeout):
        calls.append(url)
        a = answers.pop(0) if isinstance(answers, list) else answers[url]
        if isinstance(a, Exception):
            raise a
        return a

    return Client(opener=opener, clock=clock, sleep=clock.sleep, **more), calls


def test_client_retries_and_cache(tmp_path):
    clock = Clock()
    c, calls = client([Answer(503), Answer(429, headers={"retry-after": "7"}), OSError("down"), Answer(200, b"data")], clock, cache=str(tmp_path))
    assert c.get("http://h/a") == b"data" and clock.slept == [2.0, 7.0, 8.0] and len(calls) == 4
    assert c.get("http://h/a") == b"data" and len(calls) == 4
    stale, again = client([Answer(200, b"newer")], clock, cache=str(tmp_path), fresh=0.0)
    assert stale.get("http://h/a") == b"newer" and len(again) == 1 and c.get("http://h/a") == b"newer"
    c, calls = client([Answer(404)], clock)
    with pytest.raises(Refused):
        c.get("http://h/b")
    c, calls = client([Answer(200, b" <html>"), Answer(200, b"PK")], clock, cache=str(tmp_path))
    with pytest.raises(Refused):
        c.get("http://h/x.zip?a=1")
    assert c.get("http://h/x.zip?a=1") == b"PK"  # the page was not cached
    c, _ = client([Answer(200, b"1"), Answer(200, b"2")], clock, gap=5.0)
    start = clock.now
    c.get("http://h/1"), c.get("http://h/2")
    assert clock.now - start == 5.0
    c, _ = client([Answer(503)] * 9, clock)
    with pytest.raises(OutOfTime):
        c.get("http://h/z", budget=Budget(4, clock))
    late = TimeoutError("late")
    c, calls = client([late] * 9, clock)
    with pytest.raises(TimeoutError) as e:
        c.get("http://h/late")
    assert e.value is late and len(calls) == 4


def test_months():
    assert list(months("{month}-{year}", dt.date(2024, 2, 9), 2)) == ["february-2024", "january-2024", "december-2023"]
    c, _ = client({"u/march": Answer(404), "u/february": Answer(403), "u/january": Answer(200, b"x")}, Clock())
    assert newest_month(c, "u/{month}", dt.date(2024, 3, 1)) == (b"x", "u/january")
    c, _ = client({"u/march": Answer(400)}, Clock())
    with pytest.raises(Refused):
        newest_month(c, "u/{month}", dt.date(2024, 3, 1))


def test_mirrors():
    clock = Clock()

    def mirrors(*answers):
        left = list(answers)

        def ask(url, query, seconds):
            a = left.pop(0)
            if isinstance(a, Exception):
                raise a
            return a | {"url": url}

        return Mirrors(["a", "b", "c"], ask, clock, clock.sleep)

    assert mirrors({"remark": "runtime error: x"}, {"elements": []}).run("q", 9, start=1)["url"] == "c"
    m = mirrors(*[Refused(429, "u", 30.0)] * 3, {"elements": [1]})
    assert m.run("q", 9)["elements"] == [1] and clock.slept == [30.0]
    with pytest.raises(TimeoutError):
        mirrors(TimeoutError(), Refused(504, "u")).run("q", 9)
    with pytest.raises(Refused):
        mirrors(*[Refused(429, "u", 30.0)] * 99).run("q", 9, passes=5)
    with pytest.raises(RuntimeError):
        mirrors(*[OSError("x")] * 9).run("q", 9)
    with pytest.raises(OutOfTime):
        mirrors().run("q", 9, budget=Budget(0, clock))


def test_query_text():
    q = overpass.query_text(["power=line;voltage>=100000", "name~^A;x!=y"], (0, 1, 2, 3), "w", 90, country="DE")
    assert q == '[out:json][timeout:90];area["ISO3166-1"="DE"]["admin_level"="2"]->.a;(way["power"="line"]["voltage"](area.a)(1.000000,0.000000,3.000000,2.000000);way["name"~"^A"]["x"!="y"](area.a)(1.000000,0.000000,3.000000,2.000000););out geom qt;'
    assert overpass.lint_query(q) == [] and overpass.lint_query("[out:json][timeout:9];(node(1,2,3,4););out geom;") and overpass.lint_query("x")
    with pytest.raises(ValueError):
        overpass.query_text(["a=b"], (0, 0, 1, 1), "lines")
    with pytest.raises(ValueError):
        overpass.query_text([" ; "], (0, 0, 1, 1))
    assert overpass.lint_classes([("a", ["k=v"], "A"), ("a", [], " ")], {"z"}, {"a"}) == ["a: twice", "z: switched off, but no class", "a: no label", "a: no selector"]


def test_scope():
    asked = []
    m = Mirrors(["a"], lambda u, q, s: asked.append(q) or {"elements": [{"bounds": {"minlon": 0, "minlat": 0, "maxlon": 2, "maxlat": 1}}]})
    known = {}
    for _ in range(2):
        assert overpass.scope(Aoi("country", "DE"), m, 1.0, 9, known) == ([(0, 0, 1.0, 1), (1.0, 0, 2, 1)], "DE")
    assert len(asked) == 1
    with pytest.raises(ValueError):
        overpass.scope(Aoi("world", "world"), m, 1.0, 9)
    with pytest.raises(LookupError):
        overpass.scope(Aoi("country", "XX"), Mirrors(["a"], lambda u, q, s: {}), 1.0, 9, {})


def test_towers(spark, tmp_path):
    def line(n, **at):
        row = [""] * n
        for k, v in at.items():
            row[int(k[1:])] = v
        return "|".join(row)

    (tmp_path / "RA").write_text("\n".join([line(45, _3="R1", _4="1", _8="C", _22="mast", _25="61.0", _29="wi"), line(45, _4="2", _8="C", _29="MN"), line(45, _4="3", _8="D", _29="WI"), "short|row"]) + "\n", encoding="latin-1")
    (tmp_path / "EN").write_text("\n".join([line(10, _4="1", _5="R", _7="no"), line(10, _4="1", _5="o", _7='Caf\xe9 "Co"'), line(10, _4="1", _5="O", _7="late")]) + "\n", encoding="latin-1")
    (tmp_path / "CO").write_text("\n".join([line(18, _4="1", _6="45", _7="30", _8="0", _9="N", _11="92", _12="54", _13="0", _14="W", _16="1", _17="3"), line(18, _4="2", _6="45", _9="N", _11="92", _14="W")]) + "\n", encoding="latin-1")
    [r] = feeds.towers(spark, *(str(tmp_path / t) for t in ("RA", "EN", "CO")), ["WI"], ["C", "G"]).collect()
    assert (r.reg, r.lat, round(r.lon, 6), r.owner, r.status, r.structure_type, r.height_agl_m, r.array_position) == ("R1", 45.5, -92.9, 'Caf\xe9 "Co"', "Constructed", "Mast", 61.0, "1 of 3")


def test_tiger(spark):
    codes, county, state = {"MN": "27"}, Aoi("county", "27123", None, ("MN",), "27123"), Aoi("state", "MN", None, ("MN",), "27")
    assert feeds.tiger_files("roads", county, 2024, codes)[0].endswith("ROADS/tl_2024_27123_roads.zip") and feeds.tiger_files("cousub", state, 2024, codes)[0].endswith("tl_2024_27_cousub.zip")
    for bad in (("roads", state), ("water", state), ("county", Aoi("world", "world"))):
        with pytest.raises(ValueError):
            feeds.tiger_files(bad[0], bad[1], 2024, codes)
    rows = spark.createDataFrame([({"STATEFP": "27", "COUNTYFP": "123"},), ({"STATEFP": "27", "COUNTYFP": "1"},), ({"STATEFP": "55", "COUNTYFP": "123"},)], "properties map<string,string>")
    assert [feeds.tiger_rows(rows, p, a, codes).count() for p, a in (("county", county), ("county", state), ("cousub", county), ("roads", county))] == [1, 2, 2, 3]


def test_tables_and_packs(spark, tmp_path):
    (tmp_path / "s.csv").write_text('# about\ngeoid,seat\n27001,A\n27003,"B, b"\n,x\n')
    (tmp_path / "s.local.csv").write_text("geoid,seat\n27003,Mine\n")
    assert {r.geoid: r.seat for r in feeds.keyed_table(spark, str(tmp_path / "s.csv"), str(tmp_path / "s.local.csv")).collect()} == {"27001": "A", "27003": "Mine"}
    page = spark.createDataFrame([("<html>Invalid Key</html>",)], "value string")
    assert feeds.acs_table(page, {"p": "X"}, "a", "b").count() == 0
    assert feeds.acs_table(spark.createDataFrame([('[["NAME","county"]]',)], "value string"), {"p": "X"}, "a", "b").count() == 0
    kml = '<kml><Folder><name>F</name><Placemark id="1"><Point/><name><![CDATA[Aitkin County]]></name></Placemark><Placemark><name>AITKIN CO.</name></Placemark><Placemark/></Folder><!-- Source --></kml>'
    d = tmp_path / "packs" / "deep"
    d.mkdir(parents=True)
    (d / "a.kml").write_text(kml)
    (d / "bad.kmz").write_bytes(b"PK?")
    with zipfile.ZipFile(d / "b.KMZ", "w") as z:
        z.writestr("x/doc.kml", kml)
    got = {r.path.rsplit("/", 1)[-1]: r for r in feeds.pack_contents(spark, str(tmp_path / "packs")).collect()}
    assert got["a.kml"].n_placemarks == 3 and got["a.kml"].names == ["aitkin"] == got["b.KMZ"].names and got["a.kml"].folders == ["F"] and got["a.kml"].provenance == ["source"] and got["bad.kmz"].error
    (d / "link-a.kml").symlink_to(d / "a.kml")
    assert {r.name for r in feeds.pack_files(spark, str(tmp_path / "packs"), "A").collect()} == {"a.kml", "bad.kmz"}
    with pytest.raises(files.NotData):
        feeds.to_lonlat(F.lit(1.0), F.lit(2.0), "EPSG:26915")
    (tmp_path / "page.csv").write_text("<!doctype html>")
    with pytest.raises(files.NotData):
        feeds.read_file(spark, str(tmp_path / "page.csv"))
    assert feeds.read_file(spark, str(tmp_path / "s.local.csv")).count() == 1


def test_counties_and_services(spark):
    ring = "[[0,0],[0,1],[1,1],[0,0]]"
    rows = spark.createDataFrame([("Polygon", f"[{ring},{ring}]", {"GEOID": "27001", "NAME": " "}), ("MultiPolygon", f"[[{ring}]]", {"GEOID": "2700", "NAME": "x"}), ("Point", "[0,0]", {"GEOID": "27009", "State": "Minnesota"})], "geom_type string, coordinates string, properties map<string,string>")
    mine = feeds.of_state(rows, "27")
    assert [(r.geoid, r.name, r.ring_ord) for r in feeds.county_rings(mine).collect()] == [("27001", None, 0), ("27001", None, 1)]
    assert feeds.plants(rows, "Minnesota").count() == 1 and feeds.lower_keys(rows).first().properties == {"geoid": "27009", "state": "Minnesota"}
    listing = spark.createDataFrame([("S", "Dams", "HEIGHT"), ("T", "x", "y")], "service string, layer string, field string")
    assert [r.service for r in feeds.services(listing, "dam").collect()] == ["S"]
    df, seen = K.observed(spark.range(7), "rows")
    assert df.count() == 7 and seen.get == {"features": 7}


def test_health(spark):
    def ok(spec, aoi):
        if "bad" in spec["url"]:
            raise Refused(404, spec["url"])
        if "slow" in spec["url"]:
            tries.append(1)
            raise TimeoutError("too slow")
        if "key" in spec["url"]:
            raise Refused(401, spec["url"])
        return ["Height_Ft"], 0 if "none" in spec["url"] else 5

    tries = []
    area = Aoi("state", "MN", None, ("MN",))
    sources = [{"id": i, "driver": "d", "url": u, "fields": {"height": ["HEIGHT FT"], "x": ["Y"]} if i == "w" else {}, "alternates": alt} for i, u, alt in (("a", "u/{state}", []), ("w", "u", []), ("n", "none", []), ("k", "key", []), ("b", "bad", [{"url": "slow"}, {"url": "good"}]), ("s", "slow", []))]
    found = health.doctor([*sources, {"id": "q", "driver": "other"}], area, {"d": ok}, tries=2)
    assert [h.status for h in found] == ["ok", "warn", "warn", "auth", "dead", "dead", "skip"] and found[0].url == "u/MN" and found[4].alternate == "good" and len(tries) == 4
    assert health.unhealthy(found) and not health.unhealthy(found[:5])
    text = health.doctor_report(found, "MN")
    assert "dead 2" in text and "| a | ok | 5 |" in text and "the alternate at good" in text and "a key is needed" in text
    assert K.status_summary(health.as_rows(spark, found), list(health.STATUSES)).first().asDict() == {"ok": 1, "warn": 2, "auth": 1, "dead": 2, "skip": 1, "recovered": 1}
    rows = {r.key: (r.column, r.n, r.generic) for r in health.schema_report(spark.createDataFrame([("a", " "), ("", "x")], "`Name` string, `H ft` string"), {"name": ["NAME"], "h": ["h_ft"], "z": ["Q"]}).collect()}
    assert rows == {"name": ("Name", 1, True), "h": ("H ft", 1, False), "z": (None, None, False)}


def test_demo_and_command_line(spark, tmp_path, capsys):
    assert demo.layers(spark).count() == 68 and demo.layers(spark).select("layer").distinct().count() == 13
    docs = {r.doc: r.n for r in demo.pack(spark).collect()}
    assert sum(docs.values()) == 68 and docs["lines"] == 6
    assert cli.main(["demo", str(tmp_path / "d"), "--box=-96,44,-92,46"]) == 0 and len(list((tmp_path / "d").iterdir())) == 6
    assert cli.main(["tiles", "0,0,2.5,1.5"]) == 0 and len(capsys.readouterr().out.split()) == 6
    assert cli.main(["tiles", "0,0,99,99"]) == 1 and cli.main(["run", "nothing", "x"]) == 1 and cli.main(["sniff", str(tmp_path / "none")]) == 1
    assert cli.main(["list"]) == 0 and "clip_ring_10k" in capsys.readouterr().out
    assert cli.main(["run", "class_counts_zero", "/root/testdata/sf0.001", "--out", str(tmp_path / "out")]) == 0 and spark.read.parquet(str(tmp_path / "out")).count() == 6
