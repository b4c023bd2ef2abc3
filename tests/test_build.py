import json
import zipfile

from pyspark.sql import functions as F

from terrasift import reconcile as R
from terrasift.plans import builds as B

SF = "/root/testdata/sf0.001"


def test_files_of_a_build(spark, tmp_path):
    """Archives, lines, licences, matches and a manifest whose counts are those of the files; layers of lines are not matched."""
    layers, rows = B.built(spark, SF)
    files = R.publish(spark, layers, rows, B.SOURCES, str(tmp_path), bucket="class", box=B.BOX, radius=1500.0)
    told = json.loads((tmp_path / "manifest.json").read_text())
    assert sorted([*told["files"], "manifest.json"]) == files and told["bbox"] == list(B.BOX)
    assert [r["error"] is None for r in told["sources"]] == [True, True, True, False]
    for r in told["sources"][:3]:
        assert r["rows_in"] - r["merged"] - r["outside"] == r["features"] == layers[r["layer"]].count()
        lines = spark.read.text(str(tmp_path / "geojson" / r["layer"])).count()
        with zipfile.ZipFile(tmp_path / "packs" / f"{r['layer']}.kmz") if r["features"] else zipfile.ZipFile(tmp_path / "packs" / "shops.kmz") as z:
            kml = z.read("doc.kml").decode()
        assert lines == r["features"] and (not r["features"] or kml.count("<Placemark>") == r["features"])
    assert [f for f in files if f.startswith("reconcile")] == ["reconcile-shops-depots.md"]
    assert (tmp_path / "ATTRIBUTION.txt").read_text() == "PD: depots, roads, shops\n"


def test_matches_against_a_loop(spark):
    """The pairs that a loop over depots in order of id would make."""
    from math import cos, radians, sqrt

    layers, _ = B.built(spark, SF)
    rows = {k: sorted((r.id, r.lon, r.lat) for r in layers[k].select("id", "lon", "lat").collect()) for k in ("shops", "depots")}
    taken, want = set(), 0
    for _, x, y in rows["shops"]:
        near = sorted((6371000 * sqrt((radians(b - x) * cos(radians((c + y) / 2))) ** 2 + radians(c - y) ** 2), i) for i, b, c in rows["depots"] if i not in taken)
        if near and near[0][0] < 1501:
            taken.add(near[0][1])
            want += 1
    got = {(r.pair, r.side): r.n for r in B.build_matches(spark, SF).collect()}
    assert {p for p, _ in got} == {"shops/depots"} and got.get(("shops/depots", "both"), 0) == want
    assert sum(n for (_, s), n in got.items() if s != "only_b") == len(rows["shops"]) and F is not None


def test_counts_are_null_for_a_failed_source(spark):
    rows = {r.layer: r for r in B.build_counts(spark, SF).collect()}
    assert rows["gone"].failed and rows["gone"].rows_in is None and not rows["shops"].failed
