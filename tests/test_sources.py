import json
import sqlite3
import struct
import zipfile

import pytest

from terrasift.sources import files as S
from terrasift.sources import osm as O
from terrasift.sources import rest


def test_sniff():
    assert S.sniff("a.csv", b"x") == "csv" and S.sniff("a", b"PK\3\4") == "shp" and S.sniff("a", b"SQLite format 3\0") == "gpkg" and S.sniff("a", b' {"type"') == "geojson"
    with pytest.raises(S.NotData):
        S.sniff("a.csv", b"\n<!DOCTYPE html>")


def test_delimited(spark, tmp_path):
    (tmp_path / "a.csv").write_text("NAME,LAT,LON,STATE\nA,45.5,-93,MN\n\nB,x,-93,MN\nC,46,-94\nD,95,-94,MN\n")
    rows = S.delimited(spark, str(tmp_path / "a.csv"), lat="LAT", lon="LON").collect()
    assert sorted((r.NAME, r.lat, r.lon, r.STATE) for r in rows) == [("A", 45.5, -93.0, "MN"), ("C", 46.0, -94.0, "")]
    (tmp_path / "b.txt").write_text("1|45|30|0|N|92|54|0|W\n2|x|0|0|N|1|0|0|E\n3|45|30|0|S|92|54|0|E\n")
    names = ["REC", "a", "b", "c", "d", "e", "f", "g", "h"]
    rows = S.delimited(spark, str(tmp_path / "b.txt"), sep="|", header=names, dms_fields=tuple(names[1:])).collect()
    assert sorted((r.REC, r.lat, round(r.lon, 6)) for r in rows) == [("1", 45.5, -92.9), ("3", -45.5, 92.9)]


def test_geojson_and_asr(spark, tmp_path):
    f = {"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": {"type": "Point", "coordinates": [1, 2]}, "properties": {"a": "x", "n": 3}}, {"type": "Feature", "geometry": None, "properties": {}}]}
    (tmp_path / "a.geojson").write_text(json.dumps(f))
    rows = S.geojson(spark, str(tmp_path / "a.geojson")).collect()
    assert [(r.ord, r.geom_type, r.coordinates, r.properties) for r in rows] == [(0, "Point", "[1,2]", {"a": "x", "n": "3"}), (1, None, None, {})]
    (tmp_path / "RA.dat").write_bytes("RA|1|caf\xe9 \"x\"|\n".encode("latin-1"))
    assert S.asr(spark, str(tmp_path / "RA.dat"), ["t", "u", "n", "z"]).first().asDict() == {"t": "RA", "u": "1", "n": 'caf\xe9 "x"', "z": ""}


def test_xlsx(spark, tmp_path):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    sheet = f'<worksheet {ns}><sheetData><row r="2"><c r="A2" t="s"><v>0</v></c><c r="C2" t="inlineStr"><is><t>H</t></is></c></row><row r="4"><c r="A4"><v>7</v></c><c r="B4"><v>9</v></c><c r="C4"><v>1.5</v></c></row></sheetData></worksheet>'
    with zipfile.ZipFile(tmp_path / "a.xlsx", "w") as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>Na</t><t>me</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", sheet)
    assert [r.properties for r in S.xlsx(spark, str(tmp_path / "a.xlsx"), header_row=2).collect()] == [{"Name": "7", "H": "1.5"}]
    assert S.column_index("AA7") == 26


def wkb_point(x, y):
    return struct.pack("<BIdd", 1, 1, x, y)


def test_gpkg_and_wkb(spark, tmp_path):
    p = tmp_path / "a.gpkg"
    con = sqlite3.connect(p)
    con.execute("CREATE TABLE gpkg_geometry_columns (table_name, column_name, srs_id)")
    con.execute("INSERT INTO gpkg_geometry_columns VALUES ('dams', 'geom', 4326)")
    con.execute("CREATE TABLE dams (fid INTEGER, name, height, geom)")
    head = b"GP\0\1" + struct.pack("<i", 4326)
    con.execute("INSERT INTO dams VALUES (1, 'A', 60, ?), (2, 'B', NULL, ?)", (head + wkb_point(-93, 45), b"GP\0\x11" + struct.pack("<i", 4326)))
    con.commit()
    con.close()
    rows = S.gpkg(spark, str(p)).orderBy("ord").collect()
    assert [(r.geom_type, r.coordinates, r.properties["name"], r.properties["height"]) for r in rows] == [("Point", "[-93.0, 45.0]", "A", "60"), (None, None, "B", None)]
    z = struct.pack(">BIddd", 0, 1001, 1, 2, 9)
    assert S.read_wkb(z)[0] == {"type": "Point", "coordinates": [1.0, 2.0]}
    many = struct.pack("<BII", 1, 4, 2) + wkb_point(0, 1) + wkb_point(2, 3)
    assert S.read_wkb(many)[0] == {"type": "MultiPoint", "coordinates": [[0.0, 1.0], [2.0, 3.0]]}


def test_shapefile(spark, tmp_path):
    ring = [(0, 0), (0, 2), (2, 2), (2, 0), (0, 0)]
    body = struct.pack("<i4d2i", 5, 0, 0, 2, 2, 1, 5) + struct.pack("<i", 0) + b"".join(struct.pack("<2d", *p) for p in ring)
    shp = b"\0" * 100 + struct.pack(">2i", 1, len(body) // 2) + body
    dbf = struct.pack("<4BIHH20x", 3, 0, 0, 0, 1, 32 + 32 + 1, 6) + b"NAME".ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([5]) + b"\0" * 15 + b"\r" + b" AB   "
    for name, prj in (("ok", "GEOGCS[...]"), ("bad", "PROJCS[...]")):
        with zipfile.ZipFile(tmp_path / f"{name}.zip", "w") as z:
            for ext, data in (("shp", shp), ("dbf", dbf), ("prj", prj)):
                z.writestr(f"a.{ext}", data)
    [r] = S.shp(spark, str(tmp_path / "ok.zip")).collect()
    assert r.geom_type == "Polygon" and json.loads(r.coordinates)[0][1] == [0.0, 2.0] and r.properties == {"NAME": "AB"}
    with pytest.raises(S.NotData):
        list(S.shp_raw((tmp_path / "bad.zip").read_bytes()))


def test_esri():
    assert S.esri_geometry({"x": 1, "y": 2}) == ("Point", [1.0, 2.0]) and S.esri_geometry({"x": "NaN", "y": 2}) == (None, None)
    outer, hole = [[0, 0], [0, 9], [9, 9], [9, 0]], [[1, 1], [2, 1], [2, 2], [1, 2], [1, 1]]
    kind, where = S.esri_geometry({"rings": [outer, hole, [[0, 0], [1, 1]]]})
    assert kind == "Polygon" and len(where) == 2 and where[0][0] == where[0][-1]
    assert S.esri_geometry({"paths": [[[0, 0], [1, 1]]]}) == ("LineString", [[0, 0], [1, 1]])


def test_kml(spark, tmp_path):
    k = '<kml xmlns="x"><Document><Folder><name>F</name><Placemark><name>A</name><ExtendedData><Data name="k"><value>v</value></Data><SchemaData><SimpleData name="s"> w </SimpleData></SchemaData></ExtendedData><Point><coordinates> -93,45,0 </coordinates></Point></Placemark></Folder><Placemark/></Document></kml>'
    with zipfile.ZipFile(tmp_path / "a.kmz", "w") as z:
        z.writestr("doc.kml", k)
    (tmp_path / "b.kml").write_text("<broken")
    rows = S.kml(spark, str(tmp_path / "*.km?")).orderBy("path", "ord").collect()
    assert [(r.name, r.folder, r.lon, r.fields) for r in rows[:2]] == [("A", "F", -93.0, {"k": "v", "s": "w"}), (None, None, None, {})] and rows[2].error


def test_nwr(spark, tmp_path):
    (tmp_path / "a.js").write_text('// x\nvar cclData = [{"callsign":"WXM99","counties":[{"same":"027123","county":"R","st":"MN"},{"same":"","county":"S","st":"WI"}]}];\n')
    [r] = S.nwr_stations(spark, str(tmp_path / "a.js")).collect()
    assert r.callsign == "WXM99" and [c.st for c in r.counties] == ["MN", "WI"]


def serve(url, params):
    n = 7
    if params.get("meta"):
        return {"maxRecordCount": 3}
    if params.get("returnCountOnly"):
        return {"count": n}
    if params.get("returnIdsOnly"):
        return {"objectIds": [9 - i for i in range(n)], "objectIdFieldName": "OID"}
    at = range(int(params["resultOffset"]), min(n, int(params["resultOffset"]) + int(params["resultRecordCount"]))) if "resultOffset" in params else range(*map(int, params["where"].split("BETWEEN ")[1].split(" AND ")))
    return {"features": [{"attributes": {"OID": i, "n": None}, "geometry": {"x": i, "y": 1}} for i in at]}


def test_feature_service(spark):
    spark.dataSource.register(rest.FeatureService)
    rest.TRANSPORTS["test"] = serve
    pages = rest.ServiceReader({"url": "u", "transport": "test", "page": "50"})
    assert [p.params["resultOffset"] for p in pages.partitions()] == [0, 3, 6]
    rows = [r for p in pages.partitions() for r in pages.read(p)]
    assert [json.loads(r[2])[0] for r in rows] == list(map(float, range(7))) and rows[0][3] == {"OID": "0", "n": None}
    ids = rest.ServiceReader({"url": "u", "transport": "test", "by": "ids", "where": "a = 1"}).partitions()
    assert [p.params["where"] for p in ids] == ["(a = 1) AND OID BETWEEN 3 AND 5", "(a = 1) AND OID BETWEEN 6 AND 8", "(a = 1) AND OID BETWEEN 9 AND 9"]
    assert rest.where_for({"where_by_aoi": {"state": "S"}, "where": "W"}, "county") == "S" and rest.where_for({}, "us") == "1=1"
    assert rest.pick_layer([{"id": 0, "type": "Group Layer", "name": "dams"}, {"id": 4, "name": "Big Dams"}], None, "dam") == 4


def test_osm(spark):
    a, b, c, d = [0.0, 0.0], [0.0, 1.0], [1.0, 1.0], [1.0, 0.0]
    rings, whole = O.stitch([[a, b], [d, c, b], [a, d]])
    assert whole and len(rings) == 1 and rings[0][0] == rings[0][-1] and len(rings[0]) == 5
    assert O.stitch([[a, b], [c, d]]) == ([], False)
    assert O.is_area({"building": "yes"}, True) and not O.is_area({"power": "line"}, True) and not O.is_area({"building": "yes", "area": "no"}, True)
    g = lambda *pts: [{"lat": float(y), "lon": float(x)} for x, y in pts]
    rows = [
        ("node", 1, 45.0, -93.0, {"name": "n"}, None, None, 0),
        ("way", 2, None, None, {"building": "yes", "phone": "1"}, g((0, 0), (0, 1), (1, 1), (0, 0)), None, 1),
        ("relation", 3, None, None, {"type": "multipolygon"}, None, [{"type": "way", "role": "outer", "geometry": g((0, 0), (0, 1), (1, 1))}, {"type": "way", "role": "outer", "geometry": g((0, 0), (1, 1))}], 2),
        ("node", 1, 46.0, -93.0, {"name": "later"}, None, None, 3),
    ]
    e = spark.createDataFrame(rows, O.ELEMENT + ", ord long")
    one = O.union_tiles(e)
    assert {(r.type, r.id): (r.lat, r.place) for r in one.collect()}[("node", 1)] == (46.0, 0)
    f = O.features(one, "both").collect()
    assert sorted((r.osm_type, r.shape, r.geom_type) for r in f if r.osm_id != 1) == [("relation", "marker", "Point"), ("relation", "shape", "Polygon"), ("way", "marker", "Point"), ("way", "shape", "Polygon")]
    p = {r.osm_id: (r.name, r.phone) for r in O.row_projection(O.features(one)).collect()}
    assert p == {1: ("later", None), 2: ("(unnamed)", "1"), 3: ("(unnamed)", None)}


