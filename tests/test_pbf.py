import json
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrasift.sources import osm, pbf


def num(v):
    v &= (1 << 64) - 1
    out = b""
    while v > 127:
        out, v = out + bytes([v & 127 | 128]), v >> 7
    return out + bytes([v])


def zig(v):
    return v * 2 if v >= 0 else -v * 2 - 1


def field(k, v):
    return num(k << 3) + num(v) if isinstance(v, int) else num(k << 3 | 2) + num(len(v)) + v


def packed(vs):
    return b"".join(map(num, vs))


def deltas(vs):
    return packed(zig(b - a) for a, b in zip([0, *vs], vs, strict=False))


def block(texts, *groups, extra=b""):
    return field(1, b"".join(field(1, t) for t in texts)) + b"".join(field(2, g) for g in groups) + extra


def blob(kind, data, packing="zlib"):
    body = field(1, data) if packing == "raw" else field(2, len(data)) + field(3 if packing == "zlib" else 4, zlib.compress(data))
    head = field(1, kind) + field(3, len(body))
    return struct.pack(">I", len(head)) + head + body


@pytest.fixture
def extract(tmp_path):
    texts = [b"", b"building", b"yes", b"type", b"multipolygon", b"outer", b"name", "Älk".encode()]
    at = [(1, 45.0, -93.0), (2, 45.0, -92.0), (5, 46.0, -92.0), (9, 46.0, -93.0)]
    dense = field(1, deltas([i for i, _, _ in at])) + field(8, deltas([int(y * 1e7) for _, y, _ in at])) + field(9, deltas([int(x * 1e7) for _, _, x in at])) + field(10, packed([0, 0, 6, 7, 0, 0]))
    lone = field(1, zig(-7)) + field(2, packed([6])) + field(3, packed([7])) + field(8, zig(3)) + field(9, zig(-4))
    ways = [(20, [1, 2, 5, 9, 1], [1], [2]), (21, [1, 2, 5], [], []), (22, [5, 9, 1, 404], [], [])]
    way = b"".join(field(3, field(1, i) + field(2, packed(k)) + field(3, packed(v)) + field(8, deltas(r))) for i, r, k, v in ways)
    rel = field(4, field(1, 30) + field(2, packed([3])) + field(3, packed([4])) + field(8, packed([5, 5, 0])) + field(9, deltas([21, 22, 5])) + field(10, packed([1, 1, 0])))
    path = tmp_path / "x.osm.pbf"
    path.write_bytes(blob(b"OSMHeader", b"") + blob(b"OSMData", block(texts, way, rel), "raw") + blob(b"OSMData", block(texts, field(2, dense))) + blob(b"OSMData", block(texts, field(1, lone), extra=field(17, 1000) + field(19, -2_000_000_000) + field(20, 5_000_000_000))))
    return str(path)


def test_extract(spark, extract):
    raw = pbf.raw_elements(spark, extract)
    rows = {(r.type, r.id): r for r in raw.collect()}
    assert len(rows) == 9 and rows["node", 5].tags == {"name": "Älk"} and rows["node", 9].tags == {}
    assert (rows["node", 9].lat, rows["node", 9].lon) == (46.0, -93.0)
    assert np.allclose((rows["node", -7].lat, rows["node", -7].lon), (-2 + 3e-6, 5 - 4e-6)) and rows["node", -7].tags == {"name": "Älk"}
    assert rows["way", 22].refs == [5, 9, 1, 404] and [tuple(m) for m in rows["relation", 30].members] == [("way", 21, "outer"), ("way", 22, "outer"), ("node", 5, "")]
    found = pbf.elements(raw, F.size(F.map_keys("tags")) > 0)
    shapes = {(r.osm_type, r.osm_id): (r.geom_type, json.loads(r.coordinates)) for r in osm.features(found).collect()}
    ring = [[-93.0, 45.0], [-92.0, 45.0], [-92.0, 46.0], [-93.0, 46.0]]
    assert set(shapes) == {("node", 5), ("node", -7), ("way", 20), ("relation", 30)}
    assert shapes["way", 20] == ("Polygon", [[*ring, ring[0]]])
    assert shapes["relation", 30][0] == "Polygon" and sorted(set(map(tuple, shapes["relation", 30][1][0]))) == sorted(map(tuple, ring))
    assert osm.features(pbf.elements(raw, F.lit(False))).collect() == []


def test_blobs_that_are_not_needed_are_not_decoded(spark, tmp_path):
    """Ten blobs of nodes, of which ways use two and one has a tag; the result is that of reading everything."""
    texts = [b"", b"name", b"x", b"highway", b"track"]
    data = blob(b"OSMHeader", b"")
    for k in range(10):
        ids = range(100 * k, 100 * k + 50)
        tags = [v for i in ids for v in ((1, 2, 0) if i == 707 else (0,))]
        dense = field(1, deltas(list(ids))) + field(8, deltas([int((45 + i / 1000) * 1e7) for i in ids])) + field(9, deltas([int((-93 + i / 1000) * 1e7) for i in ids])) + field(10, packed(tags))
        data += blob(b"OSMData", block(texts, field(2, dense)))
    ways = b"".join(field(3, field(1, i) + field(2, packed([3])) + field(3, packed([4])) + field(8, deltas(r))) for i, r in ((1, [201, 202, 249]), (2, [405, 249]), (3, [460, 470])))
    data += blob(b"OSMData", block(texts, ways))
    path = tmp_path / "n.osm.pbf"
    path.write_bytes(data)
    places = pbf.blobs(str(path))
    wanted = F.size(F.map_keys("tags")) > 0
    found, read = pbf.extract(spark, str(path), wanted)
    assert read == [places[2], places[4], places[7], places[10]]
    key = lambda df: sorted((r.type, r.id, r.lat, r.lon, r.geometry) for r in df.collect())
    assert key(found) == key(pbf.elements(pbf.raw_elements(spark, str(path)), wanted)) and found.count() == 4
    ways, read = pbf.extract(spark, str(path), wanted, nodes_too=False, box=(-92.6, 45.4, -92.5, 45.5))
    assert [(r.type, r.id) for r in ways.collect()] == [("way", 2)] and places[7] not in read
    held = {(r.kind, r.least, r.most): (r.n, r.tagged) for r in pbf.statistics(spark, str(path)).collect()}
    assert held["way", 1, 3] == (3, 3) and held["node", 700, 749] == (50, 1) and held["node", 0, 49] == (50, 0)


def test_unknown_packing(tmp_path):
    with pytest.raises(ValueError):
        pbf.unpacked(blob(b"OSMData", b"x", "lzma")[4 + len(field(1, b"OSMData") + field(3, len(field(2, 1) + field(4, zlib.compress(b"x"))))) :])


def test_numbers():
    vs = [0, 1, -1, 127, 128, -(2**40), 2**62, -(2**63)]
    assert pbf.signed(pbf.varints(packed(map(zig, vs)))).tolist() == vs and len(pbf.varints(b"")) == 0
