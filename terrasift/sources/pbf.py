"""Elements of OpenStreetMap extracts in the PBF format.

A file is a row of blobs. The driver reads their headers only; each task decodes blobs, a few megabytes each, from their places in the file. Places of ways and
of relations' members are joined to them afterwards, as nodes may stand in any blob. ``extract`` first asks each blob what it holds (kinds, ranges of ids, whether nodes have tags), which builds no rows, and
then decodes ways and relations, and of the nodes' blobs those alone that a wanted id falls into or whose nodes have tags.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrasift.operators.lineage import cut

RAW = "type string, id long, lat double, lon double, tags map<string,string>, refs array<long>, members array<struct<type:string,ref:long,role:string>>"
_ARROW = pa.schema(
    [("type", pa.string()), ("id", pa.int64()), ("lat", pa.float64()), ("lon", pa.float64()), ("tags", pa.map_(pa.string(), pa.string())), ("refs", pa.list_(pa.int64()))]
    + [("members", pa.list_(pa.struct([("type", pa.string()), ("ref", pa.int64()), ("role", pa.string())])))]
)
KINDS = ("node", "way", "relation")


def varints(data: bytes) -> np.ndarray:
    """Packed numbers of any length."""
    b = np.frombuffer(data, np.uint8)
    end = np.nonzero(b < 128)[0]
    if not len(end):
        return np.empty(0, np.uint64)
    start = np.concatenate(([0], end[:-1] + 1))
    b = b[: end[-1] + 1]
    place = np.arange(len(b)) - np.repeat(start, end - start + 1)
    return np.add.reduceat((b & 127).astype(np.uint64) << (7 * place).astype(np.uint64), start)


def signed(v: np.ndarray) -> np.ndarray:
    """Numbers whose last bit is their sign."""
    return (v >> np.uint64(1)).astype(np.int64) ^ -(v & np.uint64(1)).astype(np.int64)


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a message."""
    at, n = 0, len(data)

    def number() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < n:
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
        elif key & 7 == 2:
            size = number()
            yield key >> 3, data[at : at + size]
            at += size
        else:
            at += {1: 8, 5: 4}[key & 7]


def blobs(path: str) -> list[tuple[int, int]]:
    """Place and size of each blob of data. An extract of the planet has some 50,000."""
    where, name = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))
    out, at = [], 0
    with where.open_input_file(name) as f:
        while at < f.size():
            f.seek(at)
            (n,) = struct.unpack(">I", f.read(4))
            head = dict(fields(f.read(n)))
            at += 4 + n
            if head[1] == b"OSMData":
                out.append((at, head[3]))
            at += head[3]
    return out


def unpacked(blob: bytes) -> bytes:
    parts = dict(fields(blob))
    if 1 in parts:
        return parts[1]
    if 3 not in parts:
        raise ValueError("blobs are read raw or zlib-compressed only")
    return zlib.decompress(parts[3])


def block_rows(data: bytes) -> Iterator[tuple]:
    """Rows of RAW of one block."""
    texts, groups, unit, south, west = [], [], 100, 0, 0
    for k, v in fields(data):
        if k == 1:
            texts = [t.decode(errors="replace") for _, t in fields(v)]
        elif k == 2:
            groups.append(v)
        elif k == 17:
            unit = v
        elif k in (19, 20):
            v = v - (1 << 64) if v >> 63 else v
            south, west = (v, west) if k == 19 else (south, v)
    degrees = lambda v, offset: (offset + unit * v) / 1e9
    tags = lambda m: [(texts[a], texts[b]) for a, b in zip(varints(m.get(2, b"")), varints(m.get(3, b"")), strict=True)]
    whole = lambda v: v - (1 << 64) if v >> 63 else v
    for group in groups:
        for k, body in fields(group):
            m = dict(fields(body)) if k < 5 else {}
            if k == 1:
                node, lat, lon = (int(signed(np.array([m.get(i, 0)], np.uint64))[0]) for i in (1, 8, 9))
                yield "node", node, degrees(lat, south), degrees(lon, west), tags(m), None, None
            elif k == 2:
                ids, lats, lons = (np.cumsum(signed(varints(m.get(i, b"")))).tolist() for i in (1, 8, 9))
                pairs = iter(varints(m.get(10, b"")).tolist())
                for node, lat, lon in zip(ids, lats, lons, strict=True):
                    own = []
                    while key := next(pairs, 0):
                        own.append((texts[key], texts[next(pairs)]))
                    yield "node", node, degrees(lat, south), degrees(lon, west), own, None, None
            elif k == 3:
                yield "way", whole(m[1]), None, None, tags(m), np.cumsum(signed(varints(m.get(8, b"")))).tolist(), None
            elif k == 4:
                refs = np.cumsum(signed(varints(m.get(9, b"")))).tolist()
                members = [{"type": KINDS[t], "ref": r, "role": texts[s]} for t, r, s in zip(varints(m.get(10, b"")), refs, varints(m.get(8, b"")), strict=True)]
                yield "relation", whole(m[1]), None, None, tags(m), None, members


def block_holds(data: bytes) -> Iterator[tuple[str, int, int, int, int]]:
    """What a block has of each kind: kind, how many, least and greatest id, how many have tags (for ways and relations all count)."""
    seen: dict[str, list[np.ndarray]] = {}
    tagged = dict.fromkeys(KINDS, 0)
    for k, group in fields(data):
        for kind, body in fields(group) if k == 2 else ():
            if kind == 2:
                m = dict(fields(body))
                ids = np.cumsum(signed(varints(m.get(1, b""))))
                # Tags of dense nodes are pairs of numbers with a 0 after each node's: what there is besides the zeros are pairs.
                tagged["node"] += int((varints(m.get(10, b"")) > 0).any())
                seen.setdefault("node", []).append(ids)
            elif kind in (1, 3, 4):
                m = dict(fields(body))
                own = int(signed(np.array([m.get(1, 0)], np.uint64))[0]) if kind == 1 else m[1] - (1 << 64) if m[1] >> 63 else m[1]
                name = "node" if kind == 1 else KINDS[kind - 2]
                tagged[name] += kind > 1 or 2 in m
                seen.setdefault(name, []).append(np.array([own]))
    for name, ids in seen.items():
        every = np.concatenate(ids)
        if len(every):
            yield name, len(every), int(every.min()), int(every.max()), tagged[name]


def _opened(path: str):
    where, name = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))
    return where.open_input_file(name)


def statistics(spark: SparkSession, path: str) -> DataFrame:
    """at, size, kind, n, least, most, tagged: what each blob holds of each kind. Blobs are unpacked for it, but no element is built."""
    schema = "at long, size long, kind string, n long, least long, most long, tagged long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _opened(path) as f:
            for batch in batches:
                for at, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    f.seek(at)
                    rows = [(at, size, *held) for held in block_holds(unpacked(f.read(size)))]
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if i == 2 else pa.int64()) for i, c in enumerate(zip(*rows, strict=True))], [c.split()[0] for c in schema.split(", ")])

    found = blobs(path)
    return spark.createDataFrame(found, "at long, size long").repartition(max(1, min(len(found), 10_000)), "at").mapInArrow(run, schema)


def wanted_blobs(nodes: list[tuple[int, int, int, int]], refs: DataFrame) -> list[tuple[int, int]]:
    """at and size of the nodes' blobs (at, size, least, most) that an id of refs falls into. Ranges that overlap, as in files that are not in order, are told apart by nothing, so all of them count; refs are told by
    the intervals between the ranges' ends, of which there are as many as blobs."""
    ends = np.unique(np.array([x for _, _, lo, hi in nodes for x in (lo, hi + 1)], np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hit: set[int] = set()
        for batch in batches:
            hit.update(np.unique(np.searchsorted(ends, batch.column(0).to_numpy(), "right")).tolist())
        yield pa.RecordBatch.from_arrays([pa.array(sorted(hit), pa.int64())], ["slot"])

    slots = np.array(sorted(r.slot for r in refs.select("ref").where("ref IS NOT NULL").mapInArrow(run, "slot long").distinct().collect()), np.int64)
    first, last = (np.searchsorted(ends, [v[k] for v in nodes], "right") for k in (2, 3))
    some = np.searchsorted(slots, first, "left") < np.searchsorted(slots, last, "right")
    return [(at, size) for (at, size, _, _), yes in zip(nodes, some, strict=True) if yes]


def raw_elements(spark: SparkSession, path: str, places: list[tuple[int, int]] | None = None) -> DataFrame:
    """RAW's columns, a row an element, in no order, of all blobs or those at some places (at, size). Its path must be readable by every worker."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _opened(path) as f:
            for batch in batches:
                for at, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    f.seek(at)
                    rows = list(block_rows(unpacked(f.read(size))))
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ARROW.types, strict=True)], schema=_ARROW)

    found = blobs(path) if places is None else places
    rows = spark.createDataFrame(found, "at long, size long").repartition(max(1, min(len(found), 10_000)), "at")
    return rows.mapInArrow(run, RAW)


def extract(spark: SparkSession, path: str, wanted: Column, nodes_too: bool = True, box: tuple[float, float, float, float] | None = None) -> tuple[DataFrame, list[tuple[int, int]]]:
    """The elements whose tags are wanted, and the places of the blobs that were decoded for them. nodes_too: nodes with tags are asked for as well. box: only elements with a place in it.

    Nodes without tags are no elements of their own, whatever wanted says.
    """
    held = cut(statistics(spark, path), "blobs").collect()
    rest = sorted({(r.at, r.size) for r in held if r.kind != "node"})
    ways = cut(raw_elements(spark, path, rest).where("type <> 'node'"), "ways")
    chosen = ways.where(wanted)
    members = chosen.where("type = 'relation'").select(F.explode("members").alias("m")).where("m.type = 'way'").select(F.col("m.ref").alias("id")).distinct()
    used = ways.where("type = 'way'").join(members, "id", "left_semi").select("refs").unionByName(chosen.where("type = 'way'").select("refs"))
    refs = cut(used.select(F.explode("refs").alias("ref")).distinct(), "refs")
    nodes = [(r.at, r.size, r.least, r.most) for r in held if r.kind == "node"]
    places = set(wanted_blobs(nodes, refs)) | {(r.at, r.size) for r in held if r.kind == "node" and r.tagged and nodes_too}
    node = raw_elements(spark, path, sorted(places)).where("type = 'node'")
    node = cut(node.join(refs.withColumnRenamed("ref", "id").withColumn("used", F.lit(True)), "id", "left").where(F.col("used") | (F.size(F.map_keys("tags")) > 0)).drop("used"), "nodes")
    own = wanted & ((F.col("type") != "node") | (F.lit(nodes_too) & (F.size(F.map_keys("tags")) > 0)))
    found = elements(ways.unionByName(node.select(ways.columns)), own)
    if box is not None:
        within = lambda p: p.lon.between(box[0], box[2]) & p.lat.between(box[1], box[3])
        some = lambda c: F.coalesce(F.exists(c, lambda p: F.coalesce(within(p), F.lit(False))), F.lit(False))
        here = F.col("lon").between(box[0], box[2]) & F.col("lat").between(box[1], box[3])
        found = found.where(F.coalesce(here, F.lit(False)) | some(F.col("geometry")) | F.coalesce(F.exists("members", lambda m: some(m.geometry)), F.lit(False)))
    return found, sorted({*rest, *places})


def elements(raw: DataFrame, wanted: Column) -> DataFrame:
    """The elements whose tags are wanted, as osm.features takes them: ways with their places in order, relations with their ways' places.

    Unknown nodes are left out, as extracts cut ways at their edge. Equal elements (by type and id) must come once. raw is read
    several times, so a large extract is better written as a table first.
    """
    chosen = raw.where(wanted)
    parts = chosen.where("type = 'relation'").select("id", F.posexplode("members").alias("n", "m")).select("id", "n", "m.*")
    needed = raw.where("type = 'way'").join(parts.where("type = 'way'").select(F.col("ref").alias("id")).distinct(), "id", "left_semi")
    node = raw.where("type = 'node'").select(F.col("id").alias("ref"), F.struct("lat", "lon").alias("p"))
    used = chosen.where("type = 'way'").select("id", "refs").unionByName(needed.select("id", "refs")).dropDuplicates(["id"])
    at = used.select("id", F.posexplode("refs").alias("n", "ref")).join(node, "ref").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("n", "p"))).alias("g"))
    lines = at.select(F.col("id").alias("ref"), F.col("g.p").alias("geometry"))
    ways = chosen.where("type = 'way'").drop("members").join(lines.withColumnRenamed("ref", "id"), "id", "left")
    own = parts.join(lines.withColumn("type", F.lit("way")), ["type", "ref"], "left").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("n", "type", "role", "geometry"))).alias("m"))
    relations = chosen.where("type = 'relation'").drop("members").join(own, "id", "left")
    cols = ["type", "id", "lat", "lon", "tags"]
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    line, member = "array<struct<lat:double,lon:double>>", "array<struct<type:string,role:string,geometry:array<struct<lat:double,lon:double>>>>"
    out = chosen.where("type = 'node'").select(*cols, none(line, "geometry"), none(member, "members")).unionByName(ways.select(*cols, "geometry", none(member, "members")))
    return out.unionByName(relations.select(*cols, none(line, "geometry"), F.transform("m", lambda m: F.struct(m["type"].alias("type"), m["role"].alias("role"), m["geometry"].alias("geometry"))).alias("members")))
