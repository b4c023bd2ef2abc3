"""Feature services as a Spark data source: one input partition a page or range of ids; the predicate and the area go to the server as options.

The transport is a function of the query's parameters, so tests and other clients bring their own; it is pickled to the executors.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from terrasift.sources.fetch import Client
from terrasift.sources.files import esri_geometry

Transport = Callable[[str, dict], dict]


@lru_cache(maxsize=1)
def _client() -> Client:
    """The client of a process: retries, pauses and the number of requests at once hold for all of its pages."""
    return Client(gap=0.2)


def http_transport(url: str, params: dict) -> dict:
    return _client().json(url, params, cached=False)


TRANSPORTS: dict[str, Transport] = {"http": http_transport}


def where_for(spec: dict, kind: str) -> str:
    """the predicate for an area's kind; a county falls back to its state's, then to the general one."""
    by = spec.get("where_by_aoi") or {}
    return by.get(kind) or (by.get("state") if kind == "county" else None) or spec.get("where") or "1=1"


def envelope(box: tuple[float, float, float, float] | None) -> dict:
    """the area as an intersection with its box."""
    if box is None:
        return {}
    return {"geometry": ",".join(map(str, box)), "geometryType": "esriGeometryEnvelope", "inSR": 4326, "spatialRel": "esriSpatialRelIntersects"}


def pick_layer(layers: list[dict], layer_id: int | None, match: str | None) -> int:
    """The given layer, else the first one that is no group and whose name matches."""
    import re

    if layer_id is not None:
        return layer_id
    for x in layers:
        if x.get("type") != "Group Layer" and re.search(match or "", x.get("name", ""), re.I):
            return x["id"]
    raise LookupError(f"no layer matches {match!r}")


@dataclass
class Page(InputPartition):
    number: int
    params: dict


class FeatureService(DataSource):
    """format("feature_service"): options url, transport (a name in TRANSPORTS or module:function), layer, where, box, page, by (offset or ids)."""

    @classmethod
    def name(cls) -> str:
        return "feature_service"

    def schema(self) -> str:
        return "ord long, geom_type string, coordinates string, properties map<string,string>"

    def reader(self, schema: StructType) -> DataSourceReader:
        return ServiceReader(dict(self.options))


class ServiceReader(DataSourceReader):
    def __init__(self, options: dict):
        self.o = options
        self.url = f"{options['url']}/{options.get('layer', '0')}/query"
        box = options.get("box")
        self.base = {"where": options.get("where", "1=1"), "outFields": options.get("fields", "*"), "outSR": 4326, "f": "json", **envelope(tuple(map(float, box.split(","))) if box else None)}

    def call(self, params: dict) -> dict:
        name = self.o.get("transport", "http")
        if ":" in name:
            import importlib

            module, _, attr = name.partition(":")
            return getattr(importlib.import_module(module), attr)(self.url, params)
        return TRANSPORTS[name](self.url, params)

    def partitions(self) -> list[InputPartition]:
        """Pages of the server's size by offset, or ranges of sorted ids."""
        meta = self.call({"f": "json", "meta": "1"})
        size = max(1, min(int(self.o.get("page", 1000)), int(meta.get("maxRecordCount", 1000))))
        if self.o.get("by") == "ids":
            got = self.call({**self.base, "returnIdsOnly": "true"})
            ids, field = sorted(got.get("objectIds") or []), got.get("objectIdFieldName", "OBJECTID")
            chunks = [ids[i : i + size] for i in range(0, len(ids), size)]
            return [Page(i, {**self.base, "where": f"({self.base['where']}) AND {field} BETWEEN {c[0]} AND {c[-1]}"}) for i, c in enumerate(chunks)]
        n = int(self.call({**self.base, "returnCountOnly": "true"}).get("count", 0))
        return [Page(i, {**self.base, "resultOffset": o, "resultRecordCount": size}) for i, o in enumerate(range(0, n, size))]

    def read(self, partition: Page) -> Iterator[tuple]:
        got = self.call(partition.params)
        if "error" in got:
            raise RuntimeError(f"page {partition.number}: {got['error']}")
        features = got.get("features", [])
        want = partition.params.get("resultRecordCount")
        if not features and want:
            raise RuntimeError(f"page {partition.number} is empty, but the count says otherwise: part of an answer is no answer")
        for i, f in enumerate(features):
            kind, where = esri_geometry(f.get("geometry")) if "attributes" in f else (f["geometry"]["type"], f["geometry"]["coordinates"]) if f.get("geometry") else (None, None)
            yield (partition.number * 1_000_000 + i, kind, None if where is None else json.dumps(where), {k: None if v is None else str(v) for k, v in (f.get("attributes") or f.get("properties") or {}).items()})


def repeated_pages(df):
    """S03's guard: pages that begin with the same record as the page before, by features' ordinals."""
    from pyspark.sql import Window as W
    from pyspark.sql import functions as F

    first = df.groupBy(F.floor(F.col("ord") / 1_000_000).alias("page")).agg(F.min_by(F.to_json(F.struct("coordinates", F.array_sort(F.map_entries("properties")))), "ord").alias("first"))
    return first.withColumn("same", F.col("first") == F.lag("first").over(W.orderBy("page"))).where("same")


class RepeatedPage(RuntimeError):
    """A server that gives the same page again has not given the rest."""


def unrepeated(rows):
    """Rows of a layer, if no page of it came twice."""
    again = repeated_pages(rows).select("page").limit(1).collect()
    if again:
        raise RepeatedPage(f"page {again[0].page} repeats the one before")
    return rows


def service_layer(spark, **options: str):
    """A service's layer, read once into the shared folder; an error if a page came twice."""
    from terrasift.operators.lineage import cut

    return unrepeated(cut(spark.read.format("feature_service").options(**options).load(), "service"))
