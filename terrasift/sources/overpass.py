"""OpenStreetMap queries: text of the query, scope of the area, tiles and their quarters, fetched over many tasks."""

from __future__ import annotations

import datetime as dt
import hashlib
import importlib
import json
import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrasift.catalog import Aoi, quarters, tiles
from terrasift.operators.lineage import cut, release, shared_dir
from terrasift.operators.predicates import any_selector
from terrasift.sinks.store import store
from terrasift.sources.fetch import Client, Mirrors, Refused
from terrasift.sources.osm import union_tiles

Box = tuple[float, float, float, float]
#: What a catalog may call a kind of element, and its name in queries.
KINDS = {"n": "node", "node": "node", "w": "way", "way": "way", "r": "rel", "rel": "rel", "relation": "rel", "nw": "nw", "nr": "nr", "wr": "wr", "nwr": "nwr"}
_CLAUSE = re.compile(r"\s*([^!<>=~]+?)\s*(>=|<=|!=|!~|=|~|<|>)\s*(.*?)\s*$")


def _quoted(text: str) -> str:
    return json.dumps(text, ensure_ascii=False)


def clauses(selector: str) -> tuple[str, bool]:
    """a selector's text for the server. Comparisons of numbers only ask for the key there; whether there are any is told."""
    out, numeric = "", False
    for part in filter(None, (p.strip() for p in selector.split(";"))):
        m = _CLAUSE.match(part)
        if m is None:
            out += f"[{_quoted(part)}]"
            continue
        key, op, value = m.groups()
        if op in ("<", ">", "<=", ">="):
            out, numeric = out + f"[{_quoted(key)}]", True
        else:
            out += f"[{_quoted(key)}{op}{_quoted(value)}]"
    if not out:
        raise ValueError(f"the selector {selector!r} would match everything")
    return out, numeric


def query_text(selectors: list[str], box: Box, elements: str = "nwr", seconds: int = 180, out: str = "geom", country: str | None = None) -> str:
    """The query for one tile, within a country's area if one is named."""
    if elements.strip().lower() not in KINDS:
        raise ValueError(f"{elements!r} is no kind of element")
    kind = KINDS[elements.strip().lower()]
    scope = f"({box[1]:.6f},{box[0]:.6f},{box[3]:.6f},{box[2]:.6f})"
    area = f'area["ISO3166-1"={_quoted(country)}]["admin_level"="2"]->.a;' if country else ""
    union = "".join(f"{kind}{clauses(s)[0]}{'(area.a)' if country else ''}{scope};" for s in selectors)
    return f"[out:json][timeout:{seconds}];{area}({union});out {out} qt;"


def lint_query(text: str) -> list[str]:
    """What a server would refuse, found before any request."""
    bad = []
    if not text.startswith("[out:json][timeout:"):
        bad.append("no [out:json][timeout:...] at the start")
    if text.count("(") != text.count(")") or text.count("[") != text.count("]"):
        bad.append("brackets do not match")
    if not re.search(r"\);out (geom|center|bb|body)( qt)?;$", text):
        bad.append("no output at the end")
    if "();" in text or re.search(r"(node|way|rel|nwr|nw|nr|wr)(\(area\.a\))?\(-?\d", text):
        bad.append("a part matches everything")
    return bad


def lint_classes(classes: list[tuple[str, list[str], str]], default_off: set[str], symbols: set[str]) -> list[str]:
    """What is wrong with a pack's classes (layer, selectors, label)."""
    names = [layer for layer, _, _ in classes]
    bad = [f"{n}: twice" for n in sorted({n for n in names if names.count(n) > 1})] + [f"{n}: switched off, but no class" for n in sorted(default_off - set(names))]
    for layer, selectors, label in classes:
        bad += [f"{layer}: no symbol"] * (layer not in symbols) + [f"{layer}: no label"] * (not label.strip()) + [f"{layer}: no selector"] * (not selectors)
        for s in selectors:
            try:
                bad += [f"{layer}: {x}" for x in lint_query(query_text([s], (0.0, 0.0, 1.0, 1.0)))]
            except ValueError as e:
                bad.append(f"{layer}: {e}")
    return bad


def country_box(mirrors: Mirrors, code: str, known: dict[str, Box | None]) -> Box:
    """A country's box, asked for once; ``known`` is the caller's memory of it."""
    if code not in known:
        got = mirrors.run(f'[out:json][timeout:60];rel["ISO3166-1"={_quoted(code)}]["admin_level"="2"];out bb;', 90.0)
        found = [e["bounds"] for e in got.get("elements", []) if e.get("bounds")]
        known[code] = tuple(found[0][k] for k in ("minlon", "minlat", "maxlon", "maxlat")) if found else None
    if known[code] is None:
        raise LookupError(f"no country {code}")
    return known[code]


def scope(aoi: Aoi, mirrors: Mirrors | None, step: float, most: int, known: dict[str, Box | None] | None = None) -> tuple[list[Box], str | None]:
    """An area's tiles, and the country that limits them. The whole world is refused."""
    if aoi.kind == "world":
        raise ValueError("the whole world is no area for tiles")
    country = aoi.id if aoi.kind == "country" and len(aoi.id) == 2 else None
    box = aoi.box or (country_box(mirrors, country, {} if known is None else known) if country and mirrors else None)
    if box is None:
        raise ValueError(f"{aoi.slug} has no box")
    return tiles(box, step, most), country


class Incomplete(RuntimeError):
    """Tiles that were not answered: the rest is no whole answer."""


#: Answers to a query, by name: (address, query, seconds) -> answer. Tests and other clients add theirs.
ASKS: dict[str, Callable[[str, str, float], dict]] = {}


@lru_cache(maxsize=1)
def _client() -> Client:
    """The client of a process, so that its pauses between requests hold for all of them."""
    return Client(tries=1, gap=1.0)


def ask_http(url: str, query: str, seconds: float) -> dict:
    return _client().json(url, body=b"data=" + quote(query, safe="").encode(), cached=False, timeout=seconds)


ASKS["http"] = ask_http


def _ask_of(name: str) -> Callable[[str, str, float], dict]:
    """What a name in ASKS, or module:function, stands for."""
    if ":" not in name:
        return ASKS[name]
    module, _, attr = name.partition(":")
    return getattr(importlib.import_module(module), attr)


@dataclass
class TileJob:
    """A tile to be fetched: how many tiles it was split from may still be, and which mirrors were too slow for it or failed."""

    number: int
    box: Box
    depth: int
    slow: set[int] = field(default_factory=set)
    failed: set[int] = field(default_factory=set)

    def mirror(self, ready: list[int], n: int) -> int | None:
        """The next mirror for this tile, beginning with another one for each tile."""
        order = sorted(ready, key=lambda m: (m - self.number) % n)
        return next((m for m in order if m not in self.slow | self.failed), None)


_RESULT = "number int, depth int, mirror int, key string, status string, wait double, element string"


def _asked(url: str, query: str, ask: Callable[[str, str, float], dict], seconds: float) -> tuple[str, float, list[dict]]:
    """What came of one request: its status (ok, slow, rest, failed), how long the mirror wants rest, the elements."""
    try:
        answer = ask(url, query, seconds)
        remark = str(answer.get("remark", "")).lower()
        if remark.startswith("runtime error"):
            return ("slow" if "timed out" in remark else "failed"), 0.0, []
        return "ok", 0.0, answer.get("elements", [])
    except Refused as e:
        return ("rest", e.wait or 60.0, []) if e.status == 429 else ("slow" if e.status == 504 else "failed", 0.0, [])
    except TimeoutError:
        return "slow", 0.0, []
    except (OSError, ValueError, RuntimeError):
        return "failed", 0.0, []


def _ask_queues(spark: SparkSession, rows: list[tuple], hosts: int, ask: str, seconds: float, end: float, dead_after: int = 2) -> DataFrame:
    """One round: queue, number, depth, mirror, url, key, query. A queue is one host's and one task's, so no two tasks ask a host at once.

    A queue ends early when its host asks for rest, fails ``dead_after`` times running, or the shared time is over: what it has not asked comes back as ``open``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, running = _ask_of(ask), {}
        for batch in batches:
            for queue, number, depth, mirror, url, key, query in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                left = end - time.time()
                if left <= 0 or running.get(queue, 0) >= dead_after:
                    status, wait, elements = "open", 0.0, []
                else:
                    status, wait, elements = _asked(url, query, own, min(seconds, left))
                    running[queue] = dead_after if status == "rest" else running.get(queue, 0) + 1 if status == "failed" else 0
                found = [json.dumps(e) for e in elements] or [None]
                n = len(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v] * n, t) for v, t in ((number, pa.int32()), (depth, pa.int32()), (mirror, pa.int32()), (key, pa.string()), (status, pa.string()), (wait, pa.float64()))] + [pa.array(found, pa.string())], [c.split()[0] for c in _RESULT.split(", ")]
                )

    jobs = spark.createDataFrame(rows, "queue int, number int, depth int, mirror int, url string, key string, query string")
    dealt = jobs.repartitionByRange(hosts, "queue").sortWithinPartitions("queue", "number", "key")
    return cut(dealt.mapInArrow(run, _RESULT), "answers")


def _cached(spark: SparkSession, cache: str, first_day: str) -> DataFrame:
    """Answers that are kept, not older than a day: key, status, element, day."""
    where, root = store(cache)
    schema = "key string, status string, element string, day string"
    if not where.get_file_info(root).is_file and where.get_file_info(root).type.name == "NotFound":
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(cache).where(F.col("day") >= first_day)


def collect_tiles(
    spark: SparkSession,
    boxes: list[Box],
    selectors: list[str],
    mirrors: list[str],
    cache: str,
    country: str | None = None,
    elements: str = "nwr",
    out: str = "geom",
    ask: str = "http",
    seconds: float = 90.0,
    budget: float = 600.0,
    depth: int = 2,
    slow: int = 2,
    days: int = 7,
    today: dt.date | None = None,
    sleep: Callable[[float], None] = time.sleep,
) -> DataFrame:
    """Elements of all tiles as JSON (number, element), fetched over many tasks, each tile's answer once.

    In rounds: every open tile is put into the queue of a mirror that has not failed it; queues of different hosts run side by side. A tile that ``slow`` mirrors could not answer in
    time is replaced by its quarters, ``depth`` times over; one that failed goes to the next mirror. A mirror that asks for rest gets it from all tiles of this call. All requests share one budget.
    Answers, and which tiles were split, are added to the cache (a folder that driver and tasks share) after each round, with their day; answers of the last ``days`` days are not asked for again. So a run that broke
    off, or was incomplete, goes on where it was. Incomplete, with the tiles, if some stay without an answer.
    """
    day = today or dt.date.today()
    first_day, end, hosts = str(day - dt.timedelta(days=days)), time.time() + budget, list(dict.fromkeys(urlsplit(m).netloc or m for m in mirrors))
    queue = {i: hosts.index(urlsplit(m).netloc or m) for i, m in enumerate(mirrors)}
    text = lambda b: query_text(selectors, b, elements, int(seconds), out, country)
    key = lambda b: hashlib.sha256(text(b).encode()).hexdigest()
    todo, answered, lost = [TileJob(i, tuple(b), depth) for i, b in enumerate(boxes)], [], []
    resting: dict[int, float] = {}
    while todo:
        known = {r.key: r.status for r in _cached(spark, cache, first_day).join(spark.createDataFrame([(key(t.box),) for t in todo], "key string").distinct(), "key", "left_semi").groupBy("key").agg(F.max("status").alias("status")).collect()}
        answered += [(t.number, key(t.box)) for t in todo if known.get(key(t.box)) == "ok"]
        quartered = [t for t in todo if known.get(key(t.box)) == "split"]
        todo = [t for t in todo if key(t.box) not in known] + [TileJob(t.number, q, t.depth - 1) for t in quartered for q in quarters(t.box)]
        if quartered:
            continue
        ready = [i for i in range(len(mirrors)) if resting.get(i, 0.0) <= time.time()]
        rows, waiting = [], []
        for t in todo:
            m = t.mirror(ready, len(mirrors))
            if m is not None:
                rows.append((queue[m], t.number, t.depth, m, mirrors[m], key(t.box), text(t.box)))
            elif t.mirror(list(range(len(mirrors))), len(mirrors)) is not None:
                waiting.append(t)
            else:
                lost.append(t)
        pause = min((resting[i] for i in resting if resting[i] > time.time()), default=time.time()) - time.time()
        if lost or not rows and (not waiting or time.time() + pause >= end):
            lost += [t for t in waiting if t not in lost]
            if not rows:
                break
        if not rows:
            sleep(max(0.0, pause))
            continue
        got = _ask_queues(spark, rows, len(hosts), ask, seconds, end)
        marks = got.where("status = 'ok'").select("key", "status", "element")
        seen = {(r.number, r.key): r for r in got.groupBy("number", "key").agg(F.first("status").alias("status"), F.first("wait").alias("wait"), F.first("mirror").alias("mirror")).collect()}
        splits = []
        for t in todo:
            r = seen.get((t.number, key(t.box)))
            if r is None or r.status == "ok":
                continue
            if r.status == "rest":
                resting[r.mirror] = time.time() + r.wait
            elif r.status == "slow":
                t.slow.add(r.mirror)
                if t.depth and len(t.slow) >= min(slow, len(mirrors)):
                    splits.append((key(t.box), "split", None))
            elif r.status == "failed":
                t.failed.add(r.mirror)
        kept = marks.unionByName(spark.createDataFrame(splits, "key string, status string, element string")) if splits else marks
        kept.withColumn("day", F.lit(str(day))).coalesce(max(1, len(hosts))).write.mode("append").partitionBy("day").parquet(cache)
        release(got)
        if time.time() >= end:
            lost += [t for t in todo if seen.get((t.number, key(t.box))) is None or seen[t.number, key(t.box)].status != "ok"]
            break
        todo = [t for t in todo if t not in lost]
    if lost:
        raise Incomplete(f"no answer for {sorted({t.number for t in lost})}: {[t.box for t in lost]}")
    keys = spark.createDataFrame(answered, "number int, key string")
    return keys.join(_cached(spark, cache, first_day).where("status = 'ok' AND element IS NOT NULL").select("key", "element").distinct(), "key").select("number", "element")


_POINTS = "array<struct<lat:double,lon:double>>"
_JSON = f"type string, id long, lat double, lon double, center struct<lat:double,lon:double>, tags map<string,string>, geometry {_POINTS}, members array<struct<type:string,role:string,geometry:{_POINTS}>>"


def parsed(elements: DataFrame) -> DataFrame:
    """Columns of osm.ELEMENT, and ord, of elements as JSON: a center stands for a place, no geometry or member is null."""
    e = elements.select("number", F.from_json("element", _JSON).alias("e")).select("number", "e.*")
    full = lambda c: F.when(F.size(c) > 0, F.col(c))
    return e.select(
        "type", "id", F.coalesce("lat", "center.lat").alias("lat"), F.coalesce("lon", "center.lon").alias("lon"), F.coalesce("tags", F.create_map().cast("map<string,string>")).alias("tags"), full("geometry").alias("geometry"), full("members").alias("members"), F.col("number").cast("long").alias("ord")
    )


def scan(spark: SparkSession, boxes: list[Box], selectors: list[str], mirrors: list[str], country: str | None = None, cache: str | None = None, **options) -> DataFrame:
    """Elements of all tiles, each once: comparisons of numbers, which servers leave out, are made here. Without a cache of one's own, answers are kept in the shared folder for this session."""
    rows = union_tiles(parsed(collect_tiles(spark, boxes, selectors, mirrors, cache or f"{shared_dir(spark)}/terrasift/tiles", country, **options)))
    return rows.where(any_selector(selectors, F.col("tags"))) if any(clauses(s)[1] for s in selectors) else rows
