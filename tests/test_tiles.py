"""Tiles over HTTP: servers on this machine that are dead, slow, resting or well, and what is asked of them."""

import datetime as dt
import json
import threading
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import unquote

import pytest

from terrasift.sources import overpass
from terrasift.sources.fetch import Client, Mirrors
from terrasift.sources.osm import ELEMENT


class Server:
    """answer(query) -> (seconds to wait, status, body); log of (start, end, query)."""

    def __init__(self, answer):
        self.log, guard = [], threading.Lock()

        class Handler(BaseHTTPRequestHandler):
            def do_POST(handler):  # noqa: N802, N805
                start = time.time()
                query = unquote(handler.rfile.read(int(handler.headers["content-length"])).decode().removeprefix("data="))
                wait, status, body = answer(query)
                time.sleep(wait)
                with guard:
                    self.log.append((start, time.time(), query))
                try:
                    handler.send_response(status)
                    if status == 429:
                        handler.send_header("retry-after", "1")
                    handler.end_headers()
                    handler.wfile.write(body)
                except OSError:
                    pass

            def log_message(handler, *args):  # noqa: N805
                pass

        self.http = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        self.url = f"http://127.0.0.1:{self.http.server_port}/api"
        threading.Thread(target=self.http.serve_forever, daemon=True).start()


def box_of(query):
    south, west, north, east = map(float, query.rsplit("](", 1)[1].split(")")[0].split(","))
    return west, south, east, north


def good(query):
    w, s, e, n = box_of(query)
    elements = [{"type": "node", "id": int(w * 100 + s * 10), "lat": s, "lon": w, "tags": {"v": "5"}}, {"type": "way", "id": 7, "center": {"lat": 1.0, "lon": 2.0}, "tags": {"v": "1"}}]
    return 0.0, 200, json.dumps({"elements": elements}).encode()


@pytest.fixture
def servers():
    made = []

    def make(answer):
        made.append(Server(answer))
        return made[-1]

    yield make
    for s in made:
        s.http.shutdown()


def dead():
    import socket

    with socket.socket() as s:
        s.bind(("127.0.0.1", 0))
        return f"http://127.0.0.1:{s.getsockname()[1]}/api"


BOXES = [(float(i), 0.0, i + 1.0, 1.0) for i in range(9)]
DAY = dt.date(2026, 5, 1)


def test_mirrors_over_http(servers):
    """A dead mirror, one that is too slow, and one that answers: each is asked, and errors keep their kind."""
    slow, well = servers(lambda q: (3.0, 200, b"{}")), servers(good)
    query = overpass.query_text(["v"], BOXES[0])
    got = Mirrors([dead(), slow.url, well.url], overpass.ask_http).run(query, 0.5)
    assert len(got["elements"]) == 2 and len(well.log) == 1
    with pytest.raises(TimeoutError):
        Mirrors([slow.url, slow.url], overpass.ask_http).run(query, 0.3)
    with pytest.raises(ConnectionRefusedError):
        Client(tries=1).get(dead())
    with pytest.raises(TimeoutError):
        Client(tries=1, timeout=0.3).get(slow.url, body=b"data=x")


def test_one_tile_that_is_too_large(spark, servers, tmp_path):
    """Eight tiles answer, one times out everywhere until it is asked for in quarters; one mirror is dead. A second run asks nothing."""
    large = lambda q: box_of(q)[0] >= 8 and box_of(q)[2] - box_of(q)[0] > 0.9
    a, b = (servers(lambda q: (2.0, 200, b"{}") if large(q) else good(q)) for _ in range(2))
    args = {"cache": str(tmp_path / "tiles"), "seconds": 1, "today": DAY}
    rows = overpass.scan(spark, BOXES, ["v>=2"], [a.url, dead(), b.url], **args).collect()
    assert len(rows) == 12 and {r.type for r in rows} == {"node"}
    for s in (a, b):
        spans = sorted((x, y) for x, y, q in s.log if not large(q))
        assert all(y <= x2 + 0.05 for (_, y), (x2, _) in zip(spans, spans[1:], strict=False)), "two tasks asked one host at once"
    asked = len(a.log) + len(b.log)
    assert asked <= 8 + 2 + 4 + 2 and a.log and b.log
    again = overpass.scan(spark, BOXES, ["v>=2"], [a.url, b.url], **args).collect()
    assert again == rows and len(a.log) + len(b.log) == asked
    assert len(overpass.scan(spark, BOXES[:1], ["v>=2"], [a.url], cache=args["cache"], seconds=1, today=DAY + dt.timedelta(days=9)).collect()) == 1 and len(a.log) + len(b.log) == asked + 1


def test_rest_and_incomplete(spark, servers, tmp_path):
    """A mirror that asks for rest is left alone meanwhile; what was answered before a failure is kept; an error names the tiles."""
    first = []

    def tired(q):
        first.append(time.time())
        return (0.0, 429, b"") if len(first) == 1 else good(q)

    s = servers(tired)
    rows = overpass.collect_tiles(spark, BOXES[:3], ["v"], [s.url], str(tmp_path / "a"), seconds=2, today=DAY).collect()
    assert len({r.number for r in rows}) == 3 and len(first) == 4 and first[1] - first[0] >= 1.0
    broken = servers(lambda q: (0.0, 500, b"") if box_of(q)[0] == 1 else good(q))
    with pytest.raises(overpass.Incomplete, match=r"\[1\]"):
        overpass.collect_tiles(spark, BOXES[:3], ["v"], [broken.url], str(tmp_path / "b"), seconds=2, today=DAY)
    assert len({r.number for r in overpass.collect_tiles(spark, [BOXES[0], BOXES[2]], ["v"], [dead()], str(tmp_path / "b"), seconds=2, today=DAY).collect()}) == 2
    with pytest.raises(overpass.Incomplete):
        overpass.collect_tiles(spark, BOXES[:2], ["v"], [s.url], str(tmp_path / "c"), seconds=2, budget=0.0, today=DAY)


def test_elements_as_columns(spark):
    rows = [(0, json.dumps(e)) for e in ({"type": "way", "id": 1, "geometry": [{"lat": 1, "lon": 2}, None], "tags": {"n": 5}}, {"type": "relation", "id": 2, "members": [{"type": "way", "role": "outer", "geometry": [{"lat": 1, "lon": 2}]}]}, {"type": "node", "id": 3, "lat": 1, "lon": 2})]
    got = overpass.parsed(spark.createDataFrame(rows, "number int, element string"))
    assert got.drop("ord").schema == spark.createDataFrame([], ELEMENT).schema or [f.name for f in got.schema][:-1] == [x.split()[0] for x in ("type s", "id l", "lat d", "lon d", "tags m", "geometry a", "members a")]
    way, relation, node = got.orderBy("id").collect()
    assert way.tags == {"n": "5"} and way.geometry[1] is None and relation.members[0].role == "outer" and relation.geometry is None and node.lat == 1.0 and node.tags == {}
