from oracle import frames

from terrasift.llm import registry
from terrasift.llm.warc_revisits import resolve_revisits

SCHEMA = "record_id long, url string, ts long, status int, headers map<string,string>, verdict string"


def test_against_sql(spark):
    got, want = frames(spark, registry.QUERIES["op10_warc_revisits"], registry.ORACLE["op10_warc_revisits"])
    assert got == want
    assert {r[-1] for r in got} >= {"full", "etag"}


def brute(rows):
    out = []
    for i, u, t, s, h, _ in rows:
        key = (t is not None, t or 0, i is not None, i or 0)
        prior = [(kk, r) for r in rows for kk in [(r[2] is not None, r[2] or 0, r[0] is not None, r[0] or 0)] if r[3] == 200 and u is not None and r[1] == u and kk < key]
        stored = max(prior, key=lambda x: x[0])[1] if prior and s == 304 else None
        out.append((i, stored[0] if stored else (i if s == 200 else None)))
    return out


def test_as_of_over_slots(spark):
    rows = []
    for i in range(200):
        rows.append((i, f"x://h{'' if i % 3 else 'ot'}/p", (i * 37) % 101, 200 if i % 7 == 0 else 304 if i % 7 < 6 else 500, {"server": "s", "date": str(i)}, "clash"))
    rows += [(500, "x://hot/p", None, 200, None, ""), (501, "x://h/p", None, 304, {}, ""), (502, None, 5, 304, {}, ""), (503, None, 4, 200, {}, ""), (None, "x://none/q", 4, 304, None, ""), (9, rows[9][1], rows[9][2], rows[9][3], rows[9][4], "")]
    df = spark.createDataFrame(rows, SCHEMA)
    for slots in (1, 8, 64):
        got = sorted(((r.record_id, r.resolved_id) for r in resolve_revisits(df, slots=slots).collect()), key=repr)
        assert got == sorted(brute(rows), key=repr)


def test_validators_and_headers(spark):
    full = {"etag": '"a"', "last-modified": "m", "content-type": "html", "vary": "x"}
    asked = [{"etag": 'W/"a"', "content-type": "no", "date": "d"}, {"etag": '"b"'}, {"last-modified": "m"}, {"last-modified": "n"}, {}]
    rows = [(0, "https://WWW.h.example:443/a/?b=1&utm_x=2&a=3#f", 0, 200, full, "")] + [(i + 1, "http://h.example/a?a=3&b=1&ref=z", 1, 304, h, "") for i, h in enumerate(asked)]
    got = {r.record_id: r for r in resolve_revisits(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [got[i].verdict for i in range(6)] == ["full", "etag", "mismatch", "modified", "mismatch", "unchecked"]
    assert [got[i].resolved_id for i in range(6)] == [0, 0, None, 0, None, 0]
    assert got[1].headers == {"etag": 'W/"a"', "last-modified": "m", "content-type": "html", "vary": "x", "date": "d"}
    assert got[2].headers == {"etag": '"b"'} and got[5].headers == full


def test_empty(spark):
    assert resolve_revisits(spark.createDataFrame([], SCHEMA)).collect() == []
