import hashlib
import itertools
import random

import pytest
from oracle import frames
from pyspark.sql import functions as F

from terrasift.llm import chat_repair
from terrasift.llm.chat_repair import END, GONE, Automaton, damage, digests, repair, report
from terrasift.llm.registry import ORACLE, QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def cheapest(rows):
    """Cost, least audit and lines of (fate, role, text) rows, by all paths of all edits: (place, state) with every reachable (cost, audit, lines)."""
    best = {(0, "q"): (0, "", ())}
    keep = {("q", "s"): "s", ("q", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    nxt = {"q": "u", "s": "u", "a": "u", "u": "a"}
    name = {"u": "user", "a": "assistant"}
    for i in range(len(rows) + 1):
        for _ in range(3):
            for q in "qsua":
                if (i, q) in best:
                    c, a, lines = best[i, q]
                    new = (c + 5, a + "I", (*lines, f"{name[nxt[q]]}:"))
                    best[i, nxt[q]] = min(best.get((i, nxt[q]), new), new)
        if i == len(rows):
            break
        fate, role, text = rows[i]
        for q in "qsua":
            if (i, q) not in best:
                continue
            c, a, lines = best[i, q]
            found = [(q, (c + 2, a + "D", lines))]
            if fate not in ("blank", "duplicate"):
                more = 5 if fate == "truncated" else 0
                found.append((nxt[q], (c + more + 1, a + "R", (*lines, f"{name[nxt[q]]}:{text}"))))
                if (q, role[:1]) in keep:
                    found.append((keep[q, role[:1]], (c + more, a + "K", (*lines, f"{role}:{text}"))))
            for q2, new in found:
                best[i + 1, q2] = min(best.get((i + 1, q2), new), new)
    return min(best[len(rows), q] for q in "qa" if (len(rows), q) in best)


def expected(rows):
    """The report on one conversation's (turn, role, text) rows, row by row."""
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    rows = sorted(((t, r or " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), md5(r[2])))
    seen, marked = set(), []
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\f\r")
        fate = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        marked.append((fate, role, text))
    turns = [t for t, _, _ in rows if t is not None]
    cost, audit, lines = cheapest(marked)
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(sum(f == k for f, _, _ in marked) for k in ("blank", "duplicate", "truncated")),
        sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(marked)),
        cost,
        audit,
        hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def drawn(rng, n):
    roles = ["user", "assistant", "system", "tool", "", None, "User"]
    texts = ["Fine.", "cut off", "", " \n", None, "Well?  \t", "so", "é!"]
    return [(rng.choice([None, *range(6), *range(6)]), rng.choices(roles, [6, 6, 3, 1, 1, 1, 1])[0], rng.choices([f"{rng.random()}.", rng.choice(texts)], [2, 3])[0]) for _ in range(n)]


@pytest.mark.parametrize("block,seed", [(4096, 0), (2, 1), (5, 2)])
def test_against_all_paths(spark, block, seed):
    """Conversations of 0 to 30 rows, in blocks that are smaller than they are too, over several partitions."""
    rng = random.Random(seed)
    made = {c: drawn(rng, rng.choice([1, 2, 3, 6, 12, 30])) for c in [None, *range(120)]}
    rows = spark.createDataFrame([(c, *r) for c, rs in made.items() for r in rs], SCHEMA).withColumn("kind", F.lit("clash")).withColumn("h", F.lit(1)).repartition(3)
    got = {r.conv_id: tuple(r)[1:] for r in report(rows, rows, block=block).collect()}
    assert got.keys() == made.keys()
    for c, rs in made.items():
        assert got[c] == expected(rs), (c, rs)


def test_one_conversation_of_many_rows(spark):
    """One conversation is most of the table: it goes to several blocks and partitions, and its rows come back in order."""
    rng = random.Random(3)
    long = [(t, rng.choice(["user", "assistant"]), rng.choice([f"{t}.", f"{t}", "again."])) for t in range(3000)]
    rows = spark.createDataFrame([(1, *r) for r in long] + [(2, 0, "user", "a."), (0, 0, "user", "b.")], SCHEMA).repartition(6)
    got = {r.conv_id: tuple(r)[1:] for r in report(rows, rows, block=100).collect()}
    assert got[1] == expected(long) and got[2] == expected([(0, "user", "a.")])
    _, kept = repair(rows, block=100)
    lines = [f"{r.role}:{r.text}" for r in kept.where("conv = 1").orderBy("place").collect()]
    assert hashlib.sha256("\n".join(lines).encode()).hexdigest() == got[1][-1]


def test_repeated_rows_are_counted(spark):
    rows = spark.createDataFrame([(1, 0, "user", "a."), (1, 1, "assistant", "b.")], SCHEMA)
    many = rows.unionAll(spark.range(5000).select(F.lit(1).cast("long"), F.lit(1).cast("long"), F.lit("assistant"), F.lit("b.")))
    r = report(many, many).first()
    assert (r.duplicate, r.illegal, r.cost, r.audit) == (5000, 5000, 10000, "KK" + "D" * 5000)


def test_table_of_transitions():
    """Few states, all filled lazily; vectors stay within what 4 bits hold."""
    a = Automaton()
    assert a.before == {}
    a.scan(bytes([2, 3, 2, 3]), END)
    assert 0 < len(a.before) <= 4
    states = a.all_states()
    assert len(states) < 64 and all(0 <= c <= 12 for s in states for c in chat_repair._unpack(s))
    assert all(a.step(s, 4 * GONE + 1) == (s, 2) for s in states)


def test_query_against_sql(spark):
    got, want = frames(spark, QUERIES["op13_chat_repair"], ORACLE["op13_chat_repair"])
    assert got and got == want


def test_sql_on_odd_rows(spark, tmp_path):
    """Nulls in every column, ties and repeats: query and SQL agree."""
    rng = random.Random(9)
    rows = [(c, *r) for c in [None, *range(60)] for r in drawn(rng, rng.choice([1, 4, 7]))]
    spark.createDataFrame(rows + rows[:20], SCHEMA).coalesce(1).write.parquet(str(tmp_path / "conversations"))
    (next((tmp_path / "conversations").glob("*.parquet"))).rename(tmp_path / "conversations.parquet")
    for f in (tmp_path / "conversations").iterdir():
        f.unlink()
    (tmp_path / "conversations").rmdir()
    got, want = frames(spark, QUERIES["op13_chat_repair"], ORACLE["op13_chat_repair"], sf=str(tmp_path))
    assert got and got == want


def test_empty_and_dropped(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert report(empty, empty).collect() == [] and digests(repair(empty)[1]).collect() == []
    r = report(spark.createDataFrame([(5, 1, "user", "x")], SCHEMA), empty).first()
    assert tuple(r) == (5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert damage(empty).count() == 0
