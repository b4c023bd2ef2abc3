"""Operator 13, conversation structure repair: the cheapest edits that give every conversation the shape of system?, (user, assistant)+, or nothing.

A weighted automaton with four states (nothing yet, after system, after user, after assistant) reads a conversation's rows: keep, re-role, delete, or insert before a row. It is made
deterministic lazily. One deterministic state is the vector of what the rest of the conversation costs from each of the four, less the vector's least cost; it
is packed into 16 bits, and a table keeps, for each state and kind of row, the state before that row and its weight, from the first time they are met. Scanning rows from
the last to the first costs one look-up a row; the weights add up to the cheapest cost. The trace goes back over the scan, from the first row to the last,
and takes among the tight arcs the one whose initial is least (D, I, K, R), so the audit is the least of all cheapest ones; its steps are kept in a table as well.
Vectors stay few: what follows one state can follow any other for at most two inserted rows and one deleted more, so costs in a vector differ by 12 at most.

Rows are first counted by conversation, turn, role and text, the text as its hash, and found to be blank, repeated (joined with the first turn of the same role and text)
or cut off. They are then dealt by ranges, so a conversation that holds a third of all rows spans many tasks, and packed into blocks. A block that is not a whole conversation is
summarised: for every deterministic state at its right end the state at its left end, and the automaton's state after its trace. Summaries of one conversation
(some hundred bytes a block of BLOCK rows) are put together in order; then every block is traced by itself. Texts are joined to the kept rows last.

Null roles and texts are one space. Rows come by turn, null turns first, then by role and by the text's MD5. A null conversation id is a conversation. Repeated rows are counted, not
multiplied. Other columns are ignored, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrasift.llm.common import SPACES, cut, release, table
from terrasift.llm.decl import query

#: States of the weighted automaton, costs of edits, and rows in a block.
START, SYSTEM, USER, ASSISTANT = range(4)
DELETE, REROLE, INSERT, CUT_OFF = 2, 1, 5, 5
BLOCK = 4096
#: A row's kind is its fate times 4 plus its role's initial: 0 other, 1 s, 2 u, 3 a. Fates: fine, cut off, to be deleted.
FINE, TRUNCATED, GONE = range(3)
_KEEP = {(START, 1): SYSTEM, (START, 2): USER, (SYSTEM, 2): USER, (ASSISTANT, 2): USER, (USER, 3): ASSISTANT}
_NEXT = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_LEGAL = {(1, 2), (2, 3), (3, 2)}


def _closed(costs: list[int]) -> list[int]:
    """Costs from each state where rows may be inserted first."""
    for _ in range(2):
        costs = [min(c, INSERT + costs[_NEXT[q]]) for q, c in enumerate(costs)]
    return costs


def _pack(costs: list[int]) -> tuple[int, int]:
    least = min(costs)
    return sum((c - least) << (4 * q) for q, c in enumerate(costs)), least


def _unpack(state: int) -> list[int]:
    return [(state >> (4 * q)) & 15 for q in range(4)]


#: After the last row: nothing is owed at the start and after assistant.
END = _pack(_closed([0, 99, 99, 0]))[0]


class Automaton:
    """The deterministic automaton, as far as it has been needed: ``before`` and ``trace`` are its tables."""

    def __init__(self):
        self.before: dict[tuple[int, int], tuple[int, int]] = {}
        self.trace: dict[tuple[int, int, int], tuple[str, int, tuple[str, ...], str | None]] = {}

    @staticmethod
    def _costs(state: int, kind: int) -> list[int]:
        after, (fate, initial) = _unpack(state), divmod(kind, 4)
        costs = [DELETE + c for c in after]
        if fate != GONE:
            more = CUT_OFF * (fate == TRUNCATED)
            for q in range(4):
                costs[q] = min(costs[q], more + REROLE + after[_NEXT[q]], *([more + after[_KEEP[q, initial]]] if (q, initial) in _KEEP else []))
        return _closed(costs)

    def step(self, state: int, kind: int) -> tuple[int, int]:
        """State before a row of this kind, given that after it, and the weight."""
        found = self.before.get((state, kind))
        if found is None:
            found = self.before[state, kind] = _pack(self._costs(state, kind))
        return found

    def follow(self, state: int, kind: int, q: int) -> tuple[str, int, tuple[str, ...], str | None]:
        """From q before the row: initials of the edits, the state after it, roles of inserted rows, and the row's own new role ("": as it is, None: deleted)."""
        found = self.trace.get((state, kind, q))
        if found is not None:
            return found
        costs, after, (fate, initial), audit, added, at = self._costs(state, kind), _unpack(state), divmod(kind, 4), "", [], q
        more = CUT_OFF * (fate == TRUNCATED)
        while True:
            if DELETE + after[at] == costs[at]:
                found = (audit + "D", at, tuple(added), None)
            elif INSERT + costs[_NEXT[at]] == costs[at]:
                at = _NEXT[at]
                audit += "I"
                added.append(_ROLE[at])
                continue
            elif (at, initial) in _KEEP and more + after[_KEEP[at, initial]] == costs[at]:
                found = (audit + "K", _KEEP[at, initial], tuple(added), "")
            else:
                found = (audit + "R", _NEXT[at], tuple(added), _ROLE[_NEXT[at]])
            self.trace[state, kind, q] = found
            return found

    def scan(self, kinds: bytes, state: int) -> tuple[list[int], int]:
        """States after each row, from that after the last, and then that before the first; what the rows weigh."""
        states, weight = [state], 0
        for kind in reversed(kinds):
            state, w = self.step(state, kind)
            states.append(state)
            weight += w
        states.reverse()
        return states, weight

    def all_states(self) -> list[int]:
        """Every state that can follow from END, in one order for all tasks."""
        found, new = {END}, [END]
        while new:
            new = sorted({self.step(s, kind)[0] for s in new for kind in range(12)} - found)
            found.update(new)
        return sorted(found)

    def summary(self, kinds: bytes) -> tuple[list[int], list[int]]:
        """For each of all_states() at the right end: the state at the left end, and where the trace ends from each of the four states, four bits each."""
        lefts, ends = [], []
        for right in self.all_states():
            states, _ = self.scan(kinds, right)
            lefts.append(states[0])
            packed = 0
            for q in range(4):
                at = q
                for i, kind in enumerate(kinds):
                    at = self.follow(states[i + 1], kind, at)[1]
                packed |= at << (4 * q)
            ends.append(packed)
        return lefts, ends


def _kinds(rows: DataFrame) -> DataFrame:
    """Conversation, turn, role, hash of text, how many such rows, whether blank, and the first one's kind."""
    bare = F.rtrim(F.col("text"), F.lit(SPACES))
    flags = rows.select("conv", "turn", "role", F.md5(F.encode("text", "UTF-8")).alias("h"), (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("open"))
    counted = cut(flags.groupBy("conv", "turn", "role", "h", "blank", "open").agg(F.count("*").alias("n")), "turns")
    first = counted.groupBy(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("h").alias("t")).agg(F.min(F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))).alias("first"))
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("h") == F.col("t"))
    seen = ~F.col("first.turn").eqNullSafe(F.col("turn"))
    fate = F.when(F.col("blank") | F.col("seen"), GONE).when(F.col("open"), TRUNCATED).otherwise(FINE)
    initial = F.substring("role", 1, 1)
    number = F.when(initial == "s", 1).when(initial == "u", 2).when(initial == "a", 3).otherwise(0)
    joined = counted.join(first, same).withColumn("seen", seen)
    out = cut(joined.select("conv", "turn", "role", "h", "n", "blank", "seen", (fate * 4 + number).cast("int").alias("kind")), "kinds")
    release(counted)
    return out


def _blocks(rows: DataFrame, partitions: int, block: int) -> DataFrame:
    """Rows in order, packed by conversation; ``whole`` if a block holds all of one, else ``lefts`` and ``ends`` summarise it."""
    conv = rows.schema["conv"].dataType.simpleString()
    turn = rows.schema["turn"].dataType.simpleString()
    schema = f"conv {conv}, piece int, part long, whole boolean, kinds binary, counts array<long>, turns array<{turn}>, roles array<string>, hashes array<string>, lefts array<int>, ends array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, piece, part = Automaton(), TaskContext.get().partitionId(), 0
        names, kinds = [x.split()[0] for x in schema.split(", ")], None
        held: list[tuple] = []
        left_open, ready, waiting = True, [], 0

        def flush(right_open: bool) -> None:
            nonlocal part
            own = bytes(r[5] for r in held)
            whole = not (left_open or right_open)
            lefts, ends = (None, None) if whole else machine.summary(own)
            ready.append((held[0][0], piece, part, whole, own, [r[4] for r in held], [r[1] for r in held], [r[2] for r in held], [r[3] for r in held], lefts, ends))
            part += 1

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in ready], t) for i, t in enumerate(kinds)], names)

        for batch in batches:
            if kinds is None:
                key, when = batch.schema.field(0).type, batch.schema.field(1).type
                kinds = [key, pa.int32(), pa.int64(), pa.bool_(), pa.binary(), pa.list_(pa.int64()), pa.list_(when), pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int32())]
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and (other := row[0] != held[0][0]) | (len(held) == block):
                    flush(not other)
                    waiting += len(held)
                    held, left_open = [], not other
                    if waiting >= 20_000:
                        yield batch_of()
                        ready.clear()
                        waiting = 0
                held.append(row)
        if held:
            flush(True)
            yield batch_of()

    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "h"]
    dealt = rows.select("conv", "turn", "role", "h", "n", "kind").repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    return cut(dealt.mapInArrow(run, schema), "blocks")


def _ends(blocks: DataFrame) -> DataFrame:
    """For each block of a conversation in several: the deterministic state at its right end, the state its trace begins in, whether it is first or last, and whether its first row's role may not follow the block before."""
    schema = "piece int, part long, right_state int, q int, is_first boolean, is_last boolean, clash boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = {s: i for i, s in enumerate(Automaton().all_states())}
        key, held = None, []

        def settle() -> pa.RecordBatch:
            out, state, q = [], END, START
            for row in reversed(held):
                out.append([row[1], row[2], state, 0, row is held[0], row is held[-1], False])
                state = row[3][at[state]]
            out.reverse()
            for i, (row, done) in enumerate(zip(held, out, strict=True)):
                done[3], done[6] = q, i > 0 and (held[i - 1][6], row[5]) not in _LEGAL
                q = row[4][at[done[2]]] >> (4 * q) & 15
            kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_(), pa.bool_())
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], [x.split()[0] for x in schema.split(", ")])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and row[0] != key:
                    yield settle()
                    held = []
                key = row[0]
                held.append(row)
        if held:
            yield settle()

    tail = F.conv(F.hex(F.substring("kinds", -1, 1)), 16, 10).cast("int") % 4
    head = F.conv(F.hex(F.substring("kinds", 1, 1)), 16, 10).cast("int") % 4
    cut_up = blocks.where(~F.col("whole")).select("conv", "piece", "part", "lefts", "ends", head.alias("head"), tail.alias("tail"))
    order = [F.col("conv").asc_nulls_first(), "piece", "part"]
    return cut_up.repartition("conv").sortWithinPartitions(*order).mapInArrow(run, schema)


def _edits(blocks: DataFrame) -> DataFrame:
    """Each block's audit, cost, pairs of roles that may not follow each other, and the rows that stay or are added: role, and turn, source role and hash of those that stay."""
    conv = blocks.schema["conv"].dataType.simpleString()
    turn = blocks.schema["turns"].dataType.elementType.simpleString()
    schema = f"conv {conv}, piece int, part long, audit string, cost long, illegal long, roles array<string>, turns array<{turn}>, sources array<string>, hashes array<string>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Automaton()
        for batch in batches:
            out = []
            for conv, piece, part, kinds, counts, turns, roles, hashes, right, q, first, last, clash in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                states, cost = machine.scan(kinds, right)
                cost += _unpack(states[0])[START] if first else 0
                illegal, audit, kept = int(clash), [], []
                for i, (kind, n) in enumerate(zip(kinds, counts, strict=True)):
                    edits, q, added, role = machine.follow(states[i + 1], kind, q)
                    audit.append(edits + "D" * (n - 1))
                    cost += DELETE * (n - 1)
                    illegal += n - 1 + (i > 0 and (kinds[i - 1] % 4, kind % 4) not in _LEGAL)
                    kept += [(r, None, None, None) for r in added]
                    if role is not None:
                        kept.append((role or roles[i], turns[i], roles[i], hashes[i]))
                while last and _unpack(END)[q]:
                    q = _NEXT[q]
                    audit.append("I")
                    kept.append((_ROLE[q], None, None, None))
                out.append((conv, piece, part, "".join(audit), cost, illegal, *([k[j] for k in kept] for j in range(4))))
            s = batch.schema
            kinds_of = [s.field(0).type, pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.string()), s.field(5).type, pa.list_(pa.string()), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds_of)], [x.split()[0] for x in schema.split(", ")])

    ends = _ends(blocks)
    found = blocks.join(ends, ["piece", "part"], "left")
    filled = [F.coalesce(c, F.lit(v)) for c, v in (("right_state", END), ("q", START), ("is_first", True), ("is_last", True), ("clash", False))]
    out = cut(found.select("conv", "piece", "part", "kinds", "counts", "turns", "roles", "hashes", *filled).mapInArrow(run, schema), "edits")
    release(blocks)
    return out


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """A report (conv, gaps, blank, duplicate, truncated, illegal, cost, audit) on each conversation, and the repaired rows (conv, place, role, text), which ``place`` sorts."""
    spark = rows.sparkSession
    plain = rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit(" ")).alias("role"), F.coalesce(F.col(text_col), F.lit(" ")).alias("text"))
    kinds = _kinds(plain)
    edits = _edits(_blocks(kinds, int(spark.conf.get("spark.sql.shuffle.partitions")), block))

    turn, n = F.col("turn"), F.col("n")
    counts = kinds.groupBy("conv", "turn").agg(
        F.sum(F.when(F.col("blank"), n).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).when(F.col("seen"), n).otherwise(n - 1)).alias("duplicate"),
        F.sum((F.floor(F.col("kind") / 4) == TRUNCATED).cast("int")).alias("truncated"),
    )
    by_conv = counts.groupBy("conv").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count(turn), F.lit(0)).alias("gaps"), *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")))
    audits = edits.groupBy("conv").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece", "part", "audit"))), lambda x: x.audit), "").alias("audit"), F.sum("cost").alias("cost"), F.sum("illegal").alias("illegal"))
    both = by_conv.unionByName(audits, allowMissingColumns=True)
    report = both.groupBy("conv").agg(*(F.max(c).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")))

    each = edits.select("conv", "piece", "part", F.posexplode(F.arrays_zip("roles", "turns", "sources", "hashes")).alias("at", "x")).select(
        "conv", F.struct("piece", "part", "at").alias("place"), F.col("x.roles").alias("role"), F.col("x.turns").alias("turn"), F.col("x.sources").alias("source"), F.col("x.hashes").alias("h")
    )
    own = each.where("h IS NOT NULL")
    added = each.where("h IS NULL").select("conv", "place", "role", F.lit("").alias("text"))
    texts = plain.withColumn("h", F.md5(F.encode("text", "UTF-8"))).groupBy(*(F.col(a).alias(b) for a, b in (("conv", "c"), ("turn", "t"), ("role", "s"), ("h", "g")))).agg(F.first("text").alias("text"))
    same = F.col("conv").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("t")) & (F.col("source") == F.col("s")) & (F.col("h") == F.col("g"))
    return report, own.join(texts, same).select("conv", "place", "role", "text").unionAll(added)


def digests(rows: DataFrame) -> DataFrame:
    """conv and the SHA-256 of its rows ``role:text`` joined by newlines, in order. A hash takes its input one after another, so a conversation is one task's, which holds a batch of rows at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, running, kind = None, None, None
        for batch in batches:
            kind, done = batch.schema.field(0).type, []
            for conv, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if running is None or conv != key:
                    if running is not None:
                        done.append((key, running.hexdigest()))
                    key, running = conv, hashlib.sha256(line.encode())
                else:
                    running.update(b"\n" + line.encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], kind), pa.array([d[1] for d in done], pa.string())], ["conv", "digest"])
        if running is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], kind), pa.array([running.hexdigest()], pa.string())], ["conv", "digest"])

    lines = rows.repartition("conv").sortWithinPartitions("conv", "place").select("conv", F.concat("role", F.lit(":"), "text").alias("line"))
    return lines.mapInArrow(run, f"conv {rows.schema['conv'].dataType.simpleString()}, digest string")


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role and text (null: one space) with faults by the CRC-32 of ``conv_id:turn``: dropped, emptied, without sentence ends, twice, as user's."""

    def string(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fault = F.crc32(F.encode(F.concat(string("conv_id"), F.lit(":"), string("turn")), "UTF-8")) % 20
    read = rows.select("conv_id", "turn", string("role").alias("role"), string("text").alias("text"), fault.alias("fault")).where("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return read.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("copy")).drop("copy")


_SQL = r"""WITH RECURSIVE crc AS (
SELECT *, xor(list_reduce(list_concat([4294967295], list_transform(range(1, len(k) + 1), lambda i: CAST(ord(k[i]) AS BIGINT))),
 lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 20 AS f
FROM (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations)),
damaged AS (SELECT conv_id, turn, CASE f WHEN 4 THEN 'user' ELSE role END AS role, CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
 FROM crc, range(CASE f WHEN 3 THEN 2 ELSE 1 END) WHERE f <> 0),
ordered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i, left(role, 1) AS initial FROM damaged),
marked AS MATERIALIZED (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM ordered),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
 count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM marked GROUP BY conv_id),
arcs(q, needs, mark, price, q2, role) AS (VALUES (0, 's', 'K', 0, 1, NULL), (0, 'u', 'K', 0, 2, NULL), (1, 'u', 'K', 0, 2, NULL), (3, 'u', 'K', 0, 2, NULL), (2, 'a', 'K', 0, 3, NULL),
 (0, NULL, 'R', 1, 2, 'user'), (1, NULL, 'R', 1, 2, 'user'), (3, NULL, 'R', 1, 2, 'user'), (2, NULL, 'R', 1, 3, 'assistant'), (0, NULL, 'D', 2, 0, NULL), (1, NULL, 'D', 2, 1, NULL), (2, NULL, 'D', 2, 2, NULL), (3, NULL, 'D', 2, 3, NULL)),
adds(q, q2, more) AS (VALUES (0, 0, []), (1, 1, []), (2, 2, []), (3, 3, []), (0, 2, ['user:']), (1, 2, ['user:']), (3, 2, ['user:']), (2, 3, ['assistant:']), (0, 3, ['user:', 'assistant:']), (1, 3, ['user:', 'assistant:'])),
paths(conv_id, i, q, best) AS (
SELECT conv_id, CAST(0 AS BIGINT), q2, struct_pack(cost := CAST(5 * len(more) AS BIGINT), audit := repeat('I', len(more)), lines := CAST(more AS VARCHAR[])) FROM counts, adds WHERE q = 0
UNION ALL
SELECT p.conv_id, m.i, x.q2, min(struct_pack(cost := CAST(p.best.cost + a.price + CASE WHEN a.mark <> 'D' AND m.fault = 'truncated' THEN 5 ELSE 0 END + 5 * len(x.more) AS BIGINT), audit := p.best.audit || a.mark || repeat('I', len(x.more)),
 lines := list_concat(p.best.lines, CASE WHEN a.mark = 'D' THEN CAST([] AS VARCHAR[]) ELSE [coalesce(a.role, m.role) || ':' || m.text] END, CAST(x.more AS VARCHAR[]))))
FROM paths p JOIN marked m ON m.conv_id IS NOT DISTINCT FROM p.conv_id AND m.i = p.i + 1 JOIN arcs a ON a.q = p.q AND (a.needs IS NULL OR a.needs = m.initial) AND (a.mark = 'D' OR m.fault NOT IN ('blank', 'duplicate')) JOIN adds x ON x.q = a.q2
GROUP BY p.conv_id, m.i, x.q2),
solved AS (SELECT p.conv_id, min(p.best) AS best FROM paths p JOIN counts c ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND p.i = c.n WHERE p.q IN (0, 3) GROUP BY p.conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0) AS cost,
 coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN solved s ON s.conv_id IS NOT DISTINCT FROM o.conv_id"""


def report(rows: DataFrame, damaged: DataFrame, block: int = BLOCK) -> DataFrame:
    """Of every conv_id of rows: the report on its damaged rows, and the hash of the repaired ones. Without damaged rows: zeros, no audit, the hash of nothing."""
    found, repaired = repair(damaged, block=block)
    hashed = digests(repaired)
    parts = rows.select(F.col("conv_id").alias("conv")).distinct().unionByName(found, allowMissingColumns=True).unionByName(hashed, allowMissingColumns=True)
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return parts.groupBy(F.col("conv").alias("conv_id")).agg(
        *(F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in numbers), F.coalesce(F.max("audit"), F.lit("")).alias("audit"), F.coalesce(F.max("digest"), F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256")
    )


@query("op13_chat_repair", _SQL)
def op13_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return report(rows, damage(rows))
