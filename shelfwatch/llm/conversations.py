"""Conversation structure repair by depth-first branch and bound.

The rows of a conversation, in order, are edited until their roles read as an
optional system turn followed by pairs of user and assistant, or until none is left.
Keeping a row (K) costs 0, giving it the role user or assistant (R) 2, deleting it (D)
3, inserting an empty user or assistant turn (I) 2, and a truncated row that is not
deleted 1. Blank rows and repetitions must go. The result is the cheapest list of
edits; of equally cheap ones the least in ASCII order.

The search walks nodes (rows done, last role) with an explicit stack, edits in ASCII
order. A node's suffix has a lower bound: what each row costs by itself, and 2 for
each of the most disjoint pairs of neighbours that cannot both stay next to each
other. A greedy descent gives the first incumbent (cost, audit). A prefix is left as
soon as its cost and bound exceed the incumbent, or equal it with a later audit, or
when the node's dominance table holds a prefix that is no dearer; that one was found
earlier and has the lesser audit. Costs are small integers, so a node is entered a
bounded number of times; an empty stack proves the incumbent.

Conversations of at most ``LONGEST`` rows and ``MOST_BYTES`` of text are repaired one
at a time in a single pass after one shuffle. The rows of longer ones are range
partitioned and cut into segments of at most ``SEGMENT`` rows; the same search finds
a segment's cheapest edits for every pair of roles around it, narrow rows of costs
tell which of them to take, and the texts pass once more, in order, through a task
that holds one row at a time. Both ways give the same result. The repaired text has
one digest, so its rows have to meet one after the other at the end.

Role and text: null is one space. Rows are ordered by turn (null first), then role,
then a hash of the text; equal rows are repetitions of the first. Roles are told
apart by their first character; an empty role has none and cannot stay. A null
conversation id is an id. A conversation whose turns are all null has no gaps; gaps
beyond a long are its largest value. An empty table gives an empty one. Further
columns of the input do not matter and do not come back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwatch.runtime import Scratch

LONGEST, MOST_BYTES, SEGMENT_BITS = 1024, 1 << 24, 9
WHITE = " \t\n\x0b\x0c\r"
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
#: The last role before a row; "" is the start.
STATES = ("", "s", "u", "a")
_NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
_NAMES = {"u": "user", "a": "assistant"}
#: What it costs to end after a role, and with which edits.
_TO_END = {"": 0, "s": 4, "u": 2, "a": 0}
_TAIL = {"": "", "s": "II", "u": "I", "a": ""}
_FAR = 1 << 60


class Search:
    """Branch and bound over rows given as (initial, fault)."""

    def __init__(self, rows: list[tuple[str, int]], closed: bool):
        """*closed*: the rows end the conversation; otherwise any role may follow."""
        n = len(rows)
        self.n, self.closed = n, closed
        self.forced = [fault in (BLANK, DUPLICATE) for _, fault in rows]
        self.late = [int(fault == TRUNCATED) for _, fault in rows]
        # One more place for the end, which a user turn must not stand before.
        self.initial = [initial for initial, _ in rows] + ["u" if closed else ""]
        self.alone = [0] * (n + 2)
        self.pairs = [0] * (n + 2)
        self.stays = [n] * (n + 1)
        self.system = [False] * (n + 1)
        for i in range(n - 1, -1, -1):
            after = self.stays[i + 1]
            if self.forced[i]:
                self.alone[i] = self.alone[i + 1] + 3
                self.pairs[i], self.stays[i], self.system[i] = self.pairs[i + 1], after, self.system[i + 1]
                continue
            here = self.initial[i]
            self.alone[i] = self.alone[i + 1] + self.late[i] + (0 if here in ("u", "a") else 2)
            clash = here in ("u", "a") and here == self.initial[after]
            self.pairs[i] = max(self.pairs[i + 1], 1 + self.pairs[after + 1] if clash else 0)
            self.stays[i] = i
            self.system[i] = self.system[i + 1] or here == "s"

    def bound(self, i: int, state: str) -> int:
        """No way from here on costs less."""
        j, pairs = self.stays[i], self.pairs[i]
        if self.initial[j] in ("u", "a") and self.initial[j] != _NEXT[state]:
            pairs = max(pairs, 1 + self.pairs[j + 1])
        # The one system turn that may stay costs 2 less than by itself.
        return self.alone[i] + 2 * pairs - (2 if state == "" and self.system[i] else 0)

    def moves(self, i: int, state: str) -> list[tuple[str, int, int, str]]:
        """(edit, cost, rows done, last role) in ASCII order."""
        wanted = _NEXT[state]
        if i == self.n:
            return [("I", 2, i, wanted)] if self.closed and state in ("s", "u") else []
        out = [("D", 3, i + 1, state), ("I", 2, i, wanted)]
        if not self.forced[i]:
            here, late = self.initial[i], self.late[i]
            if here == wanted or (here == "s" and state == ""):
                out.append(("K", late, i + 1, here))
            if here != wanted:
                out.append(("R", 2 + late, i + 1, wanted))
        return out

    def ends(self, i: int, state: str, goal: str | None) -> bool:
        return i == self.n and (state in ("", "a") if goal is None else state == goal)

    def descent(self, state: str) -> tuple[int, str]:
        """The edits of a greedy descent to a legal end."""
        i, cost, audit = 0, 0, ""
        while not self.ends(i, state, None):
            options = self.moves(i, state)
            if i < self.n and audit.endswith("I"):
                options = [m for m in options if m[0] != "I"]
            edit, step, i, state = min(options, key=lambda m: (m[1] + self.bound(m[2], m[3]), m[0]))
            cost, audit = cost + step, audit + edit
        return cost, audit

    def best(self, state: str = "", goal: str | None = None) -> tuple[int, str] | None:
        """The least (cost, audit) from a role to a legal end, or to the role *goal*; None without any."""
        cheapest, least = self.descent(state) if self.closed and goal is None else (_FAR, "")
        table: dict[tuple[int, str], int] = {}
        stack = [(0, state, 0, "")]
        while stack:
            i, role, cost, audit = stack.pop()
            hope = cost + self.bound(i, role)
            if hope > cheapest or (hope == cheapest and audit > least[: len(audit)]):
                continue
            if table.get((i, role), _FAR) <= cost:
                continue
            table[i, role] = cost
            if self.ends(i, role, goal) and (cost, audit) < (cheapest, least):
                cheapest, least = cost, audit
            for edit, step, j, after in reversed(self.moves(i, role)):
                stack.append((j, after, cost + step, audit + edit))
        return None if cheapest == _FAR else (cheapest, least)


def fault_of(text: str, seen: bool) -> int:
    """The first fault of a row."""
    rest = text.rstrip(WHITE)
    if not rest:
        return BLANK
    if seen:
        return DUPLICATE
    return FINE if rest[-1] in ".!?" else TRUNCATED


class _Editor:
    """Applies edits to rows that arrive one at a time, and counts what it sees."""

    def __init__(self, conv, keep: bool):
        self.conv, self.keep = conv, keep
        self.faults = [0, 0, 0, 0]
        self.illegal = self.turns = self.cost = self.place = 0
        self.first_turn = self.last_turn = self.before = None
        self.state = ""
        self.audits: list[str] = []
        self.digest = hashlib.sha256()
        self.out: list[tuple] = []

    def edits(self, audit: str) -> None:
        self.audits.append(audit)
        self.ahead = iter(audit)

    def _say(self, edit: str, role: str, text: str, state: str) -> None:
        self.state = state
        self.digest.update(("\n" if self.place else "").encode() + f"{role}:{text}".encode())
        if self.keep:
            self.out.append((self.conv, self.place, edit, role, text))
        self.place += 1

    def _insert(self) -> None:
        self.cost += 2
        wanted = _NEXT[self.state]
        self._say("I", _NAMES[wanted], "", wanted)

    def row(self, turn: int | None, role: str, text: str, fault: int) -> None:
        initial = role[:1]
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        self.faults[fault] += 1
        if turn is not None:
            if self.first_turn is None:
                self.first_turn = turn
            self.turns += self.last_turn != turn
            self.last_turn = turn
        for edit in self.ahead:
            if edit == "I":
                self._insert()
                continue
            wanted = _NEXT[self.state]
            if edit == "D":
                self.cost += 3
            else:
                self.cost += (fault == TRUNCATED) + (2 if edit == "R" else 0)
                if edit == "R":
                    self._say(edit, _NAMES[wanted], text, wanted)
                else:
                    self._say(edit, role, text, initial)
            break

    def report(self) -> tuple:
        for _ in self.ahead:
            self._insert()
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        return (
            self.conv,
            min(gaps, (1 << 63) - 1),
            self.faults[BLANK],
            self.faults[DUPLICATE],
            self.faults[TRUNCATED],
            self.illegal,
            self.cost,
            "".join(self.audits),
            self.digest.hexdigest(),
        )


def _report_schema(conv: T.DataType) -> T.StructType:
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return T.StructType([
        T.StructField("conv", conv),
        *[T.StructField(c, T.LongType()) for c in counts],
        T.StructField("audit", T.StringType()),
        T.StructField("repaired_sha256", T.StringType()),
    ])


def _message_schema(conv: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("conv", conv),
        T.StructField("place", T.LongType()),
        T.StructField("edit", T.StringType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
    ])


def _batches(rows: Iterator[tuple], schema: T.StructType, size: int = 2048) -> Iterator[pa.RecordBatch]:
    from pyspark.sql.pandas.types import to_arrow_schema

    shape, held, weight = to_arrow_schema(schema), [], 0
    for r in rows:
        held.append(r)
        weight += sum(len(v) for v in r if isinstance(v, str))
        if len(held) >= size or weight > 1 << 22:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, h)) for h in held], shape)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, h)) for h in held], shape)


def _records(batches) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*[c.to_pylist() for c in b.columns])


def _runs(records: Iterator[tuple]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """Neighbouring records with the same first value; each run must be used up."""
    held = next(records, None)

    def run():
        nonlocal held
        key = held[0]
        while held is not None and held[0] == key:
            yield held
            held = next(records, None)

    while held is not None:
        some = run()
        yield held[0], some
        for _ in some:
            pass


def _short(rows: DataFrame, schema: T.StructType, keep: bool) -> DataFrame:
    """Whole conversations, one after the other."""

    def run(batches):
        def results():
            for conv, records in _runs(_records(batches)):
                seen: set[tuple[str, str]] = set()
                taken, facts = [], []
                for _, turn, role, text in records:
                    fault = fault_of(text, (role, text) in seen)
                    seen.add((role, text))
                    taken.append((turn, role, text, fault))
                    facts.append((role[:1], fault))
                editor = _Editor(conv, keep)
                editor.edits(Search(facts, True).best()[1])
                for r in taken:
                    editor.row(*r)
                report = editor.report()
                yield from editor.out if keep else [report]

        yield from _batches(results(), schema)

    order = ["conv", "turn", "role", F.xxhash64("text"), "text"]
    return rows.repartition("conv").sortWithinPartitions(*order).mapInArrow(run, schema)


def _segments(ordered: DataFrame, repeated: DataFrame, conv: T.DataType, bits: int) -> DataFrame:
    """conv, seg, and cost and edits of each segment for each (role before, role after)."""
    rest = F.rtrim("text", F.lit(WHITE))
    fine = F.right(rest, F.lit(1)).isin(".", "!", "?")
    facts = ordered.select(
        "conv", "pos", F.substring("role", 1, 1).alias("initial"),
        F.when(rest == "", BLANK).when(fine, FINE).otherwise(TRUNCATED).alias("fault"),
    )
    facts = facts.join(repeated.select("pos", F.lit(True).alias("again")), "pos", "left").withColumn(
        "fault", F.when(F.col("again"), DUPLICATE).otherwise(F.col("fault"))
    )
    # A group has no more rows than a stretch of positions.
    groups = facts.groupBy("conv", F.shiftright("pos", bits).alias("stretch")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "initial", "fault"))).alias("rows")
    )

    schema = T.StructType([
        T.StructField("conv", conv),
        T.StructField("seg", T.LongType()),
        T.StructField("costs", T.ArrayType(T.LongType())),
        T.StructField("audits", T.ArrayType(T.StringType())),
    ])

    def run(batches):
        def results():
            for conv_id, rows in _records(batches):
                search = Search([(r["initial"], r["fault"]) for r in rows], False)
                found = [search.best(a, b) for a in STATES for b in STATES]
                yield conv_id, rows[0]["pos"], [f and f[0] for f in found], [f and f[1] for f in found]

        yield from _batches(results(), schema, 64)

    return groups.select("conv", "rows").mapInArrow(run, schema)


def _ahead(segments: DataFrame) -> DataFrame:
    """seg, and the cost from each role after it to the end of the conversation."""
    schema = T.StructType([T.StructField("seg", T.LongType()), T.StructField("ahead", T.ArrayType(T.LongType()))])

    def run(batches):
        def results():
            for _, records in _runs(_records(batches)):
                ahead = [_TO_END[s] for s in STATES]
                for _, seg, costs in records:
                    yield seg, ahead
                    ahead = [
                        min((c + ahead[b] for b, c in enumerate(costs[4 * a : 4 * a + 4]) if c is not None))
                        for a in range(4)
                    ]

        yield from _batches(results(), schema)

    rows = segments.select("conv", "seg", "costs").repartition("conv")
    return rows.sortWithinPartitions("conv", F.desc("seg")).mapInArrow(run, schema)


def _chosen(segments: DataFrame, ahead: DataFrame, conv: T.DataType) -> DataFrame:
    """conv, seg, and for each role before it the role after it and its edits."""
    schema = T.StructType([
        T.StructField("conv", conv),
        T.StructField("seg", T.LongType()),
        T.StructField("after", T.ArrayType(T.IntegerType())),
        T.StructField("audits", T.ArrayType(T.StringType())),
    ])

    def run(batches):
        def results():
            for conv_id, seg, costs, audits, ahead in _records(batches):
                picks = [
                    min(
                        (costs[4 * a + b] + ahead[b], audits[4 * a + b], b)
                        for b in range(4)
                        if costs[4 * a + b] is not None
                    )
                    for a in range(4)
                ]
                yield conv_id, seg, [p[2] for p in picks], [p[1] for p in picks]

        yield from _batches(results(), schema, 64)

    both = segments.join(ahead, "seg").select("conv", "seg", "costs", "audits", "ahead")
    return both.mapInArrow(run, schema)


def _taken(chosen: DataFrame) -> DataFrame:
    """seg, and the edits that a conversation takes there; the last one's with those at the end."""
    schema = T.StructType([
        T.StructField("seg", T.LongType()),
        T.StructField("before", T.IntegerType()),
        T.StructField("tail", T.StringType()),
    ])

    def run(batches):
        def results():
            for _, records in _runs(_records(batches)):
                before, seg, state = 0, None, 0
                for _, at, after in records:
                    if seg is not None:
                        yield seg, before, ""
                    seg, before, state = at, state, after[state]
                yield seg, before, _TAIL[STATES[state]]

        yield from _batches(results(), schema)

    rows = chosen.select("conv", "seg", "after").repartition("conv").sortWithinPartitions("conv", "seg")
    paths = rows.mapInArrow(run, schema)
    edits = F.concat(F.element_at("audits", F.col("before") + 1), "tail")
    return chosen.join(paths, "seg").select("conv", "seg", edits.alias("edits"))


def _long(rows: DataFrame, schema: T.StructType, keep: bool, job: Scratch, bits: int) -> DataFrame:
    """Conversations of any length, cut into segments."""
    conv = rows.schema["conv"].dataType
    # Equal rows may lie in any order, so a number of their own may tell them apart.
    order = ["conv", "turn", "role", "hash", "tie"]
    spread = rows.withColumn("hash", F.xxhash64("text")).withColumn("tie", F.monotonically_increasing_id())
    ordered = spread.repartitionByRange(*order).sortWithinPartitions("conv", "turn", "role", "hash", "text", "tie")
    ordered = job.write(
        ordered.select("conv", "turn", "role", "text", F.monotonically_increasing_id().alias("pos")), "ordered"
    )
    whose = F.coalesce(F.concat(F.lit("="), F.col("conv").cast("string")), F.lit(""))
    parts = [F.concat(F.length(c).cast("string"), F.lit(":"), c) for c in (whose, F.col("role"), F.col("text"))]
    marks = ordered.filter(F.rtrim("text", F.lit(WHITE)) != "").select(
        "conv", "pos", F.sha2(F.concat(*parts).cast("binary"), 256).alias("mark")
    )
    first = marks.groupBy("mark").agg(F.min("pos").alias("first"))
    repeated = job.write(marks.join(first, "mark").filter("pos > first").select("conv", "pos"), "repeated")
    segments = job.write(_segments(ordered, repeated, conv, bits), "segments")
    chosen = job.write(_chosen(segments, _ahead(segments), conv), "chosen")
    taken = _taken(chosen)

    nothing = F.lit(None)
    marked = (
        taken.select("conv", F.col("seg").alias("pos"), F.lit(0).alias("kind"), nothing.cast("bigint").alias("turn"),
                     nothing.cast("string").alias("role"), F.col("edits").alias("text"))
        .unionByName(repeated.select("conv", "pos", F.lit(1).alias("kind"), nothing.cast("bigint").alias("turn"),
                                     nothing.cast("string").alias("role"), nothing.cast("string").alias("text")))
        .unionByName(ordered.select("conv", "pos", F.lit(2).alias("kind"), "turn", "role", "text"))
    )

    def run(batches):
        def results():
            for conv_id, records in _runs(_records(batches)):
                editor, again = _Editor(conv_id, keep), False
                for _, _, kind, turn, role, text in records:
                    if kind == 0:
                        editor.edits(text)
                    elif kind == 1:
                        again = True
                    else:
                        editor.row(turn, role, text, fault_of(text, again))
                        again = False
                    if editor.out:
                        yield from editor.out
                        editor.out = []
                report = editor.report()
                yield from editor.out if keep else [report]

        yield from _batches(results(), schema)

    return marked.repartition("conv").sortWithinPartitions("conv", "pos", "kind").mapInArrow(run, schema)


def _run(
    rows: DataFrame, conv: str, turn: str, role: str, text: str, keep: bool, longest: int, bits: int
) -> DataFrame:
    spark = rows.sparkSession
    job = Scratch(spark, "conversations")
    plain = rows.select(
        F.col(conv).alias("conv"),
        F.col(turn).cast("bigint").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
    )
    kind = plain.schema["conv"].dataType
    schema = _message_schema(kind) if keep else _report_schema(kind)
    sizes = plain.groupBy("conv").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    wide = (F.col("n") > longest) | (F.col("bytes") > MOST_BYTES)
    large = job.write(sizes.filter(wide).select(F.col("conv").alias("large")), "large")
    if large.isEmpty():
        out = _short(plain, schema, keep)
    else:
        same: Column = F.col("conv").eqNullSafe(F.col("large"))
        out = _short(plain.join(large, same, "left_anti"), schema, keep).unionByName(
            _long(plain.join(large, same, "left_semi"), schema, keep, job, bits)
        )
    return out.withColumnRenamed("conv", conv)


def repair(
    rows: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    longest: int = LONGEST,
    bits: int = SEGMENT_BITS,
) -> DataFrame:
    """One row per conversation: its faults, the cost and list of edits, and the repaired text's digest."""
    return _run(rows, conv, turn, role, text, False, longest, bits)


def messages(
    rows: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    longest: int = LONGEST,
    bits: int = SEGMENT_BITS,
) -> DataFrame:
    """The repaired conversations: one row per message with its place, edit (K, R, I), role and text."""
    return _run(rows, conv, turn, role, text, True, longest, bits)
