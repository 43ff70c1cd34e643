"""Conversation repair against every list of edits, and long conversations against short ones."""

import hashlib
import itertools
import random
import zlib
from heapq import heappop, heappush

import pytest

from shelfwatch.llm import conversations as cv
from shelfwatch.llm.queries import op11_conversations

NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
DDL = "conv_id long, turn long, role string, text string"


def plain_best(facts):
    """Least (cost, audit) of all edits, in order of cost: another way than the operator's."""
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, state = heappop(heap)
        if i == len(facts) and state in ("", "a"):
            return cost, audit
        if (i, state) in done:
            continue
        done.add((i, state))
        want = NEXT[state]
        heappush(heap, (cost + 2, audit + "I", i, want))
        if i < len(facts):
            initial, fault = facts[i]
            heappush(heap, (cost + 3, audit + "D", i + 1, state))
            if fault in (cv.FINE, cv.TRUNCATED):
                late = fault == cv.TRUNCATED
                if initial == want or (initial == "s" and state == ""):
                    heappush(heap, (cost + late, audit + "K", i + 1, initial))
                heappush(heap, (cost + 2 + late, audit + "R", i + 1, want))


def plain_report(rows):
    """The contract's columns of one conversation's rows in order."""
    seen, facts = set(), []
    for _, role, text in rows:
        bare = text.strip(cv.WHITE)
        fault = cv.BLANK if not bare else cv.DUPLICATE if (role, text) in seen else cv.FINE if bare[-1] in ".!?" else cv.TRUNCATED
        seen.add((role, text))
        facts.append((role[:1], fault))
    cost, audit = plain_best(facts)
    out, state, left = [], "", iter(zip(rows, facts))
    for edit in audit:
        want = NEXT[state]
        if edit == "I":
            out.append({"u": "user:", "a": "assistant:"}[want])
            state = want
            continue
        (_, role, text), (initial, _) = next(left)
        if edit == "K":
            out.append(f"{role}:{text}")
            state = initial
        elif edit == "R":
            out.append({"u": "user:", "a": "assistant:"}[want] + text)
            state = want
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    faults = [f for _, f in facts]
    pairs = [a + b for (a, _), (b, _) in itertools.pairwise(facts)]
    return (
        gaps, faults.count(cv.BLANK), faults.count(cv.DUPLICATE), faults.count(cv.TRUNCATED),
        sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
        hashlib.sha256("\n".join(out).encode()).hexdigest(),
    )


def collected(frame):
    return {r["conv_id"]: tuple(r)[1:] for r in frame.collect()}


def test_search_finds_the_least_of_all_edits():
    kinds = [(i, f) for i in ("u", "a", "s", "x") for f in (cv.FINE, cv.TRUNCATED)] + [("u", cv.BLANK), ("a", cv.DUPLICATE)]
    for n in range(4):
        for facts in itertools.product(kinds, repeat=n):
            assert cv.Search(list(facts), True).best() == plain_best(facts), facts
    draw = random.Random(5)
    for n in [5, 9, 30, 200, 700]:
        for _ in range(40 if n < 100 else 4):
            facts = [(draw.choice("uuuaas"), draw.choice([0, 0, 0, 1, 2, 3])) for _ in range(n)]
            assert cv.Search(facts, True).best() == plain_best(facts)


def test_bound_never_exceeds_the_rest():
    draw = random.Random(6)
    for _ in range(300):
        facts = [(draw.choice(["u", "a", "s", ""]), draw.choice([0, 0, 1, 2, 3])) for _ in range(draw.randrange(7))]
        assert cv.Search(facts, True).bound(0, "") <= plain_best(facts)[0]


def random_rows(draw, convs, longest):
    rows = []
    for conv in convs:
        for _ in range(draw.randrange(1, longest)):
            turn = draw.choice([None, *range(longest)])
            rows.append((conv, turn, draw.choice(["user", "assistant", "system", "tool", "", None]),
                         draw.choice(["Hi.", "So", " ", "", "Well? ", "Ünd\n", None, "a" * 50, "b!", "c", "d."])))
    return rows


def in_order(spark, rows):
    """Rows of a conversation as the operator orders them; null role and text are one space."""
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(rows, DDL).fillna(" ", ["role", "text"])
    ordered = frame.orderBy("conv_id", "turn", "role", F.xxhash64("text"), "text").collect()
    return {k: [tuple(r)[1:] for r in g] for k, g in itertools.groupby(ordered, key=lambda r: r["conv_id"])}


@pytest.mark.parametrize("longest,bits", [(1024, 9), (3, 2)])
def test_repair_equals_plain(spark, longest, bits):
    draw = random.Random(7)
    rows = random_rows(draw, [None, 1, 2, 3, 4, 5], 20)
    got = collected(cv.repair(spark.createDataFrame(rows, DDL), longest=longest, bits=bits))
    assert got == {k: plain_report(v) for k, v in in_order(spark, rows).items()}


def test_messages_give_the_digest(spark):
    draw = random.Random(8)
    frame = spark.createDataFrame(random_rows(draw, [1, 2, 3], 12), DDL)
    for longest in (1024, 3):
        reports = collected(cv.repair(frame, longest=longest, bits=2))
        said = {}
        for r in cv.messages(frame, longest=longest, bits=2).orderBy("conv_id", "place").collect():
            said.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
        for conv, report in reports.items():
            assert hashlib.sha256("\n".join(said.get(conv, [])).encode()).hexdigest() == report[-1]


def test_odd_tables(spark):
    assert cv.repair(spark.createDataFrame([], DDL)).collect() == []
    rows = [(1, 0, "user", "x" * 300_000 + "."), (1, 1, "assistant", "Yes.")]
    clash = spark.createDataFrame(rows, DDL).selectExpr("*", "1 AS conv", "2 AS pos", "'z' AS audit", "3 AS n")
    assert collected(cv.repair(clash))[1][6] == "KK"
    assert collected(cv.repair(clash, longest=1, bits=1))[1][6] == "KK"
    far = [(1, -(1 << 63), "user", "A."), (1, (1 << 63) - 1, "assistant", "B.")]
    assert collected(cv.repair(spark.createDataFrame(far, DDL)))[1][0] == (1 << 63) - 1
    nulls = spark.createDataFrame([(1, None, None, None), (1, None, None, None)], DDL)
    assert collected(cv.repair(nulls))[1][:7] == (0, 2, 0, 0, 1, 6, "DD")


def test_registered_query(spark, tmp_path):
    draw = random.Random(9)
    rows = [(c, t, r, x) for c in range(60) for t, (r, x) in enumerate(
        [("system", "Be kind.")] * (c % 3 == 0) + [(("user", "assistant")[i % 2], f"Line {c} {i}.\nEnd!") for i in range(draw.randrange(9))]
    )] + [(None, None, None, None), (70, None, "user", "Odd."), (71, 3, None, "Even")]
    spark.createDataFrame(rows, DDL).write.parquet(f"{tmp_path}/conversations.parquet")
    broken = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else "".join(ch for ch in text if ch not in ".!?") if kind == 2 else text
        if kind:
            broken += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    want = {k: plain_report(v) for k, v in in_order(spark, broken).items()}
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    got = collected(op11_conversations(spark, str(tmp_path)))
    assert got == {c: want.get(c, empty) for c in {r[0] for r in rows}}
