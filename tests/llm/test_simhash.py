"""SimHash groups against all pairs, shards dealt again, and odd rows."""

from __future__ import annotations

import random
import re

import pytest
import xxhash

from shelfwatch.llm import simhash
from shelfwatch.llm.components import components
from shelfwatch.runtime import Scratch

SCHEMA = "doc_id long, text string, fingerprint string, component_id int"


def _print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def _groups(prints, radius=3):
    """Group heads by flooding over all pairs."""
    head = list(range(len(prints)))
    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= radius:
                old, new = head[i], head[j]
                head = [new if h == old else h for h in head]
    return head


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(1)
    words = ["river", "Stone", "été", "x", "field\tgate", "über", "a" * 40]
    texts = [None, "", "  \n ", "one", "One", "two words", "TWO words", "İx y z"]
    for _ in range(25):
        own = [rnd.choice(words) + str(rnd.randrange(9)) for _ in range(rnd.randrange(3, 90))]
        texts += [" ".join(own)] * rnd.randrange(1, 3)
        for _ in range(rnd.randrange(3)):
            own[rnd.randrange(len(own))] = "edit"
            texts.append(" ".join(own))
    texts.append(" ".join(f"w{i}" for i in range(40_000)))
    return [(i * 7 % 1009, t, "s", 1) for i, t in enumerate(texts)]


def test_groups_equal_all_pairs(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    out = simhash.group(simhash.add_fingerprints(df)).withColumn("hex", simhash.hex_print()).collect()
    prints = {r[0]: _print(r[1]) for r in rows}
    ids = sorted(prints)
    heads = _groups([prints[i] for i in ids])
    least = {h: min(i for i, g in zip(ids, heads) if g == h) for h in heads}
    want = {i: (f"{prints[i]:016x}", least[h]) for i, h in zip(ids, heads)}
    assert {r["doc_id"]: (r["hex"], r["component_id"]) for r in out} == want and len(out) == len(rows)


@pytest.mark.parametrize("shard_rows", [1, 4, 2000])
def test_shards_dealt_again_lose_no_link(spark, shard_rows):
    rnd = random.Random(2)
    base = [rnd.getrandbits(64) for _ in range(12)] + [0, 2**64 - 1, 2**63]
    values = set(base)
    for b in base:
        for _ in range(4):
            for _ in range(rnd.randrange(1, 5)):
                b ^= 1 << rnd.randrange(64)
            values.add(b)
    values = sorted(values)
    df = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fingerprint long")
    job = Scratch(spark, "test-links")
    found = simhash.links(df, job, shard_rows=shard_rows)
    pairs = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in found.collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in pairs)
    got = {r["node"] % (1 << 64): r["component"] for r in components(found, job).collect()}
    heads = _groups(values)
    mine = [got.get(v, v) for v in values]
    assert len(set(zip(heads, mine))) == len(set(heads)) == len(set(mine))


def test_bk_tree_finds_what_is_near():
    rnd = random.Random(4)
    values = [rnd.getrandbits(12) for _ in range(300)]
    tree = simhash.BKTree()
    for i, v in enumerate(values):
        tree.add(v, i)
    for q in values[:40]:
        assert sorted(tree.near(q, 3)) == [i for i, v in enumerate(values) if (v ^ q).bit_count() <= 3]


def test_dense_shard_sends_a_link_a_member():
    values = [1 << i for i in range(40)]
    assert len(simhash.shard_links(values, 3)) == 39


def test_components_of_long_and_wide_graphs(spark):
    rnd = random.Random(6)
    order = list(range(200))
    rnd.shuffle(order)
    edges = list(zip(order, order[1:])) + [(1000, 1000 + i) for i in range(1, 60)] + [(5000, 5000), (None, 3)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["component"] for r in components(df, Scratch(spark, "test-cc")).collect()}
    assert got == {**{i: 0 for i in range(200)}, **{1000 + i: 1000 for i in range(60)}}


def test_keep_one_checks_all_rows_of_an_id(spark):
    a, b = "these are the very same words here", "another text of quite other words"
    for odd in (5, None):
        least = 3 if odd else 7
        rows = [(odd, a), (odd, b), (least, b)]
        kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert sorted((r["doc_id"] or -1, r["text"]) for r in kept) == sorted([(odd or -1, a), (least, b)])


def test_keep_one_and_odd_ids(spark):
    text = "these are the very same words here"
    rows = [(3, text), (5, text), (9, "something else entirely now"), (9, "something else entirely now"),
            (9, "a third and different text"), (None, "no id here at all"), (None, text)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted((r["doc_id"] or -1, r["text"]) for r in simhash.keep_one(df).collect())
    assert kept == [(-1, "no id here at all"), (3, text), (9, "a third and different text"), (9, "something else entirely now")]
    assert simhash.keep_one(df.limit(0)).count() == 0
