"""The embedding join against all pairs, the pruning, and odd vectors."""

from __future__ import annotations

import numpy as np
import pytest

from shelfwatch.llm import embedding_join as ej
from shelfwatch.runtime import Scratch


def _plain(rows, cosine):
    """n_links and component by all pairs of comparable vectors."""
    good = {}
    for i, (_, v) in enumerate(rows):
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float32).astype(float)
            good[i] = x / np.sqrt((x * x).sum())
    n, head = [0] * len(rows), list(range(len(rows)))
    for i in good:
        for j in good:
            if j < i and len(good[i]) == len(good[j]) and good[i] @ good[j] >= cosine:
                n[i] += 1
                n[j] += 1
                old, new = head[i], head[j]
                head = [new if h == old else h for h in head]
    least = {}
    for h, (key, _) in zip(head, rows):
        least[h] = min((k for k in (least.get(h), key) if k is not None), default=None)
    return [(key, links, least[h]) for (key, _), links, h in zip(rows, n, head)]


def _vectors(seed=1, dim=12):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(14, dim))
    rows = []
    for i in range(220):
        c = centers[rng.integers(14)]
        rows.append(list(map(float, np.float32(c + rng.normal(0, 0.25, dim)))))
    rows += [rows[0]] * 6 + [[2 * x for x in rows[1]]] + [[-x for x in rows[2]]]
    return [(int(k), v) for k, v in zip(rng.permutation(len(rows)), rows)]


ODD = [
    (900, None), (901, []), (902, [0.0] * 12), (903, [float("nan")] + [1.0] * 11), (904, [float("inf")] * 12),
    (905, [None] + [1.0] * 11), (906, [1.0, 0.0]), (907, [2.0, 0.0]), (907, [1.0, 0.1]), (None, [1.0, 0.0]),
    (908, [-0.0] * 12), (None, None),
]


@pytest.mark.parametrize("block", [16, 1024])
def test_join_equals_all_pairs(spark, block):
    rows = _vectors() + ODD
    df = spark.createDataFrame([(k, v, "s") for k, v in rows], "vec_id long, embedding array<float>, kept string")
    out = ej.join(df, block=block).collect()
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in out), key=str)
    assert got == sorted(_plain(rows, 0.9), key=str)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in out)


def test_far_blocks_are_skipped(spark):
    rng = np.random.default_rng(2)
    rows = []
    for c in range(6):  # six tight bundles at right angles
        for i in range(30):
            v = rng.normal(0, 0.01, 8)
            v[c] += 1
            rows.append((c * 30 + i, list(map(float, v))))
    df = spark.createDataFrame(rows, "vec_id long, v array<float>").selectExpr("v", "vec_id least", "1L n")
    job = Scratch(spark, "test-blocks")
    epsilon = (2 - 2 * 0.9) ** 0.5
    blocks = job.write(ej._numbered(job.write(ej._blocks(df, ej.principal(df, 8), epsilon, 10, 3), "raw")), "blocks")
    places = sorted(r["place"] for r in blocks.select("place").collect())
    assert places == list(range(len(places))) and len(places) >= 18
    pairs = {(r["pa"], r["pb"]) for r in ej._near_blocks(blocks, 8, epsilon, job, fan=2).collect()}
    assert all((p, p) in pairs for p in places) and len(pairs) < len(places) ** 2 / 4


def test_empty_and_single(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ej.join(empty).count() == 0
    one = spark.createDataFrame([(4, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in ej.join(one).collect()] == [(4, 0, 4, True)]


def test_double_input_and_clashing_names(spark):
    rows = [(1, [1e200, 1e200, 0.0]), (2, [1.0, 1.0, 0.001]), (3, [0.0, 0.0, 1e-300]), (4, [1.0, 1.0, 0.001 + 1e-12])]
    names = "vec_id long, embedding array<double>, n long, v string, met long, component string, least int, kept int"
    df = spark.createDataFrame([(k, v, 7, "v", 8, "c", 9, 0) for k, v in rows], names)
    out = {r["vec_id"]: r for r in ej.join(df).collect()}
    assert {k: (r["n_links"], r["component_id"], r["kept"]) for k, r in out.items()} == {
        1: (2, 1, True), 2: (2, 1, False), 3: (0, 3, True), 4: (2, 1, False)}
    assert all((r["n"], r["v"], r["met"], r["component"], r["least"]) == (7, "v", 8, "c", 9) for r in out.values())


def test_few_pairs_of_the_given_table_are_multiplied_in_full():
    import pyarrow.parquet as pq

    table = pq.read_table("/root/testdata/sf0.1/embeddings.parquet")["embedding"].to_pylist()
    x = np.unique(np.array(table, np.float32), axis=0)
    unit = ej._unit(x.astype(float))
    axes = np.linalg.eigh(np.cov(unit.T))[1][:, ::-1]
    work = ej.BlockJoin(axes, 0.9, len(x), "<f4")
    side, ones = work.side(x.tobytes()), np.ones(len(x), np.int64)
    out = work.meet(0, side, ones, 0, side, ones)
    assert work.compared < work.all_pairs / 20
    cosines = unit @ unit.T
    np.fill_diagonal(cosines, 0)
    assert (0 if out is None else out[2].sum()) == (cosines >= 0.9).sum()
