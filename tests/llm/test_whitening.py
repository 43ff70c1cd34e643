"""Whitening against numpy's eigenvectors and exact integers."""

import numpy as np
import pytest

from shelfwatch.llm import whitening
from shelfwatch.llm.queries import op13_whitening

DDL = "vec_id long, embedding array<double>"


def plain(vectors):
    x = np.array([[int(np.floor(1024 * c)) + 100_000 for c in v] for v in vectors], object)
    n, sums = len(x), x.sum(axis=0)
    deviations = [int(d) for d in ((n * x - sums) ** 2).sum(axis=1)]
    centred = ((n * x - sums) / n).astype(float)
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    return n, deviations, centred, values[::-1], directions[:, ::-1]


def compared(rows, vectors, ids, k):
    n, deviations, centred, values, directions = plain(vectors)
    got = {(r["vec_id"], r["component"]): r for r in rows}
    assert len(rows) == len(got) == len(ids) * k
    white = np.array([[got[i, j + 1]["whitened"] for j in range(k)] for i in ids])
    want = centred @ directions[:, :k] / np.sqrt(values[:k])
    want = want * np.sign((want * white).sum(axis=0))
    assert np.abs(white - want).max() < 1e-8
    assert [int(got[i, 1]["deviation"]) for i in ids] == deviations
    first = got[ids[0], 1]
    assert first["n"] == n and first["identity_error"] < 1e-10
    explained = [got[ids[0], j + 1]["explained"] for j in range(k)]
    assert np.allclose(explained, values[:k] / values.sum(), rtol=1e-10)


@pytest.mark.parametrize("dim,n,least", [(3, 50, 64), (12, 300, 64), (40, 120, 10)])
def test_equals_numpy(spark, dim, n, least):
    draw = np.random.default_rng(dim)
    vectors = draw.standard_normal((n, dim)) * np.linspace(4, 0.5, dim)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, DDL).repartition(3)
    got = whitening.whiten(frame, least=least).collect()
    compared(got, vectors, list(range(n)), min(dim, 8))


def test_leaves_out_what_has_no_place(spark):
    draw = np.random.default_rng(1)
    vectors = draw.standard_normal((60, 4))
    good = [(i, [float(c) for c in v]) for i, v in enumerate(vectors)]
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0, 3.0]), (103, [1.0, float("nan"), 0.0, 0.0]),
           (104, [float("inf"), 0.0, 0.0, 0.0]), (105, [1e200, 0.0, 0.0, 0.0]), (106, [1.0, 2.0])]
    rows = spark.createDataFrame(good + bad, DDL).selectExpr("*", "7 AS n", "'a' AS i", "1 AS component")
    got = whitening.whiten(rows).collect()
    compared(got, vectors, [i for i, _ in good], 4)
    assert got[0]["i"] == "a" and got[0].asDict().keys() == {"vec_id", "i", *whitening.ADDED}


def test_tables_without_spread(spark):
    assert whitening.whiten(spark.createDataFrame([], DDL)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [0.5, 0.5])] * 5, DDL)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [0.5, 0.25])], DDL)).collect() == []


def test_fewer_dimensions_than_components(spark):
    """A repeated and two zero eigenvalues: the rest is orthogonal and whole."""
    corners = [[4.0 * a, 4.0 * b, 0.0, 1.0] for a in (-1, 1) for b in (-1, 1)]
    rows = [(i, corners[i % 4]) for i in range(40)]
    got = whitening.whiten(spark.createDataFrame(rows, DDL)).collect()
    assert len(got) == 80 and got[0]["identity_error"] < 1e-12
    assert abs(got[0]["explained"] - 0.5) < 1e-12


def test_deviations_beyond_a_long(spark):
    rows = [(i, [float(i * 2.0**20), 0.0]) for i in range(1000)]
    got = {r["vec_id"]: int(r["deviation"]) for r in whitening.whiten(spark.createDataFrame(rows, DDL)).collect()}
    n, deviations, *_ = plain([v for _, v in rows])
    assert max(deviations) > 1 << 63
    assert got == dict(enumerate(deviations))


def test_registered_query(spark, tmp_path):
    vectors = np.random.default_rng(2).standard_normal((80, 10)).astype(np.float32)
    rows = [(i, [float(c) for c in v], 1) for i, v in enumerate(vectors)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    frame = op13_whitening(spark, str(tmp_path))
    assert dict(frame.dtypes)["deviation"] == "bigint"
    compared(frame.collect(), vectors.astype(float), list(range(80)), 8)
