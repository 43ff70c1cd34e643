"""The toxicity and quality classifiers: cases with known labels, odd rows, brute force."""

from __future__ import annotations

import numpy as np
import pytest

from shelfwatch.llm import quality, toxicity
from shelfwatch.llm.textbatch import RUN_BYTES

WORDS = "the of and with here there was only then under over again more less some field river stone".split()


def _texts(n, seed, bad):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        words = [WORDS[k] + WORDS[j][:2] for k, j in rng.integers(0, len(WORDS), (rng.integers(20, 60), 2))]
        label = int(i % 3 == 0)
        if label:
            words = bad(rng, words)
        rows.append((i, " ".join(words), "en" if i % 2 else "de", label))
    return rows


def _insult(rng, words):
    for _ in range(3):
        words.insert(int(rng.integers(0, len(words))), ["wretch", "vermin" + WORDS[int(rng.integers(0, 9))]][int(rng.integers(0, 2))])
    return words


def _junk(rng, words):
    return [w + "###" if rng.random() < 0.7 else w for w in words]


@pytest.fixture(scope="module")
def net(spark):
    rows = spark.createDataFrame(_texts(300, 1, _insult), "doc_id long, text string, lang string, toxic int")
    return toxicity.fit(rows.drop("toxic"), rows.select("doc_id", "toxic"))


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, t, g, 1 - y) for i, t, g, y in _texts(300, 2, _junk)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int")
    return quality.fit(df.select("doc_id", "text"), df.select("doc_id", "quality"))


def test_toxicity_finds_held_out(spark, net):
    rows = spark.createDataFrame(_texts(150, 9, _insult), "doc_id long, text string, lang string, y int")
    out = toxicity.score(rows, net).collect()
    assert np.mean([r["predicted"] == r["y"] for r in out]) > 0.95
    assert all(r["flagged"] == (r["score"] >= r["threshold"]) and 0 <= r["score"] <= 1 for r in out)


def test_toxicity_language_is_no_input(spark, net):
    text = _texts(3, 5, _insult)[0][1]
    rows = spark.createDataFrame([(1, text, "en"), (2, text, "xx"), (3, text, None)], "doc_id long, text string, lang string")
    assert len({r["score"] for r in toxicity.score(rows, net).collect()}) == 1


def _score_plainly(net, text):
    """All windows of all widths by loops."""
    import re

    body = np.frombuffer(text.encode(), np.uint8)
    views, _ = toxicity.hashed_words(body, np.array([0, len(body)]))
    place = {int(b): i + 1 for i, b in enumerate(net.known)}
    words = [sum(net.embedding[place.get(int(b), 0)] for b in views[:, i]) for i in range(views.shape[1])]
    words += [np.zeros(toxicity.DIM)] * toxicity.WIDEST
    best, column = [], 0
    for width in toxicity.WIDTHS:
        for f in range(toxicity.FILTERS):
            best.append(max(
                sum(words[i + j] @ net.filters[:, column + j * toxicity.FILTERS + f] for j in range(width))
                for i in range(len(words) - toxicity.WIDEST + 1)
            ))
        column += width * toxicity.FILTERS
    x = np.maximum(np.array(best) + net.bias, 0) @ net.out + net.out_bias
    assert re.search("", text) is not None
    return 1 / (1 + np.exp(-x))


def test_toxicity_equals_loops(spark, net):
    texts = [t for _, t, _, _ in _texts(8, 3, _insult)] + ["", "one", "wretch", "two words"]
    rows = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    for r in toxicity.score(rows, net).collect():
        assert r["score"] == pytest.approx(_score_plainly(net, r["text"] if "text" in r else texts[r["doc_id"]]), abs=1e-4)


def test_toxicity_long_text_is_read_to_its_end(spark, net):
    calm = " ".join(["calm"] * (RUN_BYTES // 4))
    rows = [(1, calm, "en"), (2, calm + " wretch vermin wretch", "en"), (3, None, None), (4, "", "en"), (4, "", "en")]
    out = {r["doc_id"]: r["score"] for r in toxicity.score(
        spark.createDataFrame(rows, "doc_id long, text string, lang string"), net).collect()}
    assert out[2] > 0.5 > out[1] and out[3] == out[4]


def test_toxicity_learns_from_long_texts(spark):
    calm = " ".join(["calm"] * 3200)
    rows = [(i, calm + (" wretch" if i % 2 else ""), "en", i % 2) for i in range(40)]
    rows += [(100 + i, "calm", "en", 0) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    out = toxicity.score(df, toxicity.fit(df.drop("toxic"), df.select("doc_id", "toxic"))).collect()
    assert all(r["predicted"] == r["doc_id"] % 2 * (r["doc_id"] < 100) for r in out)


def test_toxicity_learns_from_every_row(spark):
    # Each shard alone is too small to know the rare word; all labelled texts count for the vocabulary.
    rows = _texts(400, 4, _insult) + [(1000 + i, f"calm field rareword {WORDS[i]}", "en", 1) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    docs, labels = df.drop("toxic"), df.select("doc_id", "toxic")
    net = toxicity.fit(docs, labels, shard_rows=60)
    body = np.frombuffer(b"rareword", np.uint8)
    assert set(toxicity.hashed_words(body, np.array([0, 8]))[0][:, 0].tolist()) <= set(net.known.tolist())
    held = spark.createDataFrame(_texts(150, 9, _insult), "doc_id long, text string, lang string, y int")
    assert np.mean([r["predicted"] == r["y"] for r in toxicity.score(held, net).collect()]) > 0.95
    # The order and the tasks of the rows do not matter.
    again = toxicity.fit(docs.orderBy("text").repartition(3), labels.repartition(2), shard_rows=60)
    assert (again.embedding == net.embedding).all() and again.thresholds == net.thresholds


def test_toxicity_trains_in_blocks(spark, net, monkeypatch):
    rng = np.random.default_rng(3)
    texts = [rng.integers(0, len(net.embedding), (toxicity.VIEWS, n)) for n in (0, 1, 7, 40, 3)]
    views = np.concatenate(texts, axis=1)
    seq, begin = toxicity.padded(views, np.repeat(np.arange(5), [t.shape[1] for t in texts]), 5)
    best, where = toxicity._tops(net, seq, begin)
    monkeypatch.setattr(toxicity, "BLOCK", 5)
    small, there = toxicity._tops(net, seq, begin)
    assert np.allclose(best, small, atol=1e-5) and (where == there).mean() > 0.95
    assert np.allclose(np.maximum(best + net.bias, 0), net.maxima(seq, begin), atol=1e-5)


def test_toxicity_odd_tables(spark, net):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert toxicity.score(empty, net).count() == 0
    nothing = toxicity.fit(empty, spark.createDataFrame([], "doc_id long, toxic int"))
    clash = spark.createDataFrame([(1, "a", "en", "x", 2.0)], "doc_id long, text string, lang string, predicted string, score double")
    assert [(r["predicted"], r["score"] < 0.01) for r in toxicity.score(clash, nothing).collect()] == [(0, True)]


def test_quality_finds_held_out(spark, model):
    rows = spark.createDataFrame([(i, t, 1 - y) for i, t, _, y in _texts(150, 8, _junk)], "doc_id long, text string, y int")
    out = quality.score(rows, model).collect()
    assert np.mean([r["predicted"] == r["y"] for r in out]) > 0.95
    assert len(out) == 150 and all(0 <= r["score"] <= 1 for r in out)


def test_quality_learns_a_pair():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    fitted = quality.train(x, y)
    assert fitted.pairs[0][:2] == (0, 1)
    assert ((fitted.score(x) > 0.5) == y).mean() > 0.95


def test_quality_score_adds_table_cells(model):
    x = np.random.default_rng(1).random((20, len(quality.FEATURES))) * 5
    for row, got in zip(x, model.score(x)):
        bins = [int(np.searchsorted(c, v)) for c, v in zip(model.cuts, row)]
        total = model.base + sum(t[b] for t, b in zip(model.single, bins))
        total += sum(t[bins[i], bins[j]] for i, j, t in model.pairs)
        assert got == pytest.approx(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def test_quality_features_by_hand():
    body = "Ab ab! ab 12\nab ab! ab 12\n\xe9".encode()
    f = dict(zip(quality.FEATURES, quality.features(np.frombuffer(body, np.uint8), np.array([0, len(body)]))[0]))
    assert f["log_bytes"] == pytest.approx(np.log1p(len(body)))
    assert f["upper_share"] == pytest.approx(1 / len(body)) and f["digit_share"] == pytest.approx(4 / len(body))
    assert f["distinct_words"] == pytest.approx(5 / 9) and f["top_word"] == pytest.approx(3 / 9)
    assert f["repeated_lines"] == 0 and f["beyond_ascii_share"] == pytest.approx(2 / len(body))


def test_quality_odd_tables(spark, model):
    rows = spark.createDataFrame(
        [(1, None, "p"), (2, "", "p"), (3, "same words", "p"), (3, "same words", "p"), (None, "x" * (2 * RUN_BYTES), "p")],
        "doc_id long, text string, predicted string",
    )
    out = quality.score(rows, model).collect()
    by_text = {r["doc_id"]: r["score"] for r in out}
    assert len(out) == 5 and by_text[1] == by_text[2]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert quality.score(empty, model).count() == 0
    bare = quality.fit(empty, spark.createDataFrame([], "doc_id long, quality int"))
    assert quality.score(rows, bare).first()["score"] == pytest.approx(0.5)
