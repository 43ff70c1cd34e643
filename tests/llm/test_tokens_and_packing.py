"""Token counts and packing against the tokenizers' own libraries, and packings by rule."""

from __future__ import annotations

import json
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfwatch.llm import packing, token_counts
from shelfwatch.llm.tokens import Counter, Memory, WordIds, tokenizer_digest
from shelfwatch.llm import tokens

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

ODD = [
    "", " ", "\n", "a  b\n\nc \t\n d", " lead", "trail  ", "a \nb", "It's THE'LL x's''s", "nul\x00l \x00",
    "<|endoftext|>", "a<|endoftext|> b  <|endoftext|>", "<|startoftext|>hi<|END <|", "!!\x1c!! q\x1c\x1dq",
    "x\x85y\xa0z　w v", "ſ İstanbul ΣΑΣ \xe9 é ﬁ \xbd \xb23 ٣",
    "\U0001f469‍\U0001f469 ok", "中文 日本語", "\xc0\xd6\xdf \xb5m \xaa\xba", "same same same" * 50,
]


@pytest.fixture
def docs(spark):
    rows = [(i, t, "keep") for i, t in enumerate(ODD)] + [(100, None, None), (3, ODD[3], "keep"), (None, "no id", "k")]
    return spark.createDataFrame(rows, "doc_id long, text string, n_bytes string")


def test_counts_equal_the_library():
    for path in (BYTES, WORDS):
        library = Tokenizer.from_file(path)
        assert Counter(path).count(ODD) == [len(library.encode(t, add_special_tokens=False).ids) for t in ODD]
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert Counter(PIECES).count(ODD) == [len(library.encode(t)) for t in ODD]


def test_ids_equal_the_library():
    library, own = Tokenizer.from_file(WORDS), WordIds(WORDS)
    assert own.fast is not None
    for text, packed in zip(ODD, own.encode([t.encode() for t in ODD])):
        assert np.frombuffer(packed, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_every_entry_merges_to_itself():
    """What makes merging by ranks equal to merging by the list of merges."""
    with open(WORDS, encoding="utf-8") as file:
        model = json.load(file)["model"]
    rank = {(tuple(m.split(" ")) if isinstance(m, str) else tuple(m)): i for i, m in enumerate(model["merges"])}
    for entry in model["vocab"]:
        if entry.startswith("<|"):
            continue
        end = entry.endswith("</w>") and len(entry) > 4
        parts = list(entry[:-4] if end else entry)
        if end:
            parts[-1] += "</w>"
        while len(parts) > 1:
            best, i = min((rank.get(p, 1 << 30), i) for i, p in enumerate(zip(parts, parts[1:])))
            if best == 1 << 30:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        assert parts == [entry]


def test_memory_keeps_what_is_asked_for(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT", 3)
    memory, made = Memory(), []

    def work(new):
        made.extend(new)
        return [(c, c * 2) for c in new]

    for chunks in ({"a", "b"}, {"a", "c"}, {"a", "d", "e"}, {"a", "b"}, {"x", "y", "z", "w"}, {"a"}):
        memory.fill(chunks, work)
        assert all(memory.young[c] == c * 2 for c in chunks)
    assert made.count("a") == 1


def test_counts_through_the_cache(spark, docs, tmp_path, monkeypatch):
    cache = str(tmp_path / "cache")
    library = Tokenizer.from_file(BYTES)
    first = token_counts.count_tokens(docs, BYTES, cache, limit=20).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    assert len(first) == docs.count()
    for r in first:
        n = len(library.encode(texts[r["doc_id"]], add_special_tokens=False).ids)
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len(texts[r["doc_id"]].encode()), n > 20)

    store = token_counts.CountCache(spark, cache, tokenizer_digest(BYTES))
    stored = store.rows().count()
    assert stored == len(set(texts.values()))
    again = token_counts.count_tokens(docs, BYTES, cache, limit=20).collect()
    assert sorted(map(str, again)) == sorted(map(str, first)) and store.rows().count() == stored
    # Stored counts are what is used: a changed one shows.
    more = spark.createDataFrame([(7, "fresh text"), (8, ODD[3])], "doc_id long, text string")
    store.append(spark.createDataFrame([(ODD[3],)], "t string").select(
        F.unhex(F.sha2(F.col("t").cast("binary"), 256)).alias("digest"), F.lit(1000).cast("bigint").alias("n_tokens")))
    out = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(more, BYTES, cache).collect()}
    assert out[8] == 1000 and out[7] == 2
    assert token_counts.count_tokens(docs.limit(0), BYTES, cache).count() == 0


def _check_packing(rows, capacity):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_pieces_and_packing(spark, docs):
    library = Tokenizer.from_file(WORDS)
    long = " ".join(f"word{i}" for i in range(3000))
    rows = docs.unionByName(spark.createDataFrame([(200, long, "x")], docs.schema))
    table = packing.pieces(rows, WORDS, with_ids=True, capacity=256)
    got = {}
    for r in table.collect():
        got.setdefault(r["doc_id"], []).append(r)
    for doc_id, text in [(r["doc_id"], r["text"] or "") for r in rows.collect()]:
        ids = library.encode(text, add_special_tokens=False).ids + [0]
        parts = [ids[a : a + 256] for a in range(0, len(ids), 256)]
        own = sorted(got[doc_id], key=lambda r: r["piece"])[:: 2 if doc_id == 3 else 1]
        assert [r["ids"] for r in own] == parts
        assert [r["start"] for r in own] == list(range(0, len(ids), 256))
        assert [r["ids_crc32"] for r in own] == [zlib.crc32(np.array(p, "<u4").tobytes()) for p in parts]
    packed = packing.pack(table.drop("ids"), capacity=256).collect()
    assert len(packed) == table.count()
    lower = sum(r["length"] for r in packed) / 256
    assert lower <= _check_packing(packed, 256) <= 1.1 * lower + 1


def test_several_parts_and_odd_tables(spark):
    rng = np.random.default_rng(3)
    rows = [(1, int(n), "x") for n in rng.integers(1, 2049, 2000)]
    table = spark.createDataFrame(rows, "doc_id long, length long, offset string")
    out = packing.pack(table, part_rows=500).collect()
    assert sorted(r["length"] for r in out) == sorted(n for _, n, _ in rows)
    lower = sum(n for _, n, _ in rows) / 2048
    assert _check_packing(out, 2048) <= 1.08 * lower
    assert packing.pack(table.limit(0)).count() == 0


@pytest.mark.parametrize("lengths", [[], [1], [2048] * 3, [1] * 5000, [1025] * 9, [700] * 100, [1024] * 8, [2047, 1, 2046, 2]])
def test_part_is_best_where_that_is_known(lengths):
    size = np.array(lengths, np.int64)
    sequence = packing.pack_part(size)
    best = {(): 0, (1,): 1}.get(tuple(lengths))
    if best is None:
        fit = 2048 // max(lengths)
        best = 2 if 2047 in lengths else -(-len(lengths) // fit)
    assert (len(set(sequence.tolist())) == best) and (sequence >= 0).all()


def test_parts_stay_near_the_lower_bound():
    rng = np.random.default_rng(5)
    for draw in (rng.integers(1, 2049, 20000), np.minimum(2048, rng.lognormal(6.4, 1, 20000).astype(int) + 1)):
        sequence = packing.pack_part(draw)
        assert np.bincount(sequence, draw).max() <= 2048
        big = (draw > 1024).sum()
        assert sequence.max() + 1 <= 1.02 * max(big, draw.sum() / 2048)


def test_configurations_reach_the_fractional_optimum():
    shapes, amount = packing.configurations(np.array([600, 900, 1100]), np.array([30.0, 20.0, 10.0]), 2048)
    assert (shapes @ np.array([600, 900, 1100]) <= 2048).all()
    assert np.allclose(shapes.T @ amount, [30, 20, 10]) and amount.sum() == pytest.approx(25.0, abs=1.5)


def test_new_chunks_in_bulk_equal_the_library():
    own = WordIds(WORDS)
    texts = ["it's", "IT'S42x", "a--b''t", "déjà", "ÀÉ'll", "x<|y", "日本", "\x00z", "q\x7fq", "'", "µ²½", "Z9'Re!"]
    chunks = [t.encode() for t in texts]
    found = own._new(chunks)
    assert [found[c] for c in chunks] == own.whole(texts)
    for some in ([chunks[0]], [chunks[3]], [chunks[6]], []):
        assert own._new(some) == {c: found[c] for c in some}


def test_memory_does_not_go_through_all_older_chunks():
    class Old(dict):
        def __iter__(self):
            raise AssertionError("went through all")

    memory = Memory()
    memory.old = Old((i, -i) for i in range(1000))
    memory.fill({5, 2000}, lambda new: [(c, 1) for c in new])
    assert memory.young == {5: -5, 2000: 1}
