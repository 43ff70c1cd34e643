"""SentencePiece encoding over distinct chunks against the library on whole texts."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import sentencepiece

from shelfwatch.llm import pieces
from shelfwatch.llm.queries import op12_pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "  ", "a", " a", "a ", "  a  b ", "a\tb\n\nc  d", "▁x ▁ y▁z", "<s> </s><unk><0x41> ▁",
    "naïve — 東京都 🙂🙂 \x00 end", " 　x", "é" * 500, "x" * 40_000, "word " * 3000, "ﬁ ① \u0085",
]


def library(text):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    ids = sp.encode(text or "")
    return ids, sp.decode(ids)


def test_numbers_round_trip():
    values = np.array([0, 1, 127, 128, 16383, 16384, 2**21 - 1, 2**21, 2**28 - 1], np.uint32)
    assert (pieces.unpack(pieces.pack(values)) == values).all()
    assert len(pieces.unpack(b"")) == 0 and pieces.pack(np.zeros(0, np.uint32)) == b""


def test_chunks_are_independent():
    assert pieces.separable(MODEL)
    draw = random.Random(3)
    texts = [t for t in ODD if t]
    texts += ["".join(draw.choice(" ab▁\n東é.") for _ in range(draw.randrange(30))) for _ in range(500)]
    for text in texts:
        ids = [i for part in pieces.encode_chunks(MODEL, pieces.chunks(text)) for i in part] if text else []
        assert ids == library(text)[0], repr(text)


def test_encode_and_decode_equal_the_library(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate(ODD * 3)] + [(None, "a b"), (None, "a b")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    clash = frame.selectExpr("*", "'q' AS ids", "1 AS words", "2 AS __kept")
    for size in (pieces.BLOCK_CHARS, 50):
        monkeypatch.setattr(pieces, "BLOCK_CHARS", size)
        got = pieces.decode(pieces.encode(clash, MODEL), MODEL).collect()
        assert got[0].asDict().keys() == {"doc_id", "words", "__kept", "ids", "decoded"}
        assert sorted((str(r["doc_id"]), list(r["ids"]), r["decoded"]) for r in got) == sorted(
            (str(i), *library(t)) for i, t in rows
        )


def test_whole_texts_and_empty_table(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate(ODD)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert pieces.encode(frame.limit(0), MODEL).collect() == []
    nothing = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert pieces.decode(nothing, MODEL).first()["decoded"] == ""
    monkeypatch.setattr(pieces, "separable", lambda model: False)
    got = {r["doc_id"]: list(r["ids"]) for r in pieces.encode(frame, MODEL).collect()}
    assert got == {i: library(t)[0] for i, t in rows}


def test_each_distinct_chunk_is_segmented_once(spark, monkeypatch):
    frame = spark.createDataFrame([(i, f"the same words and w{i % 7}") for i in range(200)], "doc_id long, text string")
    lists = pieces._cut(frame.repartition(4), "text", ["doc_id"], True).select("__slice", "__words").collect()
    where = {}
    for r in lists:
        for w in r["__words"].split(" "):
            where.setdefault(w, set()).add(r["__slice"])
    assert all(len(s) == 1 for s in where.values()) and len(where) == 4 + 7


def test_registered_query(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(ODD)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    want = {}
    for i, t in rows:
        ids, back = library(t)
        digests = [hashlib.sha256(v.encode()).hexdigest() for v in (",".join(map(str, ids)), back)]
        want[i] = (len(ids), *digests)
    assert {r["doc_id"]: tuple(r)[1:] for r in op12_pieces(spark, str(tmp_path)).collect()} == want


def test_joined_pieces_equal_the_library(spark):
    sp = pieces.processor(MODEL)
    rng = np.random.default_rng(5)
    size, mark = sp.get_piece_size(), sp.piece_to_id(pieces.MARK)
    rows = [rng.integers(0, size, n).tolist() for n in (1, 2, 3, 50, 400)]
    rows += [[], None, [mark], [mark, mark, 900], [0], [1, mark, 900], list(range(size)), [900, 2, 901]]
    rows += [sp.encode(t) for t in ("a  b", "  lead", "tail  ", "é\u2581ü \x00 日本", "🙂 ok", "\n\tx")]
    got = pieces._texts(MODEL, pa.array(rows, pa.list_(pa.int32()))).to_pylist()
    assert got == [sp.decode(r) if r else "" for r in rows]
    assert pieces.surfaces(MODEL) is not None
    cut = pa.array(rows, pa.list_(pa.int32())).slice(3, 6)
    assert pieces._texts(MODEL, cut).to_pylist() == got[3:9]


def test_plain_texts_are_not_decoded_one_by_one(monkeypatch):
    """Ids of plain pieces do not pass through Python lists."""
    sp = pieces.processor(MODEL)
    ids = pa.array([sp.encode("some plain words")], pa.list_(pa.int32()))

    class Refuses:
        def decode(self, _):
            raise AssertionError("decoded alone")

    pieces.surfaces(MODEL)
    monkeypatch.setattr(pieces, "processor", lambda _: Refuses())
    assert pieces._texts(MODEL, ids).to_pylist() == ["some plain words"]


def test_bytes_equal_the_library():
    """Single bytes, whole characters of bytes and broken ones, at the start and within."""
    sp = pieces.processor(MODEL)
    byte = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    mark, word = sp.piece_to_id(pieces.MARK), sp.encode("some word")
    runs = ["\n", " ", " a", "\0", "é", "東", "🙂", "▁", "�"]
    rows = [[byte[b] for b in run.encode()] for run in runs]
    rows += [[byte[b] for b in run] for run in (b"\xe6", b"\x9d\xb1", b"\xed\xa0\x80", b"\xc0\x80", b"\xf4\x90\x80\x80", b"\xffa")]
    rows += [a + b for a in rows for b in ([mark], word, [byte[10]])] + [word + r + word for r in rows] + [[mark, *r] for r in rows]
    rows += [[byte[0xE6], 2, byte[0x9D], byte[0xB1]], [byte[0xE6], *word, byte[0x9D], byte[0xB1]]]
    got = pieces._texts(MODEL, pa.array(rows, pa.list_(pa.int32()))).to_pylist()
    assert got == [sp.decode(r) for r in rows]


def test_texts_with_bytes_are_not_decoded_one_by_one(monkeypatch):
    """Line ends are byte pieces; a text with them is joined like others."""
    texts = ["one line\nanother\n\nthe last", "\n🙂 rare \x07\n", "plain"]
    ids = pa.array([pieces.processor(MODEL).encode(t) for t in texts], pa.list_(pa.int32()))

    class Refuses:
        def decode(self, _):
            raise AssertionError("decoded alone")

    pieces.surfaces(MODEL)
    monkeypatch.setattr(pieces, "processor", lambda _: Refuses())
    assert pieces._texts(MODEL, ids).to_pylist() == texts


def test_blocks_pass_in_runs(monkeypatch):
    """Documents of a block leave in small batches, whatever the block holds."""
    words = ["a", "bb", "the"]
    ids = pieces.encode_chunks(MODEL, words)
    lists = [1, pieces._LIST, 9, pieces.pack(np.array([len(i) for i in ids])), pieces.pack(np.concatenate(ids))]
    order = [1, pieces._ORDER, 9, pieces.pack(np.array([2, 0, 1])), None]  # so 2 is "a", 0 is "bb", 1 is "the"
    numbers = [[i % 3] * (i % 50) for i in range(1000)]
    texts = [[1, pieces._TEXT, None, pieces.pack(np.array(n, np.uint32)), None] for n in numbers]
    names = ["__block", "__kind", "__check", "__codes", "__ids"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
    rows = [lists, order, *texts]
    whole = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
    shape = pa.schema([("ids", pa.list_(pa.int32())), ("decoded", pa.string())])
    monkeypatch.setattr(pieces, "RUN_CODES", 100)
    for cut in (1002, 7, 1):
        batches = [whole.slice(a, cut) for a in range(0, 1002, cut)]
        got = list(pieces._restored(iter(batches), shape, [], MODEL))
        assert max(b.num_rows for b in got) <= 100 and len(got) > 200
        found = [r for b in got for r in b.to_pylist()]
        assert [r["decoded"] for r in found] == [" ".join(["bb", "the", "a"][k] for k in n) for n in numbers]
        assert [r["ids"] for r in found] == [[j for k in n for j in ids[[1, 2, 0][k]]] for n in numbers]


def test_registered_query_holds_no_block_as_a_group(spark, tmp_path):
    spark.createDataFrame([(1, "a\nb")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    plan = op12_pieces(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "CoGroup" not in plan and plan.count("MapInArrow") == 4
