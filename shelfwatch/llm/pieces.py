"""SentencePiece encoding over a table of distinct chunks, and decoding.

Where no piece of a model goes on past a whitespace marker, a text falls into chunks,
each a run of markers and the word after it, that are segmented independently. Each
distinct chunk of the corpus is segmented once:

* a first pass lists the distinct chunks of each block of documents, dealt by hash
  into slices; a slice holds all blocks' lists of its chunks, the library segments a
  chunk the first time it appears there, and every block gets back the ids,
* a second pass numbers the chunks of each block in order of appearance and keeps a
  document as the numbers at its positions; where a block's ids and documents meet,
  the ids are held and the documents pass, a run at a time.

So no text is shuffled or written and nothing that grows with the corpus is broadcast:
lists of distinct chunks and ids travel, and documents as two or three bytes a word. A
frequent chunk appears once per block, however often it occurs. A task holds the distinct
chunks of one block or of one slice. ``SLICES`` is fixed, so a slice of a very large
corpus grows as its vocabulary does: some tens of megabytes at 100 TB. Both passes must
see the same documents in the same tasks, as reading files does: a table is written
first unless the caller says that it is ``stored``, and a checksum of each block's list
ends the job if the passes still differ.

A model for which chunks are not independent (another kind than BPE, a normaliser
that changes texts, user-defined pieces, pieces across markers) encodes whole texts.
Every id is the library's: without begin or end, without sampling, special strings as
plain text. A null text is empty and has no ids. Repeated rows and ids are rows of
their own; an empty table gives an empty one. The result column replaces one of the
same name, other columns pass through.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from shelfwatch.llm.textbatch import utf8
from shelfwatch.runtime import materialize

MARK = "▁"
SLICES = 1 << 14
BLOCK_CHARS = 1 << 25
#: Ids decoded at once.
RUN_IDS = 1 << 18
#: Bytes of numbered chunks put back at once.
RUN_CODES = 1 << 17
_CHUNK = re.compile(" +[^ ]*")
_LIST, _ORDER, _TEXT = range(3)


@lru_cache(maxsize=4)
def processor(model: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model)


def separable(model: str) -> bool:
    """Whether chunks of a text have the ids that they have in the text."""
    from sentencepiece import sentencepiece_model_pb2

    spec = sentencepiece_model_pb2.ModelProto()
    spec.ParseFromString(processor(model).serialized_model_proto())
    plain, trained = spec.normalizer_spec, spec.trainer_spec
    kinds = spec.SentencePiece.Type
    return (
        trained.model_type == trained.BPE
        and not trained.treat_whitespace_as_suffix
        and not plain.precompiled_charsmap
        and plain.add_dummy_prefix
        and plain.escape_whitespaces
        and not plain.remove_extra_whitespaces
        and any(p.piece == MARK and p.type == kinds.Value("NORMAL") for p in spec.pieces)
        and not any(
            p.type == kinds.Value("USER_DEFINED")
            or (p.type == kinds.Value("NORMAL") and re.search(f"[^{MARK}]{MARK}", p.piece))
            for p in spec.pieces
        )
    )


def chunks(text: str) -> list[str]:
    """The chunks of a text in order, each without its first marker and without spaces.

    The library puts one marker before a text and takes a marker in it for a space.
    """
    if not text:
        return []
    text = text.replace(MARK, " ")
    if text[0] != " " and "  " not in text:
        return text.split(" ")
    return [c[1:].replace(" ", MARK) for c in _CHUNK.findall(" " + text)]


def encode_chunks(model: str, parts: list[str]) -> list[list[int]]:
    sp = processor(model)
    mark = [sp.piece_to_id(MARK)]
    return [ids if part else mark for part, ids in zip(parts, sp.encode(parts, num_threads=1))]


def _groups(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers below 2^28 in 7-bit groups, the lowest first, and where each ends."""
    values = values.astype(np.uint32)
    size = 1 + (values >> 7 > 0) + (values >> 14 > 0) + (values >> 21 > 0)
    ends = np.cumsum(size)
    start = ends - size
    out = np.zeros(int(size.sum()), np.uint8)
    for k in range(4):
        has = size > k
        group = (values[has] >> np.uint32(7 * k)) & np.uint32(127)
        out[start[has] + k] = group | ((size[has] > k + 1).astype(np.uint32) << np.uint32(7))
    return out, ends


def pack(values: np.ndarray) -> bytes:
    """Numbers below 2^28; small ones take a byte."""
    return _groups(values)[0].tobytes()


def _packed(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Rows of packed numbers, *sizes* of them in each."""
    data, ends = _groups(values)
    edges = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(sizes)])].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(edges), pa.py_buffer(data)])


def unpack(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        return np.zeros(0, np.uint32)
    last = raw < 128
    start = np.concatenate([[0], np.flatnonzero(last)[:-1] + 1])
    size = np.diff(np.append(start, len(raw)))
    out = np.zeros(len(start), np.uint32)
    for k in range(int(size.max())):
        has = size > k
        out[has] |= (raw[start[has] + k].astype(np.uint32) & np.uint32(127)) << np.uint32(7 * k)
    return out


def _open(schema: T.StructType) -> list[T.StructField]:
    return [T.StructField(f.name, f.dataType, True) for f in schema]


def _cut(docs: DataFrame, text: str, rest: list[str], lists: bool) -> DataFrame:
    """Blocks of documents: the lists of their chunks, or documents as numbers and the order of the lists."""
    from pyspark.sql.pandas.types import to_arrow_schema

    kept = [] if lists else rest
    own = ["__slice int", "__words string"] if lists else ["__kind int", "__codes binary"]
    schema = T.StructType([
        *_open(docs.select(*kept).schema),
        *T.StructType.fromDDL(", ".join(["__block bigint", "__check bigint", *own])),
    ])

    def run(batches):
        shape = to_arrow_schema(schema)
        types = [f.type for f in shape][: len(kept)]
        part = TaskContext.get().partitionId() << 32
        numbers, held, block = None, 0, part

        def rows(n, columns, check, *own):
            fixed = [pa.array(np.full(n, block)), pa.array([check] * n, pa.int64())]
            typed = [pa.array(v, f.type) for v, f in zip(own, list(shape)[-len(own):])]
            return pa.RecordBatch.from_arrays([*columns, *fixed, *typed], schema=shape)

        def close():
            words = list(numbers)
            marks = np.array([zlib.crc32(w.encode()) for w in words], np.int64)
            check = int((marks * np.arange(1, len(marks) + 1)).sum())
            place = marks % SLICES
            order = np.argsort(place, kind="stable")
            if not lists:
                yield rows(1, [pa.nulls(1, t) for t in types], check, [_ORDER], [pack(order)])
                return
            edges = np.flatnonzero(np.diff(place[order], prepend=-1, append=SLICES))
            some, size, first = [], 0, 0
            for k, (a, b) in enumerate(itertools.pairwise(edges.tolist())):
                some.append(" ".join([words[i] for i in order[a:b].tolist()]))
                size += len(some[-1])
                if size > 1 << 22 or k == len(edges) - 2:
                    yield rows(len(some), [], check, place[order[edges[first : k + 1]]], some)
                    some, size, first = [], 0, k + 1

        for b in batches:
            bodies, a = b.column(text), 0
            columns = [b.column(c).cast(t) for c, t in zip(kept, types)]
            while a < b.num_rows:
                if numbers is None:
                    numbers = defaultdict(itertools.count().__next__)
                codes, first = [], a
                while a < b.num_rows and held < BLOCK_CHARS and a - first < 1000:
                    body = bodies[a].as_py() or ""
                    found = chunks(body)
                    at = np.fromiter(map(numbers.__getitem__, found), np.uint32, len(found))
                    if not lists:
                        codes.append(pack(at))
                    held += len(body) + 1
                    a += 1
                if not lists:
                    n = a - first
                    yield rows(n, [c.slice(first, n) for c in columns], None, [_TEXT] * n, codes)
                if held >= BLOCK_CHARS:
                    yield from close()
                    numbers, held, block = None, 0, block + 1
        if numbers is not None:
            yield from close()

    return docs.select(*kept, text).mapInArrow(run, schema)


def _segmented(lists: DataFrame, model: str) -> DataFrame:
    """The ids of each block's chunks, each distinct chunk segmented once in its slice."""
    schema = "__block bigint, __check bigint, __kind int, __slice int, __codes binary, __ids binary"

    def run(batches):
        known: dict[str, list[int]] = {}
        at = None
        for b in batches:
            if not b.num_rows:
                continue
            slices = b.column("__slice").to_numpy()
            parts = [w.split(" ") for w in b.column("__words").to_pylist()]
            if slices[0] != at:
                known = {}
            fresh = list(dict.fromkeys(w for part in parts for w in part if w not in known))
            known.update(zip(fresh, encode_chunks(model, fresh) if fresh else ()))
            got = [[known[w] for w in part] for part in parts]
            counts = [np.array([len(ids) for ids in some], np.uint32) for some in got]
            flat = np.fromiter(itertools.chain.from_iterable(itertools.chain.from_iterable(got)), np.uint32)
            sizes = np.array([int(c.sum()) for c in counts])
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("__block"),
                    b.column("__check"),
                    pa.array(np.full(b.num_rows, _LIST, np.int32)),
                    b.column("__slice"),
                    _packed(np.concatenate(counts), np.array([len(c) for c in counts])),
                    _packed(flat, sizes),
                ],
                ["__block", "__check", "__kind", "__slice", "__codes", "__ids"],
            )
            # Equal slices follow each other; what follows can only need the last one's chunks.
            if slices[0] != slices[-1]:
                last = np.flatnonzero(slices == slices[-1])
                known = {w: known[w] for i in last for w in parts[i]}
            at = slices[-1]

    rows = lists.repartition("__slice").sortWithinPartitions("__slice")
    return rows.mapInArrow(run, schema)


def _restored(batches, shape: pa.Schema, rest: list[str], model: str | None) -> Iterator[pa.RecordBatch]:
    """Documents with their ids from rows sorted by block and kind; with *model* also their texts.

    Of a block its lists and their order are held, and documents pass in runs of ``RUN_CODES`` bytes.
    """
    differ = RuntimeError("the documents differ between two readings: they are no stored table")
    at = counts = starts = flat = None
    lists: tuple[list, list, set] = ([], [], set())
    for b in batches:
        blocks, kinds = b.column("__block").to_numpy(), b.column("__kind").to_numpy()
        edges = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(kinds) != 0)) + 1
        for first, last in itertools.pairwise([0, *edges.tolist(), b.num_rows] if b.num_rows else []):
            kind, some = kinds[first], b.slice(first, last - first)
            if blocks[first] != at:
                at, counts, lists = blocks[first], None, ([], [], set())
            if kind == _LIST:
                lists[0].extend(some.column("__codes").to_pylist())
                lists[1].extend(some.column("__ids").to_pylist())
                lists[2].update(some.column("__check").unique().to_pylist())
                continue
            if kind == _ORDER:
                listed = unpack(b"".join(lists[0])).astype(np.int64)
                flat = unpack(b"".join(lists[1])).astype(np.int32)
                ranks = unpack(some.column("__codes")[0].as_py())
                if len(ranks) != len(listed) or lists[2] - {some.column("__check")[0].as_py()}:
                    raise differ
                # From the order of the lists to the numbers of the chunks.
                counts, starts = np.zeros_like(listed), np.zeros_like(listed)
                counts[ranks], starts[ranks] = listed, np.cumsum(listed) - listed
                lists = ([], [], set())
                continue
            if counts is None:
                raise differ
            codes, ends = utf8(some.column("__codes"))
            a = 0
            while a < some.num_rows:
                e = max(a + 1, int(np.searchsorted(ends, ends[a] + RUN_CODES, "right")) - 1)
                part = codes[ends[a] : ends[e]]
                numbers = unpack(part.tobytes())
                n = counts[numbers]
                before = np.concatenate([[0], np.cumsum(n)])
                # A number ends with its only byte below 128.
                words = np.concatenate([[0], np.cumsum(part < 128)])[ends[a : e + 1] - ends[a]]
                values = flat[np.arange(before[-1]) + np.repeat(starts[numbers] - before[:-1], n)]
                ids = pa.ListArray.from_arrays(pa.array(before[words].astype(np.int32)), pa.array(values))
                columns = [some.column(c).slice(a, e - a).cast(f.type) for c, f in zip(rest, shape)]
                columns.append(ids.cast(shape.field(len(rest)).type))
                if model is not None:
                    columns.append(_texts(model, ids))
                yield pa.RecordBatch.from_arrays(columns, schema=shape)
                a = e


def _put_back(
    documents: DataFrame, ids: DataFrame, rest: list[str], result: str, model: str, decoded: str | None
) -> DataFrame:
    """The ids at the positions of each document, block by block."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([
        *_open(documents.select(*rest).schema),
        T.StructField(result, T.ArrayType(T.IntegerType())),
        *([T.StructField(decoded, T.StringType())] if decoded else []),
    ])

    def run(batches):
        yield from _restored(batches, to_arrow_schema(schema), rest, model if decoded else None)

    # Sorted, a block's lists come before its order, and that before its documents.
    rows = documents.unionByName(ids, allowMissingColumns=True).repartition("__block")
    return rows.sortWithinPartitions("__block", "__kind", "__slice").mapInArrow(run, schema)


def _whole(docs: DataFrame, model: str, text: str, rest: list[str], result: str) -> DataFrame:
    """Whole texts at once, for models whose chunks depend on each other."""
    schema = T.StructType([
        *_open(docs.select(*rest).schema), T.StructField(result, T.ArrayType(T.IntegerType()))
    ])

    def run(batches):
        sp = processor(model)
        for b in batches:
            ids = [sp.encode(v.as_py() or "") for v in b.column(text)]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in rest], pa.array(ids, pa.list_(pa.int32()))], schema.names
            )

    return docs.select(*rest, text).mapInArrow(run, schema)


def encode(
    docs: DataFrame,
    model: str,
    text: str = "text",
    result: str = "ids",
    stored: bool = False,
    decoded: str | None = None,
) -> DataFrame:
    """Add each text's ids; the text goes.

    *model* is a path that every machine has. With *stored* the documents are a table of
    files, read without a shuffle; otherwise they are written as one first. *decoded* names
    a column for what :func:`decode` makes of the ids, added in the tasks that have them.
    """
    rest = [c for c in docs.columns if c not in (text, result, decoded)]
    if not separable(model):
        rows = _whole(docs, model, text, rest, result)
        return decode(rows, model, result, decoded) if decoded else rows
    if not stored:
        docs = materialize(docs.select(*rest, text), "documents")
    lists, documents = _cut(docs, text, rest, True), _cut(docs, text, rest, False)
    return _put_back(documents, _segmented(lists, model), rest, result, model, decoded)


class Surfaces(NamedTuple):
    """What ids read as: their bytes with markers as spaces, then the same without a first marker."""

    table: pa.LargeBinaryArray
    #: Ids that only add their bytes: plain pieces and single bytes.
    known: np.ndarray
    #: Single bytes beyond ASCII, whose neighbours decide what they read as.
    high: np.ndarray


@lru_cache(maxsize=4)
def surfaces(model: str) -> Surfaces | None:
    """The bytes of each id.

    None if the library does more to plain pieces than joining them and taking the first marker away.
    """
    from sentencepiece import sentencepiece_model_pb2

    sp = processor(model)
    spec = sentencepiece_model_pb2.ModelProto()
    spec.ParseFromString(sp.serialized_model_proto())
    rules = spec.normalizer_spec
    if (
        spec.denormalizer_spec.precompiled_charsmap
        or spec.trainer_spec.treat_whitespace_as_suffix
        or not rules.add_dummy_prefix
        or rules.remove_extra_whitespaces
    ):
        return None
    kinds = spec.SentencePiece.Type
    normal, byte = kinds.Value("NORMAL"), kinds.Value("BYTE")
    plain = np.array([p.type == normal for p in spec.pieces])
    single = np.array([p.type == byte for p in spec.pieces])
    # A byte is spelled <0x0A>; it is never a marker.
    read = [
        bytes([int(p.piece[3:5], 16)]) if p.type == byte else p.piece.replace(MARK, " ").encode()
        for p in spec.pieces
    ]
    bare = [t[1:] if p.type == normal and p.piece.startswith(MARK) else t for p, t in zip(spec.pieces, read)]
    high = single & np.array([t[:1] > b"\x7f" for t in read])
    return Surfaces(pa.array(read + bare, pa.large_binary()), plain | single, high)


def _texts(model: str, some: pa.ListArray) -> pa.Array:
    """The texts of lists of ids; lists with other ids than pieces and bytes go to the library one by one."""
    sp, model_reads, flat = processor(model), surfaces(model), some.flatten()
    if model_reads is None or flat.null_count:
        return pa.array([sp.decode(v) if v else "" for v in some.to_pylist()], pa.string())
    table, known, high = model_reads
    sizes = some.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    edges = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    ids = flat.to_numpy()
    inside = (ids >= 0) & (ids < len(known))
    ids = np.where(inside, ids, 0)

    def having(member: np.ndarray) -> np.ndarray:
        count = np.concatenate([[0], np.cumsum(member)])[edges]
        return count[1:] > count[:-1]

    odd, unsure = having(~(inside & known[ids])), having(high[ids])
    # The first id of a list reads as it does without its marker.
    ids[edges[:-1][sizes > 0]] += len(known)
    # Taken one after the other, the bytes of the ids are those of the texts.
    _, ends, data = table.take(pa.array(ids)).buffers()
    at = np.frombuffer(ends, np.int64)[: len(ids) + 1][edges]
    data = data or pa.py_buffer(b"")
    for i in np.flatnonzero(unsure & ~odd).tolist():
        try:
            str(memoryview(data)[at[i] : at[i + 1]], "utf-8")
        except UnicodeDecodeError:
            odd[i] = True
    # What is left out of the mask is UTF-8; the others are replaced before they are taken for text.
    raw = pa.Array.from_buffers(pa.large_binary(), len(some), [None, pa.py_buffer(at), data])
    if odd.any():
        whole = [sp.decode(some[i].as_py()).encode() for i in np.flatnonzero(odd).tolist()]
        raw = pc.replace_with_mask(raw, pa.array(odd), pa.array(whole, pa.large_binary()))
    return raw.cast(pa.binary()).view(pa.string())


def decode(rows: DataFrame, model: str, ids: str = "ids", result: str = "decoded") -> DataFrame:
    """Add the text that the library makes of the ids; null ids have an empty text."""
    rest = [c for c in rows.columns if c != result]
    schema = T.StructType([*_open(rows.select(*rest).schema), T.StructField(result, T.StringType())])

    def run(batches):
        for b in batches:
            column, first = b.column(ids), 0
            ends = np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            while first < b.num_rows:
                done = int(ends[first - 1]) if first else 0
                last = max(first + 1, int(np.searchsorted(ends, done + RUN_IDS, "right")))
                texts = _texts(model, column.slice(first, last - first))
                kept = [b.column(c).slice(first, last - first) for c in rest]
                yield pa.RecordBatch.from_arrays([*kept, texts], schema.names)
                first = last

    return rows.select(*rest).mapInArrow(run, schema)
