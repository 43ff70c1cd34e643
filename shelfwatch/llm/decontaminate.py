"""Benchmark decontamination: n-gram windows of test items found in training texts.

The windows of the items (``width`` consecutive words; a shorter item is one
window) become a hash set: arrays of sorted hashes and of the places of their words
in one buffer, about 40 bytes a window. It is sent to every task and holds at most
about ``block_windows`` windows; a larger benchmark goes in blocks of that size,
each scanning the texts once and written before the next block is read, so driver
and tasks hold one block at a time. A task rolls the hashes of all word windows of
its texts in numpy, looks them up, compares the words of every hit with the item's,
and marks the words inside true hits.

Words are runs of digits, letters and characters beyond ASCII, with A-Z lower-cased.
Null texts and items have no words. Items that share a window each count; an item
given twice under one id counts once, and items without an id mark words but are
not counted. Repeated documents get equal results. An empty benchmark marks
nothing. Result columns replace input columns of the same name; the others pass
through.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwatch.llm.textbatch import LOWER, WORD_BYTE, mix, prefix_sums, runs, span_hash, spans
from shelfwatch.runtime import Scratch

_STEP = np.uint64(0xD6E8FEB86659FD93)


def _word_table(data: np.ndarray, at: np.ndarray):
    """Lower-cased bytes and the start, end, row and hash of each word."""
    low = LOWER[data]
    start, end, row = spans(WORD_BYTE[data], at)
    return low, start, end, row, span_hash(prefix_sums(low), start, end)


def _window_hash(word: np.ndarray, size: int) -> np.ndarray:
    """Hash of the *size* words that begin at each word."""
    n = len(word) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(size):
        total = total * _STEP + word[j : j + n]
    return mix(total)


def _words(low: np.ndarray, start: np.ndarray, end: np.ndarray, first: int, size: int) -> bytes:
    return b" ".join(low[start[i] : end[i]].tobytes() for i in range(first, first + size))


class Windows:
    """The windows of some items: by length, sorted hashes and where the words behind each stand."""

    #: Bits of the first look-up table.
    BITS = 22

    def __init__(self, items: list[tuple[str | None, str | None]], width: int):
        self.ids = [item for item, _ in items]
        texts = [(text or "").encode() for _, text in items]
        at = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        self.low, start, end, row, word = _word_table(np.frombuffer(b"".join(texts), np.uint8), at)
        self.start, self.end, self.row = start.astype(np.int64), end.astype(np.int64), row.astype(np.int32)
        # Windows do not cross items; an item with fewer words than the width is one window.
        words = np.bincount(row, minlength=len(items)) if len(items) else np.zeros(0, np.int64)
        sizes = np.minimum(words, width)
        self.by_size: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for size in np.unique(sizes[sizes > 0]).tolist():
            rolled = _window_hash(word, size)
            first = np.flatnonzero((row[: len(rolled)] == row[size - 1 :]) & (sizes[row[: len(rolled)]] == size))
            first = first[np.argsort(rolled[first], kind="stable")]
            known = rolled[first]
            table = np.zeros(1 << self.BITS, bool)
            table[(known >> np.uint64(64 - self.BITS)).astype(np.int64)] = True
            self.by_size[size] = table, known, first

    def owners(self, size: int, rolled: np.uint64, words: bytes) -> list[int]:
        """The items that hold these very words as a window of *size*."""
        _, known, first = self.by_size[size]
        a, b = np.searchsorted(known, rolled, "left"), np.searchsorted(known, rolled, "right")
        return [
            int(self.row[p]) for p in first[a:b].tolist() if _words(self.low, self.start, self.end, p, size) == words
        ]

    def scan(self, data: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int, set[str], np.ndarray]]:
        """For each text: its words, how many are hit, the items found, hit byte spans."""
        low, start, end, row, word = _word_table(data, at)
        change = np.zeros(len(word) + 1, np.int64)
        found: dict[int, set[str]] = defaultdict(set)
        met: dict[bytes, list[int]] = {}  # of these texts, so no larger than they are
        for size, (table, known, _) in self.by_size.items():
            rolled = _window_hash(word, size)
            maybe = np.flatnonzero(table[(rolled >> np.uint64(64 - self.BITS)).astype(np.int64)])
            maybe = maybe[row[maybe] == row[maybe + size - 1]]
            place = np.minimum(np.searchsorted(known, rolled[maybe]), len(known) - 1)
            for first in maybe[known[place] == rolled[maybe]].tolist():
                words = _words(low, start, end, first, size)
                if words not in met:
                    met[words] = self.owners(size, rolled[first], words)
                if met[words]:  # the words are the same, not only their hash
                    change[first] += 1
                    change[first + size] -= 1
                    found[int(row[first])].update(self.ids[k] for k in met[words] if self.ids[k] is not None)
        hit = np.cumsum(change[:-1]) > 0
        bounds = np.searchsorted(row, np.arange(len(at)))
        for i in range(len(at) - 1):
            a, b = bounds[i], bounds[i + 1]
            own = np.flatnonzero(hit[a:b]) + a
            edges = np.zeros((0, 2), np.int64)
            if len(own):
                cut = np.flatnonzero(np.diff(own) > 1)
                firsts, lasts = own[np.r_[0, cut + 1]], own[np.r_[cut, len(own) - 1]]
                edges = np.stack([start[firsts], end[lasts]], axis=1) - at[i]
            yield int(b - a), len(own), found.get(i, set()), edges


def _blocks(benchmark: DataFrame, item: str, text: str, width: int, block_windows: int) -> Iterator[list]:
    """Items in blocks of a bounded number of windows (an upper estimate from their bytes)."""
    items = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text")).distinct()
    weight = F.floor(F.octet_length(F.coalesce("text", F.lit(""))) / 2) + 1
    total = items.agg(F.sum(weight).alias("n")).first()["n"] or 0
    blocks = max(1, -(-int(total) // block_windows))
    if blocks == 1:
        yield [(r["item"], r["text"]) for r in items.orderBy("item", "text").collect()]
        return
    # Twice as many blocks as the mean asks for, since hashing deals out unevenly.
    blocks *= 2
    for k in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        yield [(r["item"], r["text"]) for r in part.orderBy("item", "text").collect()]


RESULT = "n_words bigint, n_hit bigint, items array<string>, hit_spans array<struct<start:bigint,end:bigint>>"


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    width: int = 10,
    block_windows: int = 2_000_000,
    keep_text: bool = False,
) -> DataFrame:
    """Add the number of words, of hit words, the item ids found, and hit spans in bytes.

    With one block nothing is shuffled or written. Of several blocks each adds its
    spans to those found before, the number of hit words comes from their union, and
    the rows are written between blocks.
    """
    added = ["n_words", "n_hit", "items", "hit_spans"]
    frame = docs.drop(*[c for c in added if c in docs.columns])
    job, last = Scratch(docs.sparkSession, "decontaminate"), None
    for k, rows in enumerate(_blocks(benchmark, item, item_text, width, block_windows)):
        if k:
            written = job.write(frame, "block")
            if last is not None:
                job.drop(last)
            frame = last = written
        frame = _scan(frame, Windows(rows, width), text, first=k == 0)
    return frame if keep_text else frame.drop(text)


def _scan(frame: DataFrame, windows: Windows, text: str, first: bool) -> DataFrame:
    added = T._parse_datatype_string(RESULT)
    schema = T.StructType(frame.schema.fields + added.fields) if first else frame.schema
    kept = [n for n in schema.names if n not in added.names]
    types = [pa.int64(), pa.int64(), pa.list_(pa.string()),
             pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]

    def merged(data, at, k, spans_now, before):
        """Union of the spans of two blocks, and the words inside."""
        edges = sorted([*map(tuple, spans_now.tolist()), *((s["start"], s["end"]) for s in before)])
        out: list[list[int]] = []
        for s, e in edges:
            if out and s <= out[-1][1]:
                out[-1][1] = max(out[-1][1], e)
            else:
                out.append([s, e])
        body = data[at[k] : at[k + 1]]
        start, _, _ = spans(WORD_BYTE[body], np.array([0, len(body)]))
        return out, sum(int(((start >= s) & (start < e)).sum()) for s, e in out)

    def run(batches):
        for b in batches:
            cells: list[list] = [[], [], [], []]
            old = None if first else b.select(["items", "hit_spans"]).to_pylist()
            for begin, data, at in runs(b.column(text)):
                for k, (n, hits, items, edges) in enumerate(windows.scan(data, at)):
                    spans_out = edges.tolist()
                    if old and old[begin + k]["hit_spans"]:
                        before = old[begin + k]
                        spans_out, hits = merged(data, at, k, edges, before["hit_spans"])
                        items = items | set(before["items"])
                    for cell, value in zip(
                        cells, (n, hits, sorted(items), [{"start": s, "end": e} for s, e in spans_out])
                    ):
                        cell.append(value)
            arrays = {c: pa.array(v, t) for c, v, t in zip(added.names, cells, types)}
            yield pa.RecordBatch.from_arrays(
                [b.column(n) if n in kept else arrays[n] for n in schema.names], schema.names
            )

    return frame.mapInArrow(run, schema)


def remove_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents in which no window of the benchmark occurs, as they were."""
    marked = find(docs, benchmark, text, keep_text=True, **options)
    return marked.filter("n_hit = 0").select(*docs.columns)


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """All documents, the hit spans cut out of the texts."""
    marked = find(docs, benchmark, text, keep_text=True, **options)
    names, places = docs.columns, docs.schema

    def cut(batches):
        for b in batches:
            bodies = b.column(text).to_pylist()
            for i, found in enumerate(b.column("hit_spans").to_pylist()):
                if found:
                    body, out, last = bodies[i].encode(), [], 0
                    for s in found:
                        out.append(body[last : s["start"]])
                        last = s["end"]
                    bodies[i] = b"".join([*out, body[last:]]).decode()
            yield pa.RecordBatch.from_arrays(
                [pa.array(bodies, b.column(text).type) if n == text else b.column(n) for n in names], names
            )

    return marked.select(*names, "hit_spans").mapInArrow(cut, places)


def items_digest(items: str = "items") -> Column:
    """The hash of the ids found, sorted as text."""
    return F.sha2(F.array_join(F.array_sort(items), ",").cast("binary"), 256)

