"""Best-fit packing of documents into sequences by a linear grouping scheme.

Documents become pieces of at most ``capacity`` tokens; only longer ones are cut.
Pieces are dealt out evenly, whatever their keys, into parts of a bounded number,
and every part is packed by itself:

1. pieces over 0.45 of the capacity are ordered by length and cut into groups
   of equal cardinality, each group rounded up to its longest piece;
2. with so few sizes left, the fewest sequences are found as a linear programme
   over configurations (column generation with a knapsack table) and rounded down;
3. the actual pieces take the places of their group, which leaves them some room;
4. what is left and the small pieces go best-fit, longest first, into that room
   and then into new sequences.

A part holds only numbers, not texts or ids. Empty and null documents are packed
like others (their closing token). Repeated rows are packed as often as they
occur. Ties are taken in the order of the part. An empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructField, StructType

from shelfwatch.llm.textbatch import runs
from shelfwatch.llm.tokens import WordIds, loaded
from shelfwatch.runtime import Scratch

CAPACITY = 2048
END = (0).to_bytes(4, "little")


def pieces(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text",
    capacity: int = CAPACITY, with_ids: bool = False,
) -> DataFrame:
    """Pieces of each document: ``key, piece, start, length, ids_crc32`` and, if asked, ``ids``."""
    fields = [docs.schema[key], StructField("piece", T.IntegerType())]
    fields += [StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32")]
    if with_ids:
        fields.append(StructField("ids", T.ArrayType(T.IntegerType())))
    schema = StructType(fields)

    def run(batches):
        words = loaded(WordIds, tokenizer)
        for b in batches:
            for first, data, at in runs(b.column(text)):
                texts = [data[a:e].tobytes() for a, e in zip(at[:-1], at[1:])]
                source, number, start, length, crc, ids = [], [], [], [], [], []
                for k, packed in enumerate(words.encode(texts)):
                    packed += END
                    for n, a in enumerate(range(0, len(packed), 4 * capacity)):
                        part = packed[a : a + 4 * capacity]
                        source.append(first + k)
                        number.append(n)
                        start.append(a // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        if with_ids:
                            ids.append(np.frombuffer(part, "<i4"))
                arrays = [
                    b.column(key).take(pa.array(source, pa.int64())), pa.array(number, pa.int32()),
                    *[pa.array(x, pa.int64()) for x in (start, length, crc)],
                ]
                if with_ids:
                    arrays.append(pa.array(ids, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return docs.select(key, text).mapInArrow(run, schema)


# -- one part ----------------------------------------------------------------


def _best_configuration(sizes: np.ndarray, value: np.ndarray, capacity: int) -> tuple[np.ndarray, float]:
    """The multiset of sizes within the capacity with the largest value."""
    best = np.zeros(capacity + 1)
    layers = []
    room = np.arange(capacity + 1)
    for _ in range(capacity // int(sizes.min())):
        take = np.where(room >= sizes[:, None], value[:, None] + best[np.maximum(room - sizes[:, None], 0)], -1)
        pick = take.argmax(axis=0)
        top = take[pick, room]
        better = top > best + 1e-12
        if not better.any():
            break
        layers.append(np.where(better, pick, -1))
        best = np.where(better, top, best)
    count, left = np.zeros(len(sizes), np.int64), capacity
    for pick in reversed(layers):
        if pick[left] >= 0:
            count[pick[left]] += 1
            left -= sizes[pick[left]]
    return count, float(count @ value)


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, steps: int = 400):
    """Configurations and how many sequences of each an optimal fractional packing has."""
    k = len(sizes)
    basis = np.diag(capacity // sizes).astype(float)
    for _ in range(steps):
        inverse = np.linalg.inv(basis)
        amount = inverse @ demand
        price = np.ones(k) @ inverse
        column, worth = _best_configuration(sizes, np.maximum(price, 0), capacity)
        if worth <= 1 + 1e-7:
            break
        direction = inverse @ column
        ratio = np.where(direction > 1e-9, amount / np.where(direction > 1e-9, direction, 1), np.inf)
        basis[:, int(ratio.argmin())] = column
    return basis.round().astype(np.int64).T, np.maximum(np.linalg.inv(basis) @ demand, 0)


class _Open:
    """Sequences by the room they have left; the smallest room that fits comes first."""

    def __init__(self, capacity: int):
        self.by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.mask = 0

    def add(self, sequence: int, room: int) -> None:
        if room > 0:
            self.by_room[room].append(sequence)
            self.mask |= 1 << room

    def take(self, size: int) -> tuple[int, int] | None:
        fits = self.mask >> size
        if not fits:
            return None
        room = size + (fits & -fits).bit_length() - 1
        sequence = self.by_room[room].pop()
        if not self.by_room[room]:
            self.mask &= ~(1 << room)
        return sequence, room


def pack_part(length: np.ndarray, capacity: int = CAPACITY, groups: int = 64, small: float = 0.45) -> np.ndarray:
    """The sequence of each piece of a part, by the linear grouping scheme."""
    sequence = np.full(len(length), -1, np.int64)
    order = np.argsort(-length, kind="stable")
    full = order[length[order] >= capacity]
    sequence[full] = np.arange(len(full))
    n = len(full)
    big = order[(length[order] < capacity) & (length[order] > small * capacity)]
    room = np.zeros(0, np.int64)
    if len(big):
        # Equal cardinality, so group borders are ranks; equal sizes then merge.
        cut = np.unique(np.linspace(0, len(big), min(groups, len(big)) + 1).astype(int))
        size = length[big[cut[:-1]]]
        sizes, group_of = np.unique(size, return_inverse=True)
        members = [[] for _ in sizes]
        for g, a, b in zip(group_of, cut[:-1], cut[1:]):
            members[g].append(big[a:b])
        members = [np.concatenate(m) for m in members]
        demand = np.array([len(m) for m in members], float)
        shapes, amount = configurations(sizes, demand, capacity)
        used = np.zeros(len(sizes), np.int64)
        for shape, times in zip(shapes, np.floor(amount + 1e-9).astype(np.int64)):
            for g in np.flatnonzero(shape):
                # The same number of places of this group in each sequence.
                own = members[g][used[g] : used[g] + shape[g] * times]
                sequence[own] = n + np.arange(len(own)) // shape[g]
                used[g] += len(own)
            n += int(times)
    room = np.full(n, capacity) - np.bincount(sequence[sequence >= 0], length[sequence >= 0], n).astype(np.int64)
    spare = _Open(capacity)
    for s, r in enumerate(room.tolist()):
        spare.add(s, r)
    sizes_left = length.tolist()
    for piece in order[sequence[order] < 0].tolist():
        size = sizes_left[piece]
        found = spare.take(size)
        if found is None:
            found = n, capacity
            n += 1
        sequence[piece] = found[0]
        spare.add(found[0], found[1] - size)
    return sequence


def pack(table: DataFrame, length: str = "length", capacity: int = CAPACITY, part_rows: int = 60000) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to each piece; lengths are 1 to *capacity*.

    Rows go round-robin to parts of about *part_rows*, so a key with many rows is
    spread like any other. The result is written, so that an executor lost later
    does not pack anew in another order.
    """
    spark = table.sparkSession
    job = Scratch(spark, "packing")
    rows = job.write(table.drop("sequence_id", "offset"), "pieces")
    parts = max(1, round(rows.count() / part_rows))
    added = [StructField("__local", T.LongType()), StructField("offset", T.LongType())]
    schema = StructType(rows.schema.fields + added)

    def run(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        part = pa.Table.from_batches(held).combine_chunks()
        size = part.column(length).to_numpy()
        sequence = pack_part(size, capacity)
        order = np.lexsort((-size, sequence))
        ends = np.cumsum(size[order])
        first = np.flatnonzero(np.r_[True, np.diff(sequence[order]) > 0])
        begin = np.repeat(ends[first] - size[order][first], np.diff(np.r_[first, len(order)]))
        offset = np.empty(len(order), np.int64)
        offset[order] = ends - size[order] - begin
        full = part.append_column("__local", pa.array(sequence)).append_column("offset", pa.array(offset))
        yield from full.to_batches(max_chunksize=1 << 14)

    packed = rows.repartition(parts).mapInArrow(run, schema)
    packed = packed.withColumn(
        "sequence_id", F.shiftleft(F.spark_partition_id().cast("bigint"), 32) + F.col("__local")
    ).drop("__local")
    out = job.write(packed, "packed")
    job.drop(rows)
    return out
