"""SimHash near-duplicates: fingerprints of word shingles, linked through BK-trees.

A fingerprint has a bit for each of 64 positions, set if more than half of the
hashes of the text's shingles have it. Equal fingerprints fold to one. Two that
differ in at most ``radius`` (3) bits agree on one of ``radius + 1`` equal blocks
of bits, so fingerprints are dealt into shards by the value of each block. A shard
becomes a BK-tree, children keyed by their integer Hamming distance to the parent;
a look-up follows only the edges within the radius, and only links that join two
groups of the shard leave it, so a dense shard sends one link a member and not all
pairs.

A shard of more than ``shard_rows`` fingerprints is dealt again by blocks of the
bits not yet agreed on, as often as needed; after five rounds at most 2^15
fingerprints can share all agreed bits. A shard's tree goes to its task with the
shard's rows: broadcasting trees to all tasks would grow with the corpus.

Null and wordless texts have fingerprint zero and are linked like others. A text
of fewer words than a shingle is one shingle. Null ids take part; a group's id is
the smallest id in it (null if it has none). Repeated rows are in one group. Result
columns replace input columns of the same name; the others pass through.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwatch.llm.components import components
from shelfwatch.llm.textbatch import utf8
from shelfwatch.runtime import Scratch

SEED = 42
BITS = 64
#: Shingles whose bits are counted at once.
BLOCK = 1 << 14


def fingerprint(body: bytes, shingle: int = 3) -> int:
    """The unsigned 64-bit fingerprint of a UTF-8 text."""
    words = body.lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not words:
        return 0
    if len(words) < shingle:
        grams, n = [b" ".join(words)], 1
    else:
        n = len(words) - shingle + 1
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64, n)
    count = np.zeros(BITS, np.int64)
    for a in range(0, n, BLOCK):
        part = hashes[a : a + BLOCK].astype("<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(count * 2 > n, bitorder="little").view("<u8")[0])


def add_fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3, keep_text: bool = False) -> DataFrame:
    """Add ``fingerprint`` (the 64 bits as a signed long); the text goes unless *keep_text*."""
    base = docs.drop("fingerprint")
    fields = [f for f in base.schema.fields if keep_text or f.name != text]
    schema = T.StructType(fields + [T.StructField("fingerprint", T.LongType())])
    names = schema.names

    def run(batches):
        for b in batches:
            data, at = utf8(b.column(text))
            found = np.fromiter(
                (fingerprint(data[a:e].tobytes(), shingle) for a, e in zip(at[:-1], at[1:])),
                np.uint64, len(at) - 1,
            )
            yield pa.RecordBatch.from_arrays(
                [b.column(n) for n in names[:-1]] + [pa.array(found.view(np.int64))], names
            )

    return base.mapInArrow(run, schema)


class BKTree:
    """Integers by Hamming distance: a node's children are keyed by their distance to it."""

    def __init__(self):
        self.root: list | None = None

    def near(self, value: int, radius: int) -> list[int]:
        """Places of the members within *radius* of *value*."""
        found, todo = [], [self.root] if self.root else []
        while todo:
            own, place, children = todo.pop()
            d = (own ^ value).bit_count()
            if d <= radius:
                found.append(place)
            if children:
                for k in range(d - radius, d + radius + 1):
                    child = children.get(k)
                    if child:
                        todo.append(child)
        return found

    def add(self, value: int, place: int) -> None:
        node = [value, place, {}]
        if self.root is None:
            self.root = node
            return
        at = self.root
        while True:
            d = (at[0] ^ value).bit_count()
            child = at[2].get(d)
            if child is None:
                at[2][d] = node
                return
            at = child


def shard_links(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that connect the members of a shard as all pairs within the radius would."""
    tree, head, links = BKTree(), list(range(len(values))), []

    def top(i):
        while head[i] != i:
            head[i] = head[head[i]]
            i = head[i]
        return i

    for i, value in enumerate(values):
        for j in tree.near(value, radius):
            a, b = top(i), top(j)
            if a != b:
                head[a] = b
                links.append((value, values[j]))
        tree.add(value, i)
    return links


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _finer(mask: int, parts: int) -> list[int]:
    """The mask with each of *parts* blocks of its open bits added."""
    left = [i for i in range(BITS) if not mask >> i & 1]
    cuts = [round(k * len(left) / parts) for k in range(parts + 1)]
    return [mask | sum(1 << i for i in left[a:b]) for a, b in zip(cuts, cuts[1:])]


def links(prints: DataFrame, job: Scratch, radius: int = 3, shard_rows: int = 2000) -> DataFrame:
    """Links ``a, b`` that connect all distinct ``fingerprint`` within *radius* bits."""
    masks = _finer(0, radius + 1)
    first = F.explode(F.array(*[F.lit(_signed(m)).cast("bigint") for m in masks]))
    opened, found = prints.select(F.col("fingerprint").alias("f"), first.alias("mask")), None
    while True:
        rows = opened.withColumn("value", F.col("f").bitwiseAND(F.col("mask")))
        last = BITS - masks[0].bit_count() <= 15
        large = None
        if not last:
            counts = rows.groupBy("mask", "value").count().filter(F.col("count") > shard_rows)
            large = job.write(counts.drop("count"), "large-shards")
            if large.isEmpty():
                large = None
        small = rows if large is None else rows.join(large, ["mask", "value"], "left_anti")
        here = job.write(_shards(small, radius), "shard-links")
        found = here if found is None else found.unionByName(here)
        if large is None:
            return found
        steps = [(_signed(m), _signed(x)) for m in masks for x in _finer(m, radius + 1)]
        masks = [x % (1 << 64) for _, x in steps]
        # At most 4^5 rows: the masks of a level.
        table = F.broadcast(prints.sparkSession.createDataFrame(steps, "mask bigint, next bigint"))
        again = rows.join(large, ["mask", "value"], "left_semi").select("f", "mask").join(table, "mask")
        opened = job.write(again.select("f", F.col("next").alias("mask")), "open")


def _shards(rows: DataFrame, radius: int) -> DataFrame:
    """Links of each (mask, value) shard; a shard's rows stand together in one task."""

    def run(batches):
        held_key, held = None, np.zeros(0, np.int64)

        def close(values):
            pairs = shard_links([int(v) for v in values.view(np.uint64)], radius)
            ends = np.array(pairs, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(ends[:, 0].copy()), pa.array(ends[:, 1].copy())], ["a", "b"])

        for b in batches:
            mask, value, f = (b.column(c).to_numpy() for c in ("mask", "value", "f"))
            if not len(f):
                continue
            new = np.flatnonzero((mask[1:] != mask[:-1]) | (value[1:] != value[:-1])) + 1
            cuts = np.r_[0, new, len(f)]
            for a, e in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                key = (mask[a], value[a])
                if key == held_key:
                    held = np.concatenate([held, f[a:e]])
                    continue
                if len(held) > 1:
                    yield close(held)
                held_key, held = key, f[a:e]
        if len(held) > 1:
            yield close(held)

    return (
        rows.repartition("mask", "value")
        .sortWithinPartitions("mask", "value", "f")
        .mapInArrow(run, "a bigint, b bigint")
    )


def group(rows: DataFrame, key: str = "doc_id", radius: int = 3, shard_rows: int = 2000) -> DataFrame:
    """Add ``component_id``, the smallest key of a row's group, to rows with a ``fingerprint``.

    ``group_print``, one fingerprint of the group, tells groups apart where keys repeat.
    """
    job = Scratch(rows.sparkSession, "simhash")
    rows = job.write(rows.drop("component_id", "group_print"), "fingerprints")
    prints = job.write(rows.groupBy("fingerprint").agg(F.min(key).alias("least")), "distinct")
    joined = components(links(prints, job, radius, shard_rows), job)
    heads = prints.join(joined, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "least", F.coalesce("component", "fingerprint").alias("head")
    )
    least = heads.groupBy("head").agg(F.min("least").alias("component_id"))
    named = heads.join(least, "head").withColumnRenamed("head", "group_print")
    ids = job.write(named.select("fingerprint", "component_id", "group_print"), "groups")
    return rows.join(ids, "fingerprint")


def hex_print(column: str = "fingerprint"):
    """The fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 3) -> DataFrame:
    """One row of each group: that with the smallest key; of repeated keys, any one."""
    names = docs.columns
    job = Scratch(docs.sparkSession, "simhash-keep")
    narrow = add_fingerprints(docs.select(key, text), text, shingle)
    marked = group(narrow, key, radius)
    first = F.col(key).eqNullSafe(F.col("component_id"))
    # All rows of an id count, also those that do not head a group.
    kept = marked.groupBy(key).agg(F.count("*").alias("count"), F.max(first).alias("first"))
    kept = job.write(kept.filter("first"), "kept")
    # Merged at every size: the ids that stay grow with the documents, so a broadcast of
    # them, which the planner would choose for few, is no plan for many.
    chosen = kept.select(F.col(key).alias("__key")).hint("merge")
    out = docs.join(chosen, F.col(key).eqNullSafe(F.col("__key")), "left_semi")
    if not kept.filter("count > 1").isEmpty():
        # Repeated ids: their rows may even differ, so the group of each row decides.
        out = add_fingerprints(out, text, shingle, keep_text=True)
        ids = marked.select("fingerprint", "component_id", "group_print").distinct()
        out = out.join(ids, "fingerprint").filter(F.col(key).eqNullSafe(F.col("component_id")))
        out = out.dropDuplicates(["group_print"])
    return out.select(*names)
