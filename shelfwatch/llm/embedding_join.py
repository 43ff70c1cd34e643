"""Embedding near-duplicates by an epsilon grid order join.

Cosine of at least c between unit vectors is a distance of at most
epsilon = sqrt(2 - 2c). Vectors are rotated to their principal dimensions, put into
a grid of cells as wide as epsilon on the leading ones, and sorted by cell. The
sorted sequence is cut into blocks, and blocks into intervals of intervals, each
with the box it fills on the leading dimensions and a ball around its members.
The join starts from the widest intervals and goes down: a pair of intervals whose
boxes or balls are more than epsilon apart is dropped with all below it. For the
pairs of blocks that remain a task goes on down in the same way, by halves of the
blocks' sequences with boxes on more dimensions, to leaves of 256 vectors. At a leaf
one product over the leading half of the dimensions, with the lengths of what lies
in the other half as one dimension more, bounds every cosine from above; only pairs
whose bound reaches the cut are multiplied in full, in double precision.

Equal vectors are folded first. A block pair returns, for each member, how many
vectors it met, and a spanning set of links: no pair list leaves a task, however
dense a group is. All links count; nothing is dropped or capped.

Vectors that are null, empty, zero, or hold a null or non-finite component link
with nothing, and neither do vectors of different lengths. Repeated rows are
vectors of their own. Where ids repeat, each row has its own links, and a group's
id is its smallest id (null ids last). Components keep the column's own precision.
Without structure in the leading dimensions no block is provably distant; then the
bounds at the leaves are what saves work, and their number stays quadratic. Result
columns replace input columns of the same name; all others pass through, whatever
their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwatch.llm.components import components
from shelfwatch.runtime import Scratch

LEADING = 6
#: Dimensions of the boxes inside blocks.
LEADING_IN_BLOCK = 24
#: Vectors of a leaf of the recursion.
LEAF = 256
#: A task of comparisons holds the pairs of this many blocks with as many others.
SIDE = 4
#: For the bounds only: sums in another order may differ by this much.
SLACK = 1e-6


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def principal(vectors: DataFrame, dim: int) -> np.ndarray:
    """The principal directions (dim x dim, widest first) of unit vectors; sums run on the tasks."""

    def sums(batches):
        total, square, n = np.zeros(dim), np.zeros((dim, dim)), 0
        for b in batches:
            if b.num_rows:
                x = _unit(_matrix(b.column(0), dim))
                total, square, n = total + x.sum(axis=0), square + x.T @ x, n + len(x)
        flat = np.concatenate([[n], total, square.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], ["i", "x"])

    # dim^2 + dim + 1 numbers reach the driver, whatever the table holds.
    rows = vectors.select("v").mapInArrow(sums, "i bigint, x double").groupBy("i").agg(F.sum("x").alias("x"))
    flat = np.zeros(1 + dim + dim * dim)
    for r in rows.collect():
        flat[r["i"]] = r["x"]
    n, mean = max(flat[0], 1), flat[1 : 1 + dim] / max(flat[0], 1)
    spread = flat[1 + dim :].reshape(dim, dim) / n - np.outer(mean, mean)
    _, directions = np.linalg.eigh(spread)
    return directions[:, ::-1]


def _element(vectors: DataFrame) -> tuple[str, str]:
    """The components' type in SQL, and in the bytes of a block."""
    kind = vectors.schema["v"].dataType.elementType.simpleString()
    return ("float", "<f4") if kind == "float" else ("double", "<f8")


def _blocks(
    vectors: DataFrame, axes: np.ndarray, epsilon: float, block: int, parts: int
) -> DataFrame:
    """Blocks in grid order: place, ids and counts, vectors, box and ball."""
    dim, axes = len(axes), axes[:, :LEADING]
    lead, (kind, code) = axes.shape[1], _element(vectors)

    def grid(batches):
        for b in batches:
            if b.num_rows:
                x = _unit(_matrix(b.column("v"), dim)) @ axes
                cells = np.floor(x / epsilon).astype(np.int32)
                extra = [pa.array(cells[:, j]) for j in range(lead)] + [pa.array(x[:, 0])]
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, *extra], [*b.schema.names, *[f"c{j}" for j in range(lead)], "x0"]
                )

    cells = [f"c{j}" for j in range(lead)]
    shape = f"v array<{kind}>, least bigint, n bigint, " + ", ".join(f"{c} int" for c in cells) + ", x0 double"
    ordered = (
        vectors.mapInArrow(grid, shape)
        .repartitionByRange(parts, *cells, "x0", F.xxhash64("v"))
        .sortWithinPartitions(*cells, "x0", "v")
    )

    def cut(batches):
        held: list[pa.Table] = []
        for b in batches:
            for a in range(0, b.num_rows, block):
                held.append(pa.Table.from_batches([b.slice(a, block)]))
                while sum(t.num_rows for t in held) >= block:
                    whole = pa.concat_tables(held)
                    yield boxed(whole.slice(0, block))
                    rest = whole.slice(block)
                    held = [rest] if rest.num_rows else []
        if held and sum(t.num_rows for t in held):
            yield boxed(pa.concat_tables(held))

    def boxed(table):
        table = table.combine_chunks()
        raw = _matrix(table.column("v").chunk(0), dim)
        x = _unit(raw)
        lead_x, center = x @ axes, x.mean(axis=0)
        radius = float(np.sqrt(((x - center) ** 2).sum(axis=1).max()))
        cells_out = [
            pa.array([table.num_rows]), pa.array([table.column("n").to_numpy().astype("<i8").tobytes()]),
            pa.array([raw.astype(code).tobytes()]), pa.array([table.column("least").to_pylist()], pa.list_(pa.int64())),
            pa.array([lead_x.min(axis=0).tolist()]), pa.array([lead_x.max(axis=0).tolist()]),
            pa.array([center.tolist()]), pa.array([radius]),
        ]
        return pa.RecordBatch.from_arrays(
            cells_out, ["size", "n", "x", "least", "low", "high", "center", "radius"]
        )

    out = ordered.mapInArrow(
        cut,
        "size bigint, n binary, x binary, least array<bigint>, low array<double>, high array<double>, "
        "center array<double>, radius double",
    )
    # Places grow along the order: tasks in range order, blocks of a task as they come.
    return out.withColumn("place", F.monotonically_increasing_id())


def _apart(a: str, b: str, epsilon: float):
    """True if two intervals are provably more than epsilon apart, by box or by ball."""
    limit = epsilon + SLACK

    def square(left, right, gap):
        return F.aggregate(
            F.zip_with(left, right, gap), F.lit(0.0), lambda s, x: s + x * x
        )

    zero = F.lit(0.0)
    # Boxes: the gap in each dimension, from either side.
    up = F.zip_with(F.col(f"{a}low"), F.col(f"{b}high"), lambda x, y: F.greatest(x - y, zero))
    down = F.zip_with(F.col(f"{b}low"), F.col(f"{a}high"), lambda x, y: F.greatest(x - y, zero))
    box = square(up, down, lambda x, y: x + y)
    ball = F.sqrt(square(F.col(f"{a}center"), F.col(f"{b}center"), lambda x, y: x - y))
    return (F.sqrt(box) > limit) | (ball - F.col(f"{a}radius") - F.col(f"{b}radius") > limit)


def _intervals(level: DataFrame, fan: int, dim: int, lead: int) -> DataFrame:
    """Intervals of *fan* neighbours of a level: box around the boxes, ball around the balls."""
    parent = F.floor(F.col("place") / fan).alias("parent")

    def each(column, n, how):
        return F.array(*[how(F.col(column)[j]) for j in range(n)])

    mid = level.groupBy(parent).agg(
        each("low", lead, F.min).alias("low"), each("high", lead, F.max).alias("high"),
        each("center", dim, F.avg).alias("center"),
    )
    reach = (
        level.select(parent, F.col("center").alias("own"), "radius")
        .join(mid.select("parent", "center"), "parent")
        .groupBy("parent")
        .agg(F.max(
            F.col("radius")
            + F.sqrt(F.aggregate(F.zip_with("own", "center", lambda x, y: x - y), F.lit(0.0), lambda s, x: s + x * x))
        ).alias("radius"))
    )
    return mid.join(reach, "parent").withColumnRenamed("parent", "place")


def _near_blocks(blocks: DataFrame, dim: int, epsilon: float, job: Scratch, fan: int = 8) -> DataFrame:
    """Pairs of block numbers (a <= b) not provably apart, found from wide intervals to narrow."""
    shape = blocks.select("place", "low", "high", "center", "radius")
    lead = min(LEADING, dim)
    levels, number = [shape], shape.agg(F.max("place").alias("m")).first()["m"] + 1
    while number > fan:
        levels.append(job.write(_intervals(levels[-1], fan, dim, lead), "intervals"))
        number = -(-number // fan)

    def side(level, name):
        return level.select(*[F.col(c).alias(f"{name}{c}") for c in ("place", "low", "high", "center", "radius")])

    # Of the widest level there are at most *fan* intervals, numbered from 0.
    tops = [(i, j) for i in range(number) for j in range(i, number)]
    pairs, step = blocks.sparkSession.createDataFrame(tops, "pa bigint, pb bigint"), 1
    for level in reversed(levels):
        left = side(level, "l_").withColumn("pa", F.floor(F.col("l_place") / step))
        right = side(level, "r_").withColumn("pb", F.floor(F.col("r_place") / step))
        parts, step = pairs.join(left, "pa").join(right, "pb"), fan
        pairs = parts.filter((F.col("l_place") <= F.col("r_place")) & ~_apart("l_", "r_", epsilon))
        pairs = job.write(pairs.select(F.col("l_place").alias("pa"), F.col("r_place").alias("pb")), "pairs")
    return pairs


class BlockJoin:
    """Compares two blocks by recursion over intervals of their sequences.

    ``compared`` counts the pairs of vectors multiplied in full, ``all_pairs`` all.
    """

    def __init__(self, axes: np.ndarray, cosine: float, block: int, code: str):
        self.axes, self.cosine, self.block, self.code = axes, cosine, block, code
        self.limit = float(np.sqrt(max(0.0, 2 - 2 * cosine))) + SLACK
        self.half = max(1, len(axes) // 2)
        self.compared = self.all_pairs = 0

    def side(self, raw: bytes) -> dict:
        """A block's vectors, what bounds their cosines, and the boxes and balls of its leaves."""
        x = np.frombuffer(raw, self.code).reshape(-1, len(self.axes)).astype(np.float64)
        unit = _unit(x)
        turned = unit @ self.axes
        rest = np.sqrt((turned[:, self.half :] ** 2).sum(axis=1, keepdims=True))
        first = np.arange(0, len(x), LEAF)
        lead = turned[:, :LEADING_IN_BLOCK]
        return {
            "x": x, "unit": unit, "bound": np.hstack([turned[:, : self.half], rest]),
            "low": np.minimum.reduceat(lead, first), "high": np.maximum.reduceat(lead, first),
        }

    def meet(self, place_a: int, a: dict, na: np.ndarray, place_b: int, b: dict, nb: np.ndarray):
        """For members with links the vectors met, and links that span them: (node, other, met), or None."""
        same = place_a == place_b
        met_a, met_b, near = np.zeros(len(na), np.int64), np.zeros(len(nb), np.int64), None
        self.all_pairs += len(na) * len(nb)
        for i, j in self._leaves(a, b, 0, len(a["low"]), 0, len(b["low"])):
            u, v = self._near(a, b, i * LEAF, j * LEAF)
            if same:
                u, v = u[u != v], v[u != v]
            if len(u):
                near = np.zeros((len(na), len(nb)), bool) if near is None else near
                near[u, v] = True
                np.add.at(met_a, u, nb[v])
                np.add.at(met_b, v, na[u])
        if near is None:
            return None
        base_a, base_b = place_a * self.block, place_b * self.block
        nodes, count = base_a + np.arange(len(na)), met_a
        if not same:
            nodes, count = np.concatenate([nodes, base_b + np.arange(len(nb))]), np.concatenate([count, met_b])
        some = count > 0
        u, v = _spanning(near, base_a, base_b, same)
        return (
            np.concatenate([nodes[some], u]),
            np.concatenate([np.full(some.sum(), -1), v]),
            np.concatenate([count[some], np.zeros(len(u), np.int64)]),
        )

    def _leaves(self, a, b, a0, a1, b0, b1):
        """Pairs of leaves whose intervals are not provably apart on any level."""
        low_a, high_a = a["low"][a0:a1].min(axis=0), a["high"][a0:a1].max(axis=0)
        low_b, high_b = b["low"][b0:b1].min(axis=0), b["high"][b0:b1].max(axis=0)
        gap = np.maximum(0, np.maximum(low_a - high_b, low_b - high_a))
        if np.sqrt((gap * gap).sum()) > self.limit:
            return
        if a1 - a0 == b1 - b0 == 1:
            yield a0, b0
        elif a1 - a0 >= b1 - b0:
            mid = (a0 + a1) // 2
            yield from self._leaves(a, b, a0, mid, b0, b1)
            yield from self._leaves(a, b, mid, a1, b0, b1)
        else:
            mid = (b0 + b1) // 2
            yield from self._leaves(a, b, a0, a1, b0, mid)
            yield from self._leaves(a, b, a0, a1, mid, b1)

    def _near(self, a, b, first_a, first_b):
        """Members of two leaves with a cosine of at least the cut, as places in their blocks."""
        rows, cols = slice(first_a, first_a + LEAF), slice(first_b, first_b + LEAF)
        u, v = np.nonzero(a["bound"][rows] @ b["bound"][cols].T >= self.cosine - SLACK)
        if not len(u):
            return u, v
        shape = len(a["unit"][rows]), len(b["unit"][cols])
        if 8 * len(u) > shape[0] * shape[1]:
            self.compared += shape[0] * shape[1]
            cosines = (a["unit"][rows] @ b["unit"][cols].T)[u, v]
        else:
            self.compared += len(u)
            cosines = np.einsum("ij,ij->i", a["unit"][rows][u], b["unit"][cols][v])
        u, v = u + first_a, v + first_b
        near = cosines >= self.cosine
        # What lies at the cut is summed anew, free of the product's order of sums.
        for k in np.flatnonzero(np.abs(cosines - self.cosine) < 1e-9):
            near[k] = _exact(a["x"][u[k]], b["x"][v[k]]) >= self.cosine
        return u[near], v[near]


def _exact(x: np.ndarray, y: np.ndarray) -> float:
    """The cosine from the given components, brought near 1 by powers of two only."""
    x, y = (np.ldexp(z, -np.frexp(np.abs(z).max())[1]) for z in (x, y))
    return float((x * y).sum() / np.sqrt((x * x).sum() * (y * y).sum()))


def _spanning(near: np.ndarray, base_a: int, base_b: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the members as all of *near* would, found by a search of it."""
    rows_open, cols_open = np.ones(near.shape[0], bool), np.ones(near.shape[1], bool)
    u, v = [], []
    for start in np.flatnonzero(near.any(axis=1)):
        if not rows_open[start]:
            continue
        rows_open[start] = False
        if same:
            cols_open[start] = False
        todo = [(True, start)]
        while todo:
            is_row, i = todo.pop()
            if is_row:
                fresh = np.flatnonzero(near[i] & cols_open)
                cols_open[fresh] = False
                u += [base_a + i] * len(fresh)
                v += (base_b + fresh).tolist()
                if same:
                    rows_open[fresh] = False
                todo += [(same, j) for j in fresh]
            else:
                fresh = np.flatnonzero(near[:, i] & rows_open)
                rows_open[fresh] = False
                u += (base_a + fresh).tolist()
                v += [base_b + i] * len(fresh)
                todo += [(True, j) for j in fresh]
    return np.array(u, np.int64), np.array(v, np.int64)


def _compare(
    pairs: DataFrame, blocks: DataFrame, axes: np.ndarray, cosine: float, block: int, code: str, job: Scratch
) -> DataFrame:
    """Per block pair: for members with links, the vectors met; and links that span them.

    The pairs of SIDE blocks with SIDE others meet in one task, to which each of these
    blocks is sent once.
    """
    asks = pairs.select(F.floor(F.col("pa") / SIDE).alias("ga"), F.floor(F.col("pb") / SIDE).alias("gb"), "pa", "pb")
    needs = asks.select("ga", "gb", F.explode(F.array("pa", "pb")).alias("place")).distinct()
    tasks = max(8, min(20000, 2 * asks.select("ga", "gb").distinct().count()))
    asks = asks.repartition(tasks, "ga", "gb")
    sent = needs.join(blocks.select("place", "n", "x"), "place").select(
        F.col("ga").alias("ha"), F.col("gb").alias("hb"), "place", "n", "x"
    ).repartition(tasks, "ha", "hb")
    names = ["node", "other", "met"]

    def run(asked: pa.Table, given: pa.Table) -> pa.Table:
        found, work = [], BlockJoin(axes, cosine, block, code)
        held = {
            place: (work.side(x), np.frombuffer(n, "<i8"))
            for place, n, x in zip(*(given.column(c).to_pylist() for c in ("place", "n", "x")))
        }
        for left, right in zip(asked.column("pa").to_pylist(), asked.column("pb").to_pylist()):
            out = work.meet(left, *held[left], right, *held[right])
            if out is not None:
                found.append(out)
        columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 3
        return pa.table([pa.array(c, pa.int64()) for c in columns], names)

    rows = asks.groupBy("ga", "gb").cogroup(sent.groupBy("ha", "hb"))
    return job.write(rows.applyInArrow(run, "node bigint, other bigint, met bigint"), "met")


def join(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = 0.9, block: int = 4096
) -> DataFrame:
    """Add ``n_links``, ``component_id`` and ``kept`` to each row; the vector goes."""
    spark = rows.sparkSession
    job = Scratch(spark, "embedding-join")
    added = ["n_links", "component_id", "kept"]
    rest = [c for c in rows.columns if c != vector and c not in added]
    epsilon = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
    finite = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    good = F.coalesce(finite & F.exists(F.col(vector), lambda x: x != 0), F.lit(False))
    kind = "float" if rows.schema[vector].dataType.elementType.simpleString() == "float" else "double"
    own = rows.select(
        *rest, F.when(good, F.transform(vector, lambda x: x.cast(kind) + F.lit(0).cast(kind))).alias("__v")
    )
    vectors = own.filter("__v is not null").select(F.col("__v").alias("v"), F.col(key).cast("bigint").alias("key"))
    distinct = vectors.groupBy("v").agg(F.min("key").alias("least"), F.count("*").alias("n"))
    distinct = job.write(distinct, "distinct")
    parts = []
    # Vectors of one length are compared with each other; mostly there is one length.
    for row in distinct.groupBy(F.size("v").alias("dim")).count().orderBy("dim").collect():
        dim, number = row["dim"], row["count"]
        vectors = distinct.filter(F.size("v") == dim)
        axes, code = principal(vectors, dim), _element(vectors)[1]
        blocks = _blocks(vectors, axes, epsilon, block, max(1, -(-number // (4 * block))))
        blocks = job.write(blocks, "unnumbered")
        blocks = job.write(_numbered(blocks), "blocks")
        pairs = _near_blocks(blocks, dim, epsilon, job)
        met = _compare(pairs, blocks, axes, cosine, block, code, job)
        node = F.col("place") * block + F.col("i")
        members = blocks.select("place", F.posexplode("least").alias("i", "least")).select(node.alias("node"), "least")
        counts = met.filter("other < 0").groupBy("node").agg(F.sum("met").alias("met"))
        joined = components(met.filter("other >= 0").select(F.col("node").alias("a"), F.col("other").alias("b")), job)
        heads = members.join(joined, "node", "left").withColumn("head", F.coalesce("component", "node"))
        heads = job.write(heads.select("node", "least", "head"), "heads")
        least = heads.groupBy("head").agg(F.min("least").alias("component"))
        state = heads.select("node", "head").join(least, "head").join(counts, "node", "left")
        values = blocks.select("place", "x").mapInArrow(_spread(dim, block, code), f"node bigint, v array<{kind}>")
        parts.append(job.write(values.join(state, "node").select("v", "component", "met"), "state"))
    if not parts:
        none = F.lit(0).cast("bigint")
        return own.select(*rest, none.alias("n_links"), F.col(key).alias("component_id"), F.lit(True).alias("kept"))
    state = parts[0]
    for more in parts[1:]:
        state = state.unionByName(more)
    same = distinct.select("v", "n")
    state = job.write(state.join(same, "v").select(*[F.col(c).alias(f"__{c}") for c in ("v", "component", "met", "n")]), "classes")
    out = own.join(state, "__v", "left")
    linked = F.col("__n").isNotNull()
    out = out.select(
        *rest,
        F.when(linked, F.coalesce("__met", F.lit(0)) + F.col("__n") - 1).otherwise(0).cast("bigint").alias("n_links"),
        F.when(linked, F.col("__component")).otherwise(F.col(key)).alias("component_id"),
    )
    return out.withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))


def _numbered(blocks: DataFrame) -> DataFrame:
    """Number the blocks 0, 1, 2, ... along the order, by the counts of each task's blocks."""
    task = F.shiftright("place", 33)
    # One row a task of the sort, so their running sum is no work for more than one task.
    earlier = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        blocks.groupBy(task.alias("task"))
        .agg(F.count("*").alias("n"))
        .select("task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    )
    return (
        blocks.withColumn("task", task)
        .join(before, "task")
        .withColumn("place", F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1))
        .drop("task", "before")
    )


def _spread(dim: int, block: int, code: str):
    """The vectors of each block as rows again, with their node numbers."""

    def run(batches):
        for b in batches:
            for place, x in zip(b.column("place").to_pylist(), b.column("x").to_pylist()):
                flat = np.frombuffer(x, code)
                size = len(flat) // dim
                lists = pa.ListArray.from_arrays(pa.array(np.arange(size + 1) * dim, pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays([pa.array(place * block + np.arange(size)), lists], ["node", "v"])

    return run
