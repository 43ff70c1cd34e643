"""Toxicity: a small convolutional text classifier, trained in numpy.

A word is the sum of hashed embeddings of the whole word and of its first four
and five bytes, which stands for a stem. Filters of several widths run over the
words, each keeps its maximum over the whole text, and a logistic layer turns the
maxima into a score. Embeddings start at zero, so a word that training never used
adds nothing.

Training takes every labelled row with its whole text. The rows are dealt by a hash
into shards of a bounded size and stored; in each round every shard trains a copy of
the common weights in a task, and Spark adds the changes up. The vocabulary is counted
over all labelled texts. Only weights and counts, whose number the buckets bound, come
to the driver. Scoring reads every whole text where it lies: one pass, no shuffle.
Language is used for one thing only: a decision threshold per language, taken from a
fifth of the labelled rows, scored by a network that did not see them.

Null and empty texts have no words and get the score of an empty text. With no
labelled row, or one class only, the score is the share of that class (0 without
labels). Repeated rows get equal scores. Columns of the input are not changed; a
result column replaces an input column of that name.
"""

from __future__ import annotations

import copy
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwatch.llm.textbatch import LOWER, WORD_BYTE, prefix_sums, runs, span_hash, spans
from shelfwatch.runtime import Scratch

WIDTHS = (1, 2, 3)
WIDEST = max(WIDTHS)
FILTERS = 8
DIM = 12
VIEWS = 3
BUCKET_BITS = 22
#: Positions convolved at once.
BLOCK = 1 << 14
#: Characters of a shard, which a task holds as numbers.
SHARD_CHARS = 1 << 26
#: Changes of weights are added up as whole numbers of this part.
UNIT = float(1 << 24)
CUTS = np.linspace(0.02, 0.98, 49)


def hashed_words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word (one row a view; 0 is no word) and the row it is in."""
    start, end, row = spans(WORD_BYTE[data], at)
    sums = prefix_sums(LOWER[data])
    shift, floor = np.uint64(64 - BUCKET_BITS), 1
    views = np.empty((VIEWS, len(start)), np.int32)
    for view, cut in enumerate((None, 4, 5)):
        stop = end if cut is None else np.minimum(end, start + cut)
        salt = np.uint64(0x517CC1B727220A95 * view & (1 << 64) - 1)
        views[view] = ((span_hash(sums, start, stop) + salt) >> shift).astype(np.int32) | floor
    return views, row


@dataclass
class Network:
    """Weights; *known* are the buckets with an embedding, in order."""

    known: np.ndarray
    embedding: np.ndarray
    filters: np.ndarray  # DIM x (width, offset, filter)
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    thresholds: dict[str, float] = field(default_factory=dict)

    def lookup(self) -> np.ndarray:
        """Embedding row of each bucket, 0 (all zero) for those never learned."""
        table = np.zeros(1 << BUCKET_BITS, np.int32)
        table[self.known] = np.arange(1, len(self.known) + 1)
        return table

    def maxima(self, seq: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Largest response of each filter in each padded row of embedding rows *seq*."""
        rows = len(begin) - 1
        best = np.full((rows, len(WIDTHS) * FILTERS), -np.inf, np.float32)
        for a in range(0, int(begin[-1]), BLOCK):
            b = min(a + BLOCK, int(begin[-1]))
            part = np.zeros((VIEWS, b - a + WIDEST - 1), seq.dtype)
            piece = seq[:, a : b + WIDEST - 1]
            part[:, : piece.shape[1]] = piece
            response = self.embedding[part[0]]
            for view in range(1, VIEWS):
                response = response + self.embedding[part[view]]
            response = response @ self.filters
            conv = np.empty((b - a, len(WIDTHS) * FILTERS), np.float32)
            column = 0
            for k, width in enumerate(WIDTHS):
                total = response[: b - a, column : column + FILTERS].copy()
                for j in range(1, width):
                    c = column + j * FILTERS
                    total += response[j : b - a + j, c : c + FILTERS]
                column += width * FILTERS
                conv[:, k * FILTERS : (k + 1) * FILTERS] = total
            first = int(np.searchsorted(begin, a, "right")) - 1
            last = int(np.searchsorted(begin, b, "left"))
            # The last places of a row would reach into the next one.
            for place in range(1, WIDEST):
                tail = begin[first + 1 : last + 1] - place - a
                conv[tail[(tail >= 0) & (tail < b - a)]] = -np.inf
            cuts = np.maximum(begin[first:last] - a, 0)
            best[first:last] = np.maximum(best[first:last], np.maximum.reduceat(conv, cuts))
        return np.maximum(best + self.bias, 0)

    def score(self, seq: np.ndarray, begin: np.ndarray) -> np.ndarray:
        return _sigmoid(self.maxima(seq, begin) @ self.out + self.out_bias)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def padded(views: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Words of all rows in one line, each row followed by empty places; row starts."""
    count = np.bincount(row, minlength=rows)
    begin = np.concatenate([[0], np.cumsum(count + WIDEST)])
    seq = np.zeros((VIEWS, int(begin[-1])), views.dtype)
    seq[:, np.arange(len(row)) + WIDEST * row] = views
    return seq, begin


class _Tables:
    """The network's weights as rows of ``DIM`` numbers, so that copies of it can be added up by row.

    Rows from 1 are embeddings; the other weights lie in rows -1, -2, ... and their
    squared gradients (Adagrad) behind them. The squared gradients of an embedding are
    kept as their mean.
    """

    def __init__(self, net: Network, growth: np.ndarray, dense_growth: np.ndarray):
        self.net, self.growth, self.dense_growth = net, growth, dense_growth

    @classmethod
    def fresh(cls, known: np.ndarray, share: float, seed: int) -> _Tables:
        rng = np.random.default_rng(seed)
        net = Network(
            known,
            np.zeros((len(known) + 1, DIM), np.float32),
            rng.normal(0, 0.5, (DIM, sum(WIDTHS) * FILTERS)).astype(np.float32),
            np.full(len(WIDTHS) * FILTERS, 0.1, np.float32),
            rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32),
            float(np.log((share + 1e-3) / (1 - share + 1e-3))),
        )
        return cls(net, np.zeros(len(known) + 1), np.zeros(len(_dense(net))))

    def passes(
        self, texts: list[np.ndarray], toxic: np.ndarray, times: int, batch: int, rng: np.random.Generator
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Train a copy on some texts; returns the rows it changed, their changes, and growth."""
        net, old = copy.copy(self.net), _dense(self.net)
        net.embedding = net.embedding.copy()
        parts = _undense(net, self.dense_growth + 1e-6)
        seen = {n: v.astype(np.float32) for n, v in zip(("filters", "bias", "out"), parts)}
        seen["embedding"] = np.repeat((self.growth + 1e-6)[:, None], DIM, axis=1).astype(np.float32)
        seen["out_bias"] = float(parts[3][0])
        start = seen["embedding"][:, 0].copy()
        used = np.zeros(len(net.embedding), bool)
        for _ in range(times):
            order = rng.permutation(len(texts))
            for a in range(0, len(order), batch):
                pick = order[a : a + batch]
                used[_step(net, seen, [texts[i] for i in pick], toxic[pick])] = True
        rows = np.flatnonzero(used)
        grown = np.concatenate([
            seen["filters"].ravel(), seen["bias"], seen["out"], [seen["out_bias"]]
        ]) - 1e-6 - self.dense_growth
        dense = np.concatenate([_in_rows(_dense(net) - old), _in_rows(grown)])
        change = np.concatenate([net.embedding[rows].astype(np.float64) - self.net.embedding[rows], dense])
        growth = seen["embedding"][rows].mean(axis=1, dtype=np.float64) - start[rows]
        return (
            np.concatenate([rows, -1 - np.arange(len(dense))]), change,
            np.concatenate([growth, np.zeros(len(dense))]),
        )

    def moved(self, rows: np.ndarray, change: np.ndarray, growth: np.ndarray) -> _Tables:
        """The weights after a change of some rows."""
        net, own = copy.copy(self.net), rows > 0
        net.embedding = net.embedding.copy()
        net.embedding[rows[own]] += change[own].astype(np.float32)
        grown = self.growth.copy()
        grown[rows[own]] += growth[own]
        flat = change[~own][np.argsort(-rows[~own])]
        half, size = len(flat) // 2, len(self.dense_growth)
        weights = _undense(net, _dense(net) + flat[:half].ravel()[:size])
        net.filters, net.bias, net.out = (w.astype(np.float32) for w in weights[:3])
        net.out_bias = float(weights[3][0])
        return _Tables(net, grown, self.dense_growth + flat[half:].ravel()[:size])


def _dense(net: Network) -> np.ndarray:
    """All weights but the embeddings, one after the other."""
    return np.concatenate([net.filters.ravel(), net.bias, net.out, [net.out_bias]]).astype(np.float64)


def _undense(net: Network, flat: np.ndarray) -> list[np.ndarray]:
    sizes = np.cumsum([net.filters.size, net.bias.size, net.out.size])
    filters, bias, out, out_bias = np.split(flat, sizes)
    return [filters.reshape(net.filters.shape), bias, out, out_bias]


def _in_rows(flat: np.ndarray) -> np.ndarray:
    return np.append(flat, np.zeros(-len(flat) % DIM)).reshape(-1, DIM)


def _tops(net: Network, seq: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Largest response of each filter in each padded row, and its place; a block of words at once."""
    best = np.full((len(begin) - 1, len(WIDTHS) * FILTERS), -np.inf, np.float32)
    where = np.zeros(best.shape, np.int64)
    every, total = np.arange(len(WIDTHS) * FILTERS), int(begin[-1])
    for a in range(0, total, BLOCK):
        b = min(a + BLOCK, total)
        part = np.zeros((VIEWS, b - a + WIDEST - 1), seq.dtype)
        piece = seq[:, a : b + WIDEST - 1]
        part[:, : piece.shape[1]] = piece
        # A line a filter, so that adding up and looking for the largest run along memory.
        response = net.filters.T @ net.embedding[part].sum(axis=0).T
        conv, column = np.empty((len(every), b - a), np.float32), 0
        for k, width in enumerate(WIDTHS):
            own = conv[k * FILTERS : (k + 1) * FILTERS]
            own[:] = response[column : column + FILTERS, : b - a]
            for j in range(1, width):
                c = column + j * FILTERS
                own += response[c : c + FILTERS, j : b - a + j]
            column += width * FILTERS
        first = int(np.searchsorted(begin, a, "right")) - 1
        last = int(np.searchsorted(begin, b, "left"))
        for i in range(first, last):
            low, high = max(begin[i], a) - a, min(begin[i + 1] - WIDEST + 1, b) - a
            if low >= high:
                continue
            own = conv[:, low:high]
            top = own.argmax(axis=1)
            value = own[every, top]
            better = value > best[i]
            best[i, better], where[i, better] = value[better], top[better] + low + a
    return best, where


def _step(net: Network, seen: dict, texts: list[np.ndarray], toxic: np.ndarray, rate: float = 0.1) -> np.ndarray:
    """One Adagrad step on a batch of texts (views x embedding rows); returns the embeddings it changed."""
    views = np.concatenate(texts, axis=1)
    row = np.repeat(np.arange(len(texts)), [t.shape[1] for t in texts])
    seq, begin = padded(views, row, len(texts))
    best, where = _tops(net, seq, begin)
    feature = np.maximum(best + net.bias, 0)
    off = (_sigmoid(feature @ net.out + net.out_bias) - toxic) / len(texts)
    slope = off[:, None] * net.out * (feature > 0)
    grads = {
        "out": feature.T @ off + 1e-5 * net.out,
        "bias": slope.sum(axis=0),
        "filters": np.zeros_like(net.filters),
    }
    touched, change, column = [], [], 0
    for k, width in enumerate(WIDTHS):
        g = slope[:, k * FILTERS : (k + 1) * FILTERS]
        for j in range(width):
            at = where[:, k * FILTERS : (k + 1) * FILTERS] + j
            c = slice(column + j * FILTERS, column + (j + 1) * FILTERS)
            words = net.embedding[seq[:, at]].sum(axis=0)
            grads["filters"][:, c] = np.einsum("bf,bfd->df", g, words)
            back = g[:, :, None] * net.filters[:, c].T[None]
            for view in range(VIEWS):
                touched.append(seq[view][at].ravel())
                change.append(back.reshape(-1, DIM))
        column += width * FILTERS
    rows, inverse = np.unique(np.concatenate(touched), return_inverse=True)
    step = np.zeros((len(rows), DIM), np.float32)
    np.add.at(step, inverse, np.concatenate(change))
    keep = rows > 0  # row 0 stays zero: no word
    rows, step = rows[keep], step[keep]
    seen["embedding"][rows] += step**2
    net.embedding[rows] -= rate * step / np.sqrt(seen["embedding"][rows])
    for name, grad in grads.items():
        seen[name] += grad**2
        setattr(net, name, getattr(net, name) - (rate / 2) * grad / np.sqrt(seen[name]))
    seen["out_bias"] += float(off.sum()) ** 2
    net.out_bias -= rate / 2 * float(off.sum()) / seen["out_bias"] ** 0.5
    return rows


# -- training over the cluster -------------------------------------------------


def _words(b: pa.RecordBatch):
    """Hashed words of each row of a batch, in order."""
    for first, data, at in runs(b.column("__text")):
        views, row = hashed_words(data, at)
        ends = np.searchsorted(row, np.arange(len(at)))
        for i in range(len(at) - 1):
            yield first + i, views[:, ends[i] : ends[i + 1]]


def _likely(docs: DataFrame, truth: DataFrame, key: str) -> DataFrame:
    """All rows of labelled ids and, by chance, few others: a bitmap of hashed ids, 16 MB at most, tells."""
    place = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1 << 27))
    bucket, bit = F.bitmap_bucket_number(place), F.bitmap_bit_position(place)
    bitmap = truth.groupBy(bucket.alias("__bucket")).agg(F.bitmap_construct_agg(bit).alias("__bitmap"))
    byte = F.conv(F.hex(F.substring("__bitmap", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = F.call_function("shiftright", byte, (bit % 8).cast("int")).bitwiseAND(F.lit(1)) == 1
    marked = docs.join(F.broadcast(bitmap), bucket == F.col("__bucket"))
    return marked.filter(found).drop("__bucket", "__bitmap")


def _mark(batches):
    """The texts that follow a label of their id, with that label."""
    names = ["__y", "__text", "__lang", "__shard", "__probe"]
    last, label = None, None
    for b in batches:
        found, labels = [], []
        for i, (key, y) in enumerate(zip(b.column("__id").to_pylist(), b.column("__y").to_pylist())):
            if y is not None:
                last, label = key, y
            elif key == last:
                found.append(i)
                labels.append(label)
        kept = b.select(names[1:]).take(pa.array(found, pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(labels, pa.int32()), *kept.columns], names)


def _deal(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, lang: str | None, shard_rows: int):
    """All labelled rows as a table, dealt by hash into shards; how many, and the share of toxic ones."""
    truth = (
        labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max(label).cast("int").alias("__y"))
    )
    # Only ids and lengths meet the labels to be counted; the texts are shuffled once.
    found = docs.select(key, F.char_length(text).alias("chars")).join(truth, key).agg(
        F.count("*").alias("n"), F.sum("__y").alias("toxic"), F.sum("chars").alias("chars")
    ).first()
    n, toxic = found["n"], found["toxic"] or 0
    if not 0 < toxic < n:
        return None, 0, toxic / max(n, 1)
    shards = max(1, round(n / shard_rows), -(-(found["chars"] or 0) // SHARD_CHARS))
    language = F.coalesce(F.col(lang).cast("string"), F.lit("")) if lang else F.lit("")
    # Labels and texts travel as one table, a label before the texts of its id: one shuffle, and
    # its tasks are the shards. A join would be laid out in the session's number of tasks.
    nothing = F.lit(None).cast("string")
    texts = _likely(docs.filter(F.col(key).isNotNull()), truth, key).select(
        F.col(key).cast("string").alias("__id"), F.lit(None).cast("int").alias("__y"),
        F.coalesce(F.col(text), F.lit("")).alias("__text"), language.alias("__lang"),
    )
    marks = truth.select(F.col(key).cast("string"), "__y", nothing, nothing)
    order = F.xxhash64("__id")
    dealt = (
        texts.union(marks)
        .select(
            "*", order.alias("__order"), F.pmod(order, F.lit(shards)).cast("int").alias("__shard"),
            # Every fifth row sets the thresholds.
            (F.pmod(F.xxhash64("__id", "__text"), F.lit(5)) == 4).alias("__probe"),
        )
        .repartitionById(shards, "__shard")
        .sortWithinPartitions("__shard", "__order", "__id", F.asc_nulls_last("__y"), F.xxhash64("__text"))
        .mapInArrow(_mark, "__y int, __text string, __lang string, __shard int, __probe boolean")
    )
    return dealt, shards, toxic / n


def _vocabulary(table: DataFrame, min_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets used by at least *min_texts* texts, with the rows of thresholds and without them.

    A word of one or two texts tells nothing of others; without it nothing is learned by heart.
    """

    def count(batches):
        uses = np.zeros((2, 1 << BUCKET_BITS), np.int32)
        for b in batches:
            probe = b.column("__probe").to_numpy(zero_copy_only=False)
            for i, views in _words(b):
                own = np.unique(views)
                uses[0, own] += 1
                if not probe[i]:
                    uses[1, own] += 1
        for some in np.array_split(np.flatnonzero(uses[0]).astype(np.int32), 1 + (1 << BUCKET_BITS) // BLOCK):
            if len(some):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some), *[pa.array(u[some].astype(np.int64)) for u in uses]], ["bucket", "texts", "others"]
                )

    counted = (
        table.select("__text", "__probe")
        .mapInArrow(count, "bucket int, texts bigint, others bigint")
        .groupBy("bucket")
        .agg(F.sum("texts").alias("texts"), F.sum("others").alias("others"))
        .select("bucket", (F.col("others") >= min_texts).alias("trial"), (F.col("texts") >= min_texts).alias("kept"))
        .filter("kept")
        .toArrow()  # 2^22 rows at most
        .sort_by("bucket")
    )
    buckets = counted.column("bucket").to_numpy()
    return buckets, buckets[counted.column("trial").to_numpy()]


def _train(
    table: DataFrame, shards: int, share: float, known: np.ndarray, trial: bool, epochs: int, steps: int, rows: int,
    batch: int = 32, seed: int = 7,
) -> Network:
    """Fit the network to all rows, or to those that set no threshold (*trial*).

    Each round starts from common weights, goes through every shard by itself and takes
    the mean change of each weight over the shards that changed it. A single shard is
    gone through more than once a round if there are too few *steps* otherwise.
    """
    state = _Tables.fresh(known, share, seed)
    times = -(-steps * batch // (max(rows, 1) * epochs)) if shards == 1 else 1
    fields = ["row int", *[f"d{i} bigint" for i in range(DIM)], "g bigint"]

    for number in range(epochs):

        def run(batches, state=state, number=number):
            lookup = state.net.lookup()

            def trained(shard, texts, toxic):
                rng = np.random.default_rng([seed, number, shard])
                at, change, growth = state.passes(texts, np.array(toxic, np.float32), times, batch, rng)
                # Whole numbers, so that sums do not depend on the order of shards.
                whole = np.rint(np.column_stack([change, growth]) * UNIT).astype(np.int64)
                for a in range(0, len(at), BLOCK):
                    some = whole[a : a + BLOCK]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(at[a : a + BLOCK].astype(np.int32)), *[pa.array(some[:, i]) for i in range(DIM + 1)]],
                        [f.split()[0] for f in fields],
                    )

            held, texts, toxic = None, [], []
            for b in batches:
                numbers = b.column("__shard").to_numpy()
                labels = b.column("__y").to_numpy()
                probe = b.column("__probe").to_numpy(zero_copy_only=False)
                for i, views in _words(b):
                    if numbers[i] != held:
                        if texts:
                            yield from trained(held, texts, toxic)
                        held, texts, toxic = numbers[i], [], []
                    if not (trial and probe[i]):
                        texts.append(lookup[views])
                        toxic.append(labels[i])
            if texts:
                yield from trained(held, texts, toxic)

        mean = [(F.sum(f.split()[0]) / F.count("*") / UNIT).cast("float").alias(f.split()[0]) for f in fields[1:]]
        merged = table.mapInArrow(run, ", ".join(fields)).groupBy("row").agg(*mean).toArrow()  # a row a weight
        change = np.column_stack([merged.column(f"d{i}").to_numpy() for i in range(DIM)])
        state = state.moved(merged.column("row").to_numpy(), change, merged.column("g").to_numpy())
    net = state.net
    used = np.flatnonzero(np.abs(net.embedding[1:]).max(axis=1) > 0)
    net.known = known[used]
    net.embedding = np.concatenate([net.embedding[:1], net.embedding[1:][used]])
    return net


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    lang: str | None = "lang",
    shard_rows: int = 8000,
    min_texts: int = 3,
) -> Network:
    """Train on every row of *labels* (1: toxic) that has a document; set a threshold per language."""
    job = Scratch(docs.sparkSession, "toxicity")
    dealt, shards, share = _deal(docs, labels, key, text, label, lang, shard_rows)
    if dealt is None:
        return Network(
            np.zeros(0, np.int64), np.zeros((1, DIM), np.float32),
            np.zeros((DIM, sum(WIDTHS) * FILTERS), np.float32),
            np.zeros(len(WIDTHS) * FILTERS, np.float32),
            np.zeros(len(WIDTHS) * FILTERS, np.float32), 30.0 if share > 0.5 else -30.0,
        )
    table = job.write(dealt, "labelled")
    known, trial_known = _vocabulary(table, min_texts)
    thresholds: dict[str, float] = {}
    parts = {
        r["__probe"]: r
        for r in table.groupBy("__probe").agg(F.count("*").alias("n"), F.sum("__y").alias("toxic")).collect()
    }
    rest = parts.get(False)
    # All rows train the network that scores; a trial network that has not seen every fifth sets thresholds.
    if lang and rest and 0 < rest["toxic"] < rest["n"] and True in parts:
        trial = _train(table, shards, rest["toxic"] / rest["n"], trial_known, True, 2, 150, rest["n"])
        thresholds = _thresholds(table.filter("__probe"), trial)
    net = _train(table, shards, share, known, False, 4, 300, sum(r["n"] for r in parts.values()))
    net.thresholds = thresholds
    job.drop(table)
    return net


def _thresholds(probe: DataFrame, net: Network) -> dict[str, float]:
    """The best cut of each language with both classes; other languages keep 0.5."""
    scored = score(probe.select("__text", "__lang", "__y"), net, "__text", None)
    level = F.lit(0)
    for cut in CUTS.tolist():
        level = level + (F.col("score") >= cut).cast("int")
    counts = scored.groupBy("__lang", level.alias("level")).agg(
        F.count("*").alias("n"), F.sum("__y").alias("toxic")
    )
    # A row a language, with what lies at each level.
    by_language = (
        counts.groupBy("__lang")
        .agg(F.collect_list(F.struct("level", "n", "toxic")).alias("levels"), F.sum("toxic").alias("t"), F.sum("n").alias("a"))
        .filter("t > 0 and t < a")
        .collect()
    )
    return {r["__lang"]: _threshold(r["levels"]) for r in by_language}


def _threshold(levels: list) -> float:
    """The middle of the cuts with the best F1, from the rows whose score reaches so many cuts."""
    n, toxic = np.zeros((2, len(CUTS) + 1))
    for r in levels:
        n[r["level"]] += r["n"]
        toxic[r["level"]] += r["toxic"]
    chosen, right = n[::-1].cumsum()[::-1][1:], toxic[::-1].cumsum()[::-1][1:]
    f1 = 2 * right / np.maximum(1, chosen + toxic.sum())
    best = np.flatnonzero(f1 >= f1.max() - 1e-12)
    return float(round(CUTS[best[len(best) // 2]], 4))


def score(docs: DataFrame, net: Network, text: str = "text", lang: str | None = "lang") -> DataFrame:
    """Add ``score``, ``predicted`` (from 0.5), ``threshold`` and ``flagged`` (by language)."""
    added = ["score", "predicted", "threshold", "flagged"]
    base = docs.drop(*[c for c in added if c in docs.columns])
    schema = T.StructType([f for f in base.schema.fields if f.name != text] + [T.StructField("score", T.DoubleType())])
    names = schema.names

    def run(batches):
        table = net.lookup()
        for b in batches:
            found = [np.zeros(0)]
            for _, data, at in runs(b.column(text)):
                views, row = hashed_words(data, at)
                found.append(net.score(*padded(table[views], row, len(at) - 1)).astype(np.float64))
            columns = [b.column(n) for n in names[:-1]] + [pa.array(np.concatenate(found))]
            yield pa.RecordBatch.from_arrays(columns, names)

    out = base.mapInArrow(run, schema)
    threshold: Column = F.lit(0.5)
    if lang and net.thresholds:
        for name, cut in net.thresholds.items():
            threshold = F.when(F.coalesce(F.col(lang), F.lit("")) == name, F.lit(cut)).otherwise(threshold)
    return out.withColumns(
        {
            "predicted": (F.col("score") >= 0.5).cast("int"),
            "threshold": threshold,
            "flagged": F.col("score") >= threshold,
        }
    )
