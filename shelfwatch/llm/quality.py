"""Quality: a generalised additive model with pairwise interactions over text statistics.

Every text becomes about twenty numbers (:data:`FEATURES`). Each feature is cut
into bins, and cyclic boosting adds one shallow tree a round to each feature's
lookup table; then tables over pairs of features are boosted on what is left. A
score is the logistic of a sum of table cells, so scoring is a binary search and
an addition a feature, vectorised over rows.

Fitting takes a bounded sample of labelled rows (``max_rows``) of which only the
features reach the driver. Scoring reads every whole text where it lies: one
pass, no shuffle.

Null and empty texts have all features 0 and get a score like any text. Without
labelled rows, or with one class only, the score is the share of good rows (0.5
without labels). Repeated rows get equal scores. A result column replaces an
input column of that name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwatch.llm.textbatch import prefix_sums, runs, span_hash, spans

FEATURES = (
    "log_bytes upper_share digit_share space_share line_rate stop_share symbol_share beyond_ascii_share "
    "pipe_share mark_share word_length word_length_spread distinct_words top_word repeated_next "
    "short_words long_words symbol_words upper_words line_length repeated_lines"
).split()

LETTER, UPPER, DIGIT, SPACE, LINE, STOP, SYMBOL, BEYOND, PIPE, MARK = range(10)


def _classes() -> np.ndarray:
    table = np.full(256, SYMBOL, np.uint8)
    table[97:123], table[65:91], table[48:58] = LETTER, UPPER, DIGIT
    table[128:] = BEYOND
    for chars, kind in ((" \t\r\v\f", SPACE), ("\n", LINE), (".,;:'\"()-", STOP), ("|", PIPE), ("!?", MARK)):
        for c in chars:
            table[ord(c)] = kind
    return table


CLASS = _classes()
SEPARATOR = np.isin(CLASS, (SPACE, LINE))


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _groups(row: np.ndarray, value: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each row, and how often its commonest value occurs."""
    if not len(row):
        return np.zeros(rows), np.zeros(rows)
    order = np.lexsort((value, row))
    r, v = row[order], value[order]
    first = np.flatnonzero(np.concatenate([[True], (r[1:] != r[:-1]) | (v[1:] != v[:-1])]))
    size = np.diff(np.concatenate([first, [len(r)]]))
    most = np.zeros(rows)
    np.maximum.at(most, r[first], size)
    return np.bincount(r[first], minlength=rows), most


def features(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A row of :data:`FEATURES` for each text."""
    rows, size = len(at) - 1, np.diff(at)
    kind = CLASS[data]
    owner = np.repeat(np.arange(rows) * 10, size)
    count = np.bincount(owner + kind, minlength=rows * 10).reshape(rows, 10)

    start, end, row = spans(~SEPARATOR[data], at)
    sums, length = prefix_sums(data), end - start
    word = span_hash(sums, start, end)
    words = np.bincount(row, minlength=rows)

    def per_row(x):
        return np.bincount(row, weights=x, minlength=rows)

    mean = _share(per_row(length), words)
    spread = np.sqrt(np.maximum(_share(per_row(length.astype(float) ** 2), words) - mean**2, 0))
    distinct, top = _groups(row, word, rows)
    same = np.zeros(len(row))
    same[1:] = (word[1:] == word[:-1]) & (row[1:] == row[:-1])
    # Words with two symbols or marks at their end, or in capitals throughout.
    tail = np.isin(kind[end - 1], (SYMBOL, MARK, PIPE)) & np.isin(kind[np.maximum(end - 2, start)], (SYMBOL, MARK, PIPE))
    capitals = np.concatenate([[0], np.cumsum(kind == UPPER)])
    letters = np.concatenate([[0], np.cumsum((kind == UPPER) | (kind == LETTER))])
    upper = (letters[end] - letters[start] >= 2) & (capitals[end] - capitals[start] == letters[end] - letters[start])

    lstart, lend, lrow = spans(kind != LINE, at)
    lines = np.bincount(lrow, minlength=rows)
    ldistinct, _ = _groups(lrow, span_hash(sums, lstart, lend), rows)
    columns = [
        np.log1p(size),
        *[_share(count[:, k], size) for k in (UPPER, DIGIT, SPACE, LINE, STOP, SYMBOL, BEYOND, PIPE, MARK)],
        mean, spread, _share(distinct, words), _share(top, words), _share(per_row(same), words),
        _share(per_row(length <= 3), words), _share(per_row(length >= 12), words),
        _share(per_row(tail), words), _share(per_row(upper), words),
        np.log1p(_share(np.bincount(lrow, weights=lend - lstart, minlength=rows), lines)),
        _share(lines - ldistinct, lines),
    ]
    return np.stack(columns, axis=1).astype(np.float64)


@dataclass
class Additive:
    """Cuts of the bins, a table a feature, and tables of pairs."""

    base: float
    cuts: list[np.ndarray]
    single: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(self.cuts)])

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        if len(x) and self.cuts:
            b = self.bins(x)
            for j, table in enumerate(self.single):
                total += table[b[j]]
            for i, j, table in self.pairs:
                total += table[b[i], b[j]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _stump_tree(grad: np.ndarray, hess: np.ndarray, leaves: int, ridge: float = 1.0) -> np.ndarray:
    """A step function over the bins with few leaves, split greedily by gain."""
    parts, cum_g, cum_h = [(0, len(grad))], np.concatenate([[0], np.cumsum(grad)]), np.concatenate([[0], np.cumsum(hess)])

    def gain(g, h):
        return g * g / (h + ridge)

    while len(parts) < leaves:
        best = (1e-9, None, None)
        for k, (a, b) in enumerate(parts):
            if b - a < 2:
                continue
            g, h = cum_g[b] - cum_g[a], cum_h[b] - cum_h[a]
            lg, lh = cum_g[a + 1 : b] - cum_g[a], cum_h[a + 1 : b] - cum_h[a]
            win = gain(lg, lh) + gain(g - lg, h - lh) - gain(g, h)
            win[(lh < 0.5) | (h - lh < 0.5)] = -1
            at = int(win.argmax())
            if win[at] > best[0]:
                best = (float(win[at]), k, a + 1 + at)
        if best[1] is None:
            break
        a, b = parts.pop(best[1])
        parts += [(a, best[2]), (best[2], b)]
    out = np.zeros(len(grad))
    for a, b in parts:
        out[a:b] = (cum_g[b] - cum_g[a]) / (cum_h[b] - cum_h[a] + ridge)
    return out


def _pair_tree(grad: np.ndarray, hess: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, float]:
    """The best cross of one cut in each direction over a table, and its gain."""
    g, h = (np.pad(t.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for t in (grad, hess))

    def quarters(t):
        a = t[1:-1, 1:-1]
        left, top, whole = t[1:-1, -1:], t[-1:, 1:-1], t[-1, -1]
        return a, left - a, top - a, whole - left - top + a

    if min(grad.shape) < 2:
        return np.zeros_like(grad), 0.0
    parts = list(zip(quarters(g), quarters(h)))
    win = sum(a * a / (b + ridge) for a, b in parts)
    i, j = np.unravel_index(int(win.argmax()), win.shape)
    out = np.empty_like(grad)
    for (rows, cols), (a, b) in zip(
        ((slice(0, i + 1), slice(0, j + 1)), (slice(0, i + 1), slice(j + 1, None)),
         (slice(i + 1, None), slice(0, j + 1)), (slice(i + 1, None), slice(j + 1, None))), parts,
    ):
        out[rows, cols] = a[i, j] / (b[i, j] + ridge)
    return out, float(win[i, j] - g[-1, -1] ** 2 / (h[-1, -1] + ridge))


def train(
    x: np.ndarray, y: np.ndarray, max_bins: int = 32, rounds: int = 120, pair_rounds: int = 40,
    pairs: int = 8, leaves: int = 3, rate: float = 0.15,
) -> Additive:
    """Cyclic boosting of single tables, then of the tables of the strongest pairs."""
    share = float(np.clip(y.mean(), 1e-6, 1 - 1e-6)) if len(y) else 0.5
    base = float(np.log(share / (1 - share)))
    if not len(y) or y.min() == y.max():
        return Additive(base, [], [], [])
    grid = np.linspace(0, 1, max_bins + 1)[1:-1]
    cuts = [np.unique(np.quantile(x[:, j], grid, method="lower")) for j in range(x.shape[1])]
    model = Additive(base, cuts, [np.zeros(len(c) + 1) for c in cuts], [])
    b, total = model.bins(x), np.full(len(y), base)

    def slopes():
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for j, table in enumerate(model.single):
            g, h = slopes()
            step = rate * _stump_tree(
                np.bincount(b[j], g, len(table)), np.bincount(b[j], h, len(table)), leaves
            )
            table += step
            total += step[b[j]]

    def sums(i, j, g, h):
        shape = (len(model.single[i]), len(model.single[j]))
        cell = b[i] * shape[1] + b[j]
        return [np.bincount(cell, w, shape[0] * shape[1]).reshape(shape) for w in (g, h)]

    g, h = slopes()
    gains = [
        (_pair_tree(*sums(i, j, g, h))[1], i, j) for i in range(len(cuts)) for j in range(i + 1, len(cuts))
    ]
    chosen = [(i, j) for gain, i, j in sorted(gains, reverse=True)[:pairs] if gain > 0]
    model.pairs = [(i, j, np.zeros((len(model.single[i]), len(model.single[j])))) for i, j in chosen]
    for _ in range(pair_rounds):
        for i, j, table in model.pairs:
            step = rate * _pair_tree(*sums(i, j, *slopes()))[0]
            table += step
            total += step[b[i], b[j]]
    return model


def add_features(df: DataFrame, text: str, column: str = "features") -> DataFrame:
    """Replace the text column by its statistics."""
    schema = T.StructType(
        [f for f in df.schema.fields if f.name != text] + [T.StructField(column, T.ArrayType(T.DoubleType()))]
    )
    names = schema.names

    def run(batches):
        for b in batches:
            found = [features(data, at) for _, data, at in runs(b.column(text))]
            x = np.concatenate(found) if found else np.zeros((0, len(FEATURES)))
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(x) + 1) * len(FEATURES), pa.int32()), pa.array(x.ravel())
            )
            yield pa.RecordBatch.from_arrays([b.column(n) for n in names[:-1]] + [lists], names)

    return df.mapInArrow(run, schema)


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
    label: str = "quality", max_rows: int = 12000,
) -> Additive:
    """Fit on at most *max_rows* labelled rows (1: good), taken by a hash of the id."""
    chosen = (
        labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max(label).alias("__y"))
        .orderBy(F.xxhash64(key), key)
        .limit(max_rows)
    )
    # max_rows ids: a bound that the data cannot move.
    rows = docs.select(key, F.col(text).alias("__text")).join(F.broadcast(chosen), key)
    found = (
        add_features(rows.select("__y", "__text"), "__text")
        .orderBy(F.xxhash64("features"))
        .limit(max_rows)
        .collect()
    )
    x = np.array([r["features"] for r in found]).reshape(-1, len(FEATURES))
    return train(x, np.array([r["__y"] for r in found], float))


def score(docs: DataFrame, model: Additive, text: str = "text", accept: float = 0.7) -> DataFrame:
    """Add ``score`` and ``predicted`` (1 from *accept* on) to each row."""
    base = docs.drop(*[c for c in ("score", "predicted") if c in docs.columns])
    schema = T.StructType([f for f in base.schema.fields] + [T.StructField("score", T.DoubleType())])
    names = schema.names

    def run(batches):
        for b in batches:
            found = [np.zeros(0)] + [model.score(features(data, at)) for _, data, at in runs(b.column(text))]
            columns = [b.column(n) for n in names[:-1]] + [pa.array(np.concatenate(found))]
            yield pa.RecordBatch.from_arrays(columns, names)

    return base.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= accept).cast("int"))
