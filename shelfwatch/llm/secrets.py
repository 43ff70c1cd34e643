"""Secret scans: fixed patterns, and character Markov models for strings they miss.

Three patterns give the base spans (``assign``, ``access``, ``hex``). Two Markov
models of byte pairs, one of random strings and one of ordinary identifiers, then
judge every long run of token characters by the log-likelihood ratio a transition;
runs above the cut become ``random`` spans. Base spans always stay. A run that an
``access`` or ``hex`` span covers in part is judged as a whole, and of the pieces
around the span those become ``random`` spans for which random is the likelier
source, so no end of a mixed key is left. ``assign`` spans end a run, since what
surrounds them is names.

The models are trained from samples whose label is known, never from the long runs
that they are to judge: random are strings drawn over the usual key alphabets and
lengths, ordinary are identifiers joined from words that are too short to be judged,
those of the texts and a fixed list. Each kind is bounded by itself
(``max_samples``). The cut is a high quantile of ordinary samples that the models
have not seen. A table without words has no model, and only the patterns speak.
Scanning is one pass over whole texts, with no shuffle.

Null and empty texts have no spans. Repeated rows have equal spans. Offsets are
code points, the end exclusive. Result columns replace input columns of the same
name; other columns pass through.
"""

from __future__ import annotations

import random as rand
import re
import string
import zlib
from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwatch.llm.textbatch import utf8

KINDS = ("assign", "access", "hex", "random")

_WORDS = (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey")
_ASSIGN = re.compile(
    rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([a-z0-9+/_.=-]+)"
)
_ASSIGN_LEAST = 12
#: Longest runs, so asking for the least length at once finds what filtering would leave.
_ACCESS = re.compile(rb"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(rb"[0-9a-f]{16,}")
#: What a model judges.
_CANDIDATE = re.compile(rb"[A-Za-z0-9+/_=-]{16,}")
SHORTEST_RUN = 16
#: What ordinary samples are joined from: whole words, too short to be a run that is judged.
_WORD = re.compile(rb"(?<![A-Za-z0-9+/_=\x80-\xff-])[A-Za-z]{2,15}(?![A-Za-z0-9+/_=\x80-\xff-])")

#: The usual alphabets of keys; digits alone are left to the hex pattern.
ALPHABETS = {
    "hex": "0123456789abcdef",
    "upper_hex": "0123456789ABCDEF",
    "base32": string.ascii_uppercase + "234567",
    "base36": string.ascii_lowercase + string.digits,
    "upper_base36": string.ascii_uppercase + string.digits,
    "base62": string.ascii_letters + string.digits,
    "base64": string.ascii_letters + string.digits + "+/",
    "base64url": string.ascii_letters + string.digits + "-_",
    "letters": string.ascii_letters,
    "lower": string.ascii_lowercase,
    "upper": string.ascii_uppercase,
}
LENGTHS = (16, 20, 24, 32, 40, 43, 48, 64)

#: Words of identifiers, paths and addresses that texts may hold without their parts.
WORDS = """
access account action active address admin agent alert alias allow amount array asset async attribute author
background balance base batch before begin binary block board body boolean border branch browser buffer build
button byte cache call cancel category change channel char check child class clean clear click client clone close
code collection color column command comment common company compare component config connect constant container
content context control convert copy count country create current custom data database date day default delete
description design detail device dialog digest directory display document domain down draw drop duration edit
element email enable encode end engine entity entry error event example exception execute export extension factory
field file filter find first flag float folder font footer format forward frame from function generate get global
graph group handler hash header height hidden history home host html http https icon image import index info init
input insert install instance integer interface internal item java key label language last layout length level
library license limit line link list load local location lock log login loop main manager map master match max
media member memory menu message meta method metric min mode model module month mouse move name native network new
next node note null number object offset open operator option order output package page panel parameter parent
parse path pattern payment person phone photo platform player plugin point policy position post prefix preview
previous price process product profile project property provider proxy public python query queue random range read
record redirect refresh region register release remote remove render replace report request require reset resource
response result return role root route row rule run save scan schema scope script scroll search section select
send sequence server service session set setting shadow shape share shop show side sign simple site size sort
source space split stack standard start state static status step stop storage store stream string style submit
success summary support switch system table target task template test text theme thread time title toggle tool
total trace track transaction transform tree trigger type unit unknown update upload url user util valid value
vector version video view visible wait warning web week widget width window word worker wrapper write year zone
""".split()


def base_spans(body: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) in bytes of the pattern matches that are long enough."""
    found = []
    low = body.lower()
    # Only a keyword can begin a match; the pattern is tried there, left to right.
    starts = []
    for word in _WORDS:
        at = low.find(word)
        while at >= 0:
            starts.append(at)
            at = low.find(word, at + 1)
    free = 0
    for at in sorted(starts):
        if at >= free and (m := _ASSIGN.match(low, at)):
            free = m.end()
            if m.end(2) - m.start(2) >= _ASSIGN_LEAST:
                found.append((m.start(), 0, m.end()))
    if b"AKIA" in body:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(body)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(body)]
    return sorted(found)


def _covered(spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """What sorted spans cover, as disjoint sorted intervals."""
    out: list[tuple[int, int]] = []
    for s, _, e in spans:
        if out and s <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], e)
        else:
            out.append((s, e))
    return out


def _outside(a: int, b: int, cover: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The pieces of a..b that disjoint sorted intervals leave; one search, then the intervals met."""
    out, i = [], bisect_left(cover, a, key=lambda c: c[1])
    while i < len(cover) and cover[i][0] < b:
        if cover[i][0] > a:
            out.append((a, cover[i][0]))
        a = max(a, cover[i][1])
        i += 1
    return [*out, (a, b)] if a < b else out


@dataclass
class Markov:
    """Log-likelihood ratio of each byte pair (random over ordinary), and the cut."""

    ratio: np.ndarray  # 256 x 256
    cut: float

    def judge(self, run: bytes) -> float:
        """Mean log-likelihood ratio of the transitions of *run*, its start included."""
        codes = np.frombuffer(b"\0" + run, np.uint8)
        return float(self.ratio[codes[:-1], codes[1:]].mean())


#: Part of clean identifiers that may lie above the cut.
CLEAN = 0.999


def train(random: list[bytes], ordinary: list[bytes], least: int = 20) -> Markov | None:
    """Add-one smoothed models of both kinds; None with fewer than *least* samples of one."""
    if min(len(random), len(ordinary)) < least:
        return None

    def logs(samples):
        codes = np.frombuffer(b"".join(b"\0" + s for s in samples), np.uint8).astype(np.int64)
        count = np.bincount(codes[:-1] * 256 + codes[1:], minlength=1 << 16).reshape(256, 256) + 1.0
        count[:, 0] = 1  # from one sample to the next
        return np.log(count / count.sum(axis=1, keepdims=True))

    # Every fifth ordinary sample is held out and sets the cut, never below the zero of the ratio.
    model = Markov(logs(random) - logs([s for i, s in enumerate(ordinary) if i % 5 != 4]), 0.0)
    clean = [model.judge(s) for s in ordinary[4::5] if len(s) >= 2]
    if clean:
        model.cut = max(0.0, float(np.quantile(clean, CLEAN)))
    return model


def random_samples(n: int, seed: int = 1) -> list[bytes]:
    """*n* random strings, the key alphabets and lengths in turn."""
    rnd = rand.Random(seed)
    names = list(ALPHABETS.values())
    return [
        "".join(rnd.choices(names[i % len(names)], k=LENGTHS[i // len(names) % len(LENGTHS)])).encode() for i in range(n)
    ]


def ordinary_samples(words: list[str], n: int, seed: int = 2) -> list[bytes]:
    """*n* identifiers, paths, dates and rulers of at least 16 characters, joined from *words* and the fixed list."""
    rnd = rand.Random(seed)

    def number():
        return "".join(rnd.choices(string.digits, k=rnd.randrange(1, 5)))

    def date():
        return f"{rnd.randrange(1900, 2100)}-{rnd.randrange(1, 13):02}-{rnd.randrange(1, 32):02}"

    def one(style):
        if style == 0:
            return rnd.choice("-=_+/*") * rnd.randrange(16, 80)
        if style == 1:
            parts = [rnd.choice((number, date))() for _ in range(8)]
            return rnd.choice("-/+_=").join(parts)[: rnd.randrange(16, 33)]
        parts, size = [], rnd.randrange(SHORTEST_RUN, 49)
        while sum(map(len, parts)) < size:
            parts.append(rnd.choice(words if rnd.random() < 0.5 else WORDS))
        if style == 2:
            return date() + rnd.choice("-_/") + rnd.choice("-_/").join(parts)
        if rnd.random() < 0.25:
            parts.insert(rnd.randrange(1, len(parts) + 1), number())
        if style == 3:
            return "".join(w[:1].upper() + w[1:] for w in parts)
        if style == 4:
            return "".join([parts[0].lower(), *(w[:1].upper() + w[1:].lower() for w in parts[1:])])
        if style in (5, 10):
            return "_".join(parts).upper()
        if style in (6, 7, 8, 9):
            return "_-/="[style - 6].join(parts)
        return "".join(parts) if style < 13 else "".join(parts).lower()

    # Rulers and numbers come once in a while, joined words most of the time.
    return [one(i % 16).encode() for i in range(n)]


def short_words(body: bytes) -> set[bytes]:
    """Words of a text outside its base spans that are shorter than any run that is judged."""
    cover = _covered(base_spans(body))
    return {m.group() for m in _WORD.finditer(body) if _outside(*m.span(), cover) == [m.span()]}


def fit(
    docs: DataFrame, key: str = "doc_id", text: str = "text", max_rows: int = 20000, max_samples: int = 4000
) -> Markov | None:
    """Train on *max_samples* strings of each kind; the words of ordinary ones are from *max_rows* documents.

    The documents are those with the lowest hashes of *key*, and the words likewise.
    """
    chosen = docs.select(F.xxhash64(key).alias("h"), key).orderBy("h", key).limit(max_rows)
    # max_rows ids: a bound that the data cannot move.
    chosen = F.broadcast(chosen.select(F.col(key).alias("__key")).distinct())
    sample = docs.join(chosen, F.col(key).eqNullSafe(F.col("__key")), "left_semi").select(text)

    def lowest(words):
        return sorted(words, key=lambda w: (zlib.crc32(w), w))[:max_samples]

    def collect(batches):
        seen: set[bytes] = set()
        for b in batches:
            data, at = utf8(b.column(0))
            for a, e in zip(at[:-1], at[1:]):
                seen |= short_words(data[a:e].tobytes())
                if len(seen) > 16 * max_samples:
                    seen = set(lowest(seen))
        yield pa.RecordBatch.from_arrays([pa.array(lowest(seen), pa.binary())], ["value"])

    found = sample.mapInArrow(collect, "value binary").distinct()
    rows = found.orderBy(F.crc32("value"), "value").limit(max_samples).collect()
    if not rows:
        return None
    words = [bytes(r["value"]).decode() for r in rows]
    return train(random_samples(max_samples), ordinary_samples(words, max_samples))


def _random_pieces(body: bytes, model: Markov, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Random runs, without what base spans cover of them."""
    names, cover = _covered([s for s in base if s[1] == 0]), _covered(base)
    out = []
    for m in _CANDIDATE.finditer(body):
        for a, b in _outside(*m.span(), names):
            if b - a < SHORTEST_RUN or model.judge(body[a:b]) <= model.cut:
                continue
            left = _outside(a, b, cover)
            out += left if left == [(a, b)] else [(s, e) for s, e in left if model.judge(body[s:e]) > 0]
    return out


def all_spans(body: bytes, model: Markov | None) -> list[tuple[int, int, int]]:
    """Base spans and those the models add, in code points, by start and kind."""
    found = base_spans(body)
    if model is not None:
        found = sorted(found + [(s, 3, e) for s, e in _random_pieces(body, model, found)])
    if not found or body.isascii():
        return found
    # Code points before a byte: bytes that do not continue a character.
    first = np.concatenate([[0], np.cumsum((np.frombuffer(body, np.uint8) & 0xC0) != 0x80)])
    return [(int(first[s]), k, int(first[e])) for s, k, e in found]


SPAN_TYPE = "array<struct<kind:string,start:bigint,end:bigint>>"


def scan(docs: DataFrame, model: Markov | None, text: str = "text", keep_text: bool = False) -> DataFrame:
    """Add ``spans`` (kind, start, end) to each row; the text goes unless *keep_text*."""
    base = docs.drop("spans") if "spans" in docs.columns else docs
    fields = [f for f in base.schema.fields if keep_text or f.name != text]
    schema = T.StructType(fields + [T.StructField("spans", T._parse_datatype_string(SPAN_TYPE))])
    names = schema.names

    def run(batches):
        kind = pa.array(KINDS)
        for b in batches:
            data, at = utf8(b.column(text))
            sizes, kinds, starts, ends = [0], [], [], []
            for a, e in zip(at[:-1], at[1:]):
                for s, k, stop in all_spans(data[a:e].tobytes(), model):
                    kinds.append(k)
                    starts.append(s)
                    ends.append(stop)
                sizes.append(len(kinds))
            items = pa.StructArray.from_arrays(
                [kind.take(pa.array(kinds, pa.int32())), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())],
                ["kind", "start", "end"],
            )
            lists = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), items)
            yield pa.RecordBatch.from_arrays([b.column(n) for n in names[:-1]] + [lists], names)

    return base.mapInArrow(run, schema)


def redact(docs: DataFrame, model: Markov | None, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """Replace what every span covers by *mark*; other columns and clean texts stay as they are."""
    names = docs.columns

    def run(batches):
        for b in batches:
            column = b.column(text)
            bodies = column.to_pylist()
            for i, body in enumerate(bodies):
                if body:
                    out, last = [], 0
                    for s, _, e in all_spans(body.encode(), model):
                        if e > last:
                            out += [body[last : max(s, last)], mark if s >= last else ""]
                            last = e
                    if last:
                        bodies[i] = "".join(out) + body[last:]
            arrays = [pa.array(bodies, column.type) if n == text else b.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return docs.mapInArrow(run, docs.schema)


def digest(spans: str = "spans") -> dict:
    """Columns that sum up the spans: counts, the hash of the base ones, and all as text."""

    def joined(items):
        return F.array_join(
            F.transform(items, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
            ",",
        )

    def count(kind):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")

    return {
        "n_assign": count("assign"),
        "n_access": count("access"),
        "n_hex": count("hex"),
        "base_sha256": F.sha2(joined(F.filter(spans, lambda s: s["kind"] != "random")).cast("binary"), 256),
        "spans": joined(F.col(spans)),
    }
