"""Token ids and counts exactly as the tokenizer libraries give them, with a memory for chunks.

Both byte-pair tokenizers handled here cut a text at white space before they merge,
so the ids of a text are those of its chunks one after the other. A worker keeps
the results of the chunks it has met lately (``KEPT`` and as many older ones), which
saves most of the work in natural text. Texts and tokenizers for
which the cuts are not certain go to the library whole.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np

KEPT = 250_000

#: White_Space of Unicode, as the tokenizers' patterns see it.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: A run of other characters with one blank before it, or white space as the byte-level pattern cuts it.
_CHUNK = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")


def tokenizer_digest(path: str) -> str:
    """What identifies a tokenizer: library, its version, and the file's content."""
    if path.endswith(".model"):
        import sentencepiece as library
    else:
        import tokenizers as library
    with open(path, "rb") as file:
        content = hashlib.sha256(file.read()).hexdigest()
    return hashlib.sha256(f"{library.__name__} {library.__version__} {content}".encode()).hexdigest()


class Memory:
    """Results by chunk in two generations; what the older one is asked for moves up."""

    def __init__(self):
        self.young: dict = {}
        self.old: dict = {}

    def fill(self, chunks: set, work) -> None:
        """Have results for all *chunks* at hand; *work* makes those not known."""
        new = chunks.difference(self.young)
        again = self.old.keys() & new  # goes through the smaller one
        if len(self.young) + len(new) > KEPT:
            kept = {c: self.young[c] for c in chunks.difference(new)}
            self.old, self.young = {**self.young, **{c: self.old[c] for c in again}}, kept
        self.young.update((c, self.old[c]) for c in again)
        if len(again) < len(new):
            self.young.update(work(list(new.difference(again))))


class Counter:
    """Numbers of tokens of texts, without begin, end or added special tokens."""

    def __init__(self, path: str):
        self.memory = Memory()
        self.pieces = path.endswith(".model")
        if self.pieces:
            import sentencepiece

            self.library = sentencepiece.SentencePieceProcessor(model_file=path)
            return
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        cut = rules["pre_tokenizer"] or {}
        self.cuts = (
            rules["normalizer"] is None
            and cut.get("type") == "ByteLevel"
            and cut.get("use_regex", True)
            and not cut.get("add_prefix_space")
        )
        self.special = [t["content"] for t in rules["added_tokens"]]

    def whole(self, texts: list[str]) -> list[int]:
        """Counts by the library, each text as one."""
        if self.pieces:
            return [len(ids) for ids in self.library.encode(texts, num_threads=1)]
        return [len(e) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def count(self, texts: list[str]) -> list[int]:
        if self.pieces or not self.cuts:
            return self.whole(texts)
        odd = [any(s in t for s in self.special) for t in texts]
        chunks = [[] if o else _CHUNK.findall(t) for t, o in zip(texts, odd)]
        self.memory.fill(set().union(*chunks), lambda new: zip(new, self.whole(new)))
        size = self.memory.young.__getitem__
        return [
            self.whole([t])[0] if o else sum(map(size, row)) for t, o, row in zip(texts, odd, chunks)
        ]


def _byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte, reversed."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    rest = (b for b in range(256) if b not in set(plain))
    return letters | {chr(256 + i): b for i, b in enumerate(rest)}


_CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
#: The words of chunks in lower case, a chunk a line.
_ASCII_WORDS = re.compile(_CONTRACTIONS + "|[a-z]+|[0-9]|[^a-z0-9\n]+")
_ASCII = re.compile(b"[!-~]+")
#: Latin-1 without white space and controls; lower-casing and composition leave it Latin-1.
_LATIN = re.compile("[!-~\xa1-\xff]+")


class WordIds:
    """Ids, as little-endian 32-bit bytes, of texts under a word-end byte-pair tokenizer.

    A new chunk is cut into words here and merged by a second library that holds
    the same merges as ranks, a word's end being a zero byte. Both give the same
    ids where every entry of the vocabulary merges to itself (a test asserts it
    for the file in use). Anything beyond Latin-1, and special strings, go to the
    tokenizer's own library.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.memory = Memory()
        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        self.fast = self._ranks(rules)

    def _ranks(self, rules: dict):
        """The second library, or None if the vocabulary is not ordered by merge."""
        import regex
        import tiktoken

        model = rules["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        vocab = model["vocab"]
        made = [vocab.get(a + b, -1) for a, b in merges]
        wanted = (
            model.get("end_of_word_suffix") == "</w>"
            and [n["type"] for n in (rules["normalizer"] or {}).get("normalizers", [])]
            == ["NFC", "Replace", "Lowercase"]
            and all(a < b for a, b in zip(made, made[1:]))
            and made[0] > max(v for k, v in vocab.items() if len(k.removesuffix("</w>")) == 1)
        )
        if not wanted:
            return None
        letters, ranks = _byte_letters(), {}
        added = {t["content"] for t in rules["added_tokens"]}
        for token, number in vocab.items():
            if token in added:
                continue
            end = token.endswith("</w>") and len(token) > 4
            ranks[bytes(letters[c] for c in (token[:-4] if end else token)) + b"\0" * end] = number
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[n for t, n in ranks.items() if len(t) > 1 and t.endswith(b"\0")]] = True
        self.latin_words = regex.compile(_CONTRACTIONS + r"|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
        return tiktoken.Encoding(
            "word_ends", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={}
        )

    def whole(self, texts: list[str]) -> list[bytes]:
        """Ids by the tokenizer's own library, each text as one."""
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _new(self, chunks: list[bytes]) -> dict[bytes, bytes]:
        ascii_only, latin, slow = [], [], []
        for chunk in chunks:
            if self.fast is None or b"<|" in chunk:
                slow.append(chunk)
            elif _ASCII.fullmatch(chunk):
                ascii_only.append(chunk)
            else:
                (latin if _LATIN.fullmatch(chunk.decode()) else slow).append(chunk)
        # Words end in a zero byte, chunks in a line's end, which goes when their words are counted.
        lines = _ASCII_WORDS.sub("\\g<0>\0", b"\n".join(ascii_only).lower().decode())
        others = []
        for chunk in latin:
            low = chunk.decode().lower()
            own = _ASCII_WORDS.findall(low) if low.isascii() else self.latin_words.findall(low)
            others.append("\0".join(own) + "\0")
        lines = "\n".join([lines] * bool(lines) + others)
        found = {}
        if lines:
            mark = np.frombuffer((lines + "\n").encode("latin-1"), np.uint8)
            words = np.cumsum(mark == 0)[mark == 10]
            ids = self.fast.encode_to_numpy(lines.replace("\n", ""), disallowed_special=())
            ends = np.flatnonzero(self.ends[ids])[words - 1] + 1
            flat, last = ids.astype("<u4").tobytes(), 0
            for chunk, end in zip(ascii_only + latin, (4 * ends).tolist()):
                found[chunk] = flat[last:end]
                last = end
        if slow:
            found.update(zip(slow, self.whole([c.decode() for c in slow])))
        return found

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Packed ids of each UTF-8 text."""
        rows = [t.split() for t in texts]
        self.memory.fill(set().union(*rows), self._new)
        ids = self.memory.young.__getitem__
        return [b"".join(map(ids, row)) for row in rows]


_LOADED: dict[tuple, object] = {}


def loaded(kind, path: str):
    """One tokenizer a worker process, kept between tasks."""
    if (kind, path) not in _LOADED:
        _LOADED[kind, path] = kind(path)
    return _LOADED[kind, path]
