"""Byte-level BPE ids of whole texts with the tokenizers library.

A byte-level BPE text splits at every ASCII space that follows a character
other than white space, whatever stands after it: the pre-tokeniser never lets
a token run on over such a space.  So a text's ids are the ids of these units
one after another.  A worker keeps the ids of units it has met, found again by
their 64-bit hash for a whole batch at once; the library encodes the rest.
Texts with white space before a space, where the cut is not sure, are encoded
whole, and so are texts that hold the string of an added token, which the library
cuts out before its pre-tokeniser.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np

from conewise.llm import hashing

#: Places for known units in a worker (a power of two), and ids kept for them.  They only save work.
PLACES = 1 << 21
POOL = 1 << 24

_UNSURE = re.compile(r"\s ")
_ENCODERS: dict[str, Encoder] = {}

#: The public byte-level pre-tokeniser pattern, for text below U+0250.
_PRETOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def byte_letters() -> dict[int, str]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + i) for i, b in enumerate(hidden)}}


class Encoder:
    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the threads
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.dtype = np.dtype("<u2" if self.code == "H" else "<u4")
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.by_units = (
            pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
            and not spec.get("normalizer") and spec["model"]["type"] == "BPE"
        )
        added = spec.get("added_tokens", [])
        self.added = [t["content"] for t in added]
        # an added token that reaches beyond its own string forbids cuts near it
        self.reaching = [t["content"] for t in added if t["lstrip"] or t["rstrip"] or t["single_word"] or " " in t["content"]]
        self.pretokens = regex.compile(_PRETOKENS)
        self.letters = byte_letters()
        self.start_anew()

    def start_anew(self) -> None:
        self.known = np.zeros(PLACES, np.uint64)
        self.first = np.zeros(PLACES, np.int32)
        self.count = np.zeros(PLACES, np.int32)
        self.pool = np.zeros(POOL, self.dtype)
        self.used = 0

    def fresh(self, texts: list[str]) -> list[bytes]:
        """Ids of each text by the library's whole pipeline."""
        got = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self.code, e.ids).tobytes() for e in got]

    def unit(self, text: str) -> list[int]:
        """Ids of one unit: the library's model on each pre-token."""
        if max(text) >= "ɐ":
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        out: list[int] = []
        for token in self.pretokens.findall(text):
            out += [t.id for t in self.tokenizer.model.tokenize(token.encode().decode("latin-1").translate(self.letters))]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian ids of each text."""
        out: list[bytes] = [b""] * len(texts)
        sizes = [len(t) * (1 if t.isascii() else 4) + 1 for t in texts]
        whole = [i for i, t in enumerate(texts)
                 if not t or not self.by_units or t[0] == " " or sizes[i] > hashing.MOST_BYTES or _UNSURE.search(t)
                 or any(a in t for a in self.added)]
        for i in whole:
            sure = self.by_units and not any(a in texts[i] for a in self.reaching)
            out[i] = b"".join(self.fresh(cuts(texts[i]) if sure else [texts[i]]))
        rest = sorted(set(range(len(texts))).difference(whole))
        for a, b in slices([sizes[i] for i in rest], hashing.MOST_BYTES // 2):
            run = rest[a:b]
            for part in (run,) if sum(sizes[i] for i in run) <= hashing.MOST_BYTES else ([i] for i in run):
                for i, ids in zip(part, self.encode_units([texts[i].encode() for i in part]), strict=True):
                    out[i] = ids
        return out

    def encode_units(self, raw: list[bytes]) -> list[bytes]:
        if self.used > POOL // 2:
            self.start_anew()
        joined = b" ".join(raw) + b" "
        buffer = np.frombuffer(joined, np.uint8)
        ends = np.flatnonzero(buffer == 32)
        starts = np.concatenate(([0], ends[:-1] + 1))
        text_starts = np.concatenate(([0], np.cumsum([len(r) + 1 for r in raw])))
        of_text = np.searchsorted(starts, text_starts)  # first unit of each text, and the end
        h = hashing.spans(buffer, starts, ends)
        opens = np.zeros(len(h), bool)  # no space stands before a text's first unit
        opens[of_text[:-1]] = True
        h[opens] = hashing.mix(h[opens])
        place = (h >> np.uint64(43)).astype(np.int64) & (PLACES - 1)
        first, count = self.first[place], self.count[place]
        missed = np.flatnonzero((self.known[place] != h) | (count == 0))
        if len(missed):
            new, at, back = np.unique(h[missed], return_index=True, return_inverse=True)
            units = [self.unit(("" if opens[i] else " ") + joined[starts[i] : ends[i]].decode()) for i in missed[at].tolist()]
            counts = np.fromiter(map(len, units), np.int32, len(units))
            firsts = self.used + np.concatenate(([0], np.cumsum(counts)[:-1])).astype(np.int32)
            total = int(counts.sum())
            if self.used + total > len(self.pool):
                self.pool = np.concatenate((self.pool, np.zeros(total, self.dtype)))
            self.pool[self.used : self.used + total] = np.fromiter((x for u in units for x in u), self.dtype, total)
            self.used += total
            first[missed], count[missed] = firsts[back], counts[back]
            at_new = (new >> np.uint64(43)).astype(np.int64) & (PLACES - 1)
            _, one = np.unique(at_new, return_index=True)  # one unit a place
            self.known[at_new[one]], self.first[at_new[one]], self.count[at_new[one]] = new[one], firsts[one], counts[one]
        upto = np.concatenate(([0], np.cumsum(count, dtype=np.int64)))
        ids = self.pool[np.repeat(first - upto[:-1], count) + np.arange(upto[-1])]
        bounds = upto[of_text].tolist()
        return [ids[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def cuts(text: str, least: int = 100_000) -> list[str]:
    """A long text in parts, cut before spaces that follow a character other than white space."""
    parts, start, at = [], 0, least
    while (at := text.find(" ", at)) >= 0:
        if text[at - 1].isspace():
            at += 1
            continue
        parts.append(text[start:at])
        start, at = at, at + least
    return [*parts, text[start:]]


def slices(sizes: Iterable[int], most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows (start, end) with about ``most`` characters together, one row at least."""
    start = end = total = 0
    for n in sizes:
        end, total = end + 1, total + n
        if total >= most:
            yield start, end
            start, total = end, 0
    if end > start:
        yield start, end
