"""Sets of word shingles of many texts at once, as sorted 64-bit hashes.

Words are the runs of bytes other than ASCII white space, A-Z lower-cased.  A
text with fewer words than a shingle has one shingle, its whole word sequence;
a text without words has none.
"""

from __future__ import annotations

import numpy as np

from conewise.llm import hashing, tokens

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_MARK = np.uint64(0xA24BAED4963EE407)
_STEP = np.uint64(0x9FB21C651E98DF25)


def word_hashes(raw: list[bytes], gaps: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of some texts, and the number of words of each; ``gaps`` tells the bytes between words."""
    buffer = _LOWER[np.frombuffer(b" ".join(raw) + b" ", np.uint8)]
    gap = gaps[buffer]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], gap)).astype(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    bounds = np.concatenate(([0], np.cumsum([len(r) + 1 for r in raw])))
    counts = np.diff(np.searchsorted(starts, bounds))
    hashes = hashing.spans(buffer, starts, ends)
    for i in np.flatnonzero(ends - starts >= hashing.MOST_BYTES // 2).tolist():  # as in long_word_hashes
        hashes[i] = hashing.long_span(buffer[starts[i] : ends[i]].tobytes())
    return hashes, counts


def long_word_hashes(raw: bytes, gaps: np.ndarray = _SPACE) -> np.ndarray:
    """The same for one text of any length: by parts that end between words."""
    text, out, start, most = _LOWER[np.frombuffer(raw, np.uint8)], [], 0, hashing.MOST_BYTES // 2
    while start < len(text):
        end = min(len(text), start + most)
        if end < len(text):
            between = np.flatnonzero(gaps[text[start:end]])
            if not len(between):  # one word fills the part: it is hashed whole
                while end < len(text) and not gaps[text[end : end + most]].any():
                    end += most
                if end < len(text):
                    end += int(np.argmax(gaps[text[end : end + most]]))
                end = min(end, len(text))
                out.append(np.array([hashing.long_span(text[start:end].tobytes())], np.uint64))
                start = end + 1
                continue
            end = start + int(between[-1])
        out.append(word_hashes([raw[start:end]], gaps)[0])
        start = end + 1
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def hashed_words(raw: list[bytes], gaps: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """``word_hashes`` of texts of any length."""
    hashes, counts = [], []
    for a, b in tokens.slices([len(r) + 1 for r in raw], hashing.MOST_BYTES // 2):
        part = raw[a:b]
        if sum(map(len, part)) + len(part) > hashing.MOST_BYTES:
            each = [long_word_hashes(r, gaps) for r in part]
            hashes += each
            counts.append(np.array([len(x) for x in each]))
        else:
            h, n = word_hashes(part, gaps)
            hashes.append(h)
            counts.append(n)
    if not counts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(counts)


def rolling(h: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, the text of each and its first word."""
    of = np.repeat(np.arange(len(counts)), counts)
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    mixed = np.zeros(n, np.uint64)
    for i in range(size):
        mixed = hashing.mix(mixed * _STEP + h[i : n + i])
    same = np.flatnonzero(of[:n] == of[size - 1 :])
    return mixed[same], of[same], same - (np.cumsum(counts) - counts)[of[same]]


def _combine(h: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles (with repeats) of texts whose words stand one after another in ``h``, and each one's text."""
    values, texts, _ = rolling(h, counts, size)
    firsts = np.cumsum(counts) - counts
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        whole = np.empty(len(short), np.uint64)
        for j, t in enumerate(short.tolist()):
            x = np.array([_MARK], np.uint64)
            for i in range(int(counts[t])):
                x = hashing.mix(x * _STEP + h[firsts[t] + i : firsts[t] + i + 1])
            whole[j] = x[0]
        values, texts = np.concatenate((values, whole)), np.concatenate((texts, short))
    return values, texts


def sets(texts: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles, text by text and ascending, and the number of each text's."""
    raw = [t.encode() for t in texts]
    all_values, counts = [], np.zeros(len(raw), np.int64)
    for a, b in tokens.slices([len(r) + 1 for r in raw], hashing.MOST_BYTES // 2):
        h, words = hashed_words(raw[a:b])
        values, of = _combine(h, words, size)
        order = np.lexsort((values, of))
        values, of = values[order], of[order]
        first = np.ones(len(values), bool)
        first[1:] = (values[1:] != values[:-1]) | (of[1:] != of[:-1])
        all_values.append(values[first])
        counts[a:b] = np.bincount(of[first], minlength=b - a)
    return (np.concatenate(all_values) if all_values else np.zeros(0, np.uint64)), counts
