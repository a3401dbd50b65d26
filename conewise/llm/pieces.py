"""A unigram piece model: best segmentations as max-plus paths.

Scores are whole numbers (hundredths of a nat), so sums are exact in any order
and chunks of a text combine to the same path as the whole.  Of equally good
paths the one whose last piece starts first wins, at every place.

A model file with merge ranks instead of log probabilities (a BPE vocabulary)
gets scores by Zipf's law, -log(rank + 1).
"""

from __future__ import annotations

import math
import re

import numpy as np

SPACE = "▁"
#: An unknown character costs this much more than the worst piece.
UNKNOWN = 10
NEVER = -(1 << 60)
#: Segments whose pieces a worker keeps; it only saves work.
STORE = 300_000
#: Segments up to this length are encoded many at a time.
SHORT = 40

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_MODELS: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    if path not in _MODELS:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        _MODELS[path] = PieceModel.of(sp)
    return _MODELS[path]


class PieceModel:
    def __init__(self, scores: dict[str, tuple[int, int]], byte_ids: list[int], names: list[bytes]) -> None:
        self.scores = scores  # piece -> (id, score)
        self.byte_ids = byte_ids
        self.names = names  # bytes that each id stands for
        self.longest = max(map(len, scores))
        self.reach: dict[str, int] = {}  # longest piece that starts with these two characters
        for p in scores:
            if len(p) > 1:
                self.reach[p[:2]] = max(self.reach.get(p[:2], 0), len(p))
        self.unknown = min(s for _, s in scores.values()) - UNKNOWN
        # a place before a run of spaces, or at a line end, lies in no piece
        self.cuts = not any(SPACE in p.lstrip(SPACE) or ("\n" in p and len(p) > 1) for p in scores)
        self.segment = re.compile(rf"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+" if self.cuts else r"(?s).+")
        self.known: dict[str, bytes] = {}
        # score by id; the first byte of an unknown character carries its score
        self.score_of = np.zeros(len(names), np.int64)
        for i, score in scores.values():
            self.score_of[i] = score
        for b in (*range(0x80), *range(0xC0, 0x100)):
            self.score_of[byte_ids[b]] = self.unknown
        order = sorted((_piece_hash(p), i, score) for p, (i, score) in scores.items())
        self.hashes = np.array([h for h, _, _ in order], np.uint64)
        self.hash_ids, self.hash_scores = (np.array([o[k] for o in order], np.int64) for k in (1, 2))

    @classmethod
    def of(cls, sp) -> PieceModel:
        size = sp.get_piece_size()
        normal = [i for i in range(size) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        raw = [sp.get_score(i) for i in normal]
        if all(s <= 0 and s == int(s) for s in raw):  # merge ranks; pieces that no merge makes come last
            rank = {i: r for r, (s, i) in enumerate(sorted((-sp.get_score(i), i) for i in normal))}
            score = {i: -round(100 * math.log(rank[i] + 2)) for i in normal}
        else:
            score = {i: round(100 * s) for i, s in zip(normal, raw, strict=True)}
        scores = {sp.id_to_piece(i): (i, score[i]) for i in normal}
        byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        names = [sp.id_to_piece(i).replace(SPACE, " ").encode() for i in range(size)]
        for b, i in enumerate(byte_ids):
            names[i] = bytes([b])
        return cls(scores, byte_ids, names)

    def ids(self, text: str, path: list[int]) -> list[int]:
        """Ids of the pieces between the places of a path."""
        out = []
        for a, b in zip(path[:-1], path[1:], strict=True):
            got = self.scores.get(text[a:b])
            out += [got[0]] if got else [self.byte_ids[x] for x in text[a:b].encode()]
        return out

    def forward(self, text: str, start: dict[int, int], end: int) -> tuple[list[int], list[int]]:
        """Best scores and last piece starts at each place, from entries (place: score) over pieces that start before ``end``.

        An entry has a start of its own, -1, and wins ties.
        """
        n, get, reach = len(text), self.scores.get, self.reach.get
        best, back = [NEVER] * (n + 1), [-1] * (n + 1)
        for place, score in start.items():
            best[place] = score
        for i in range(min(end, n)):
            here = best[i]
            if here == NEVER:
                continue
            one = get(text[i : i + 1])
            score = here + (one[1] if one else self.unknown)
            if score > best[i + 1]:
                best[i + 1], back[i + 1] = score, i
            for j in range(i + 2, min(i + reach(text[i : i + 2], 0), n) + 1):
                piece = get(text[i:j])
                if piece and here + piece[1] > best[j]:
                    best[j], back[j] = here + piece[1], i
        return best, back

    def of_segment(self, segment: str) -> bytes:
        """Ids (32 bits, little-endian) of a stretch between sure cuts."""
        _, back = self.forward(segment, {0: 0}, len(segment))
        return np.array(self.ids(segment, walk(back, len(segment), 0)), "<i4").tobytes()

    def of_length(self, segments: list[str]) -> list[bytes]:
        """The same for segments of one length, all at once."""
        size = len(segments[0])
        codes = np.frombuffer("".join(segments).encode("utf-32-le"), "<u4").reshape(-1, size).astype(np.uint64)
        n = len(codes)
        upto = np.zeros((n, size + 1), np.uint64)
        for j in range(size):
            upto[:, j + 1] = upto[:, j] * _BASE + codes[:, j]
        score, piece, power = {}, {}, 1
        for length in range(1, min(size, self.longest) + 1):
            power = power * int(_BASE) % (1 << 64)
            h = upto[:, length:] - upto[:, :-length] * np.uint64(power)
            at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            found = self.hashes[at] == h
            score[length] = np.where(found, self.hash_scores[at], self.unknown if length == 1 else NEVER)
            piece[length] = np.where(found, self.hash_ids[at], -1)
        best, back = np.zeros((n, size + 1), np.int64), np.zeros((n, size + 1), np.int64)
        for j in range(1, size + 1):
            top = np.full(n, 2 * NEVER)
            for length in range(min(j, self.longest), 0, -1):  # earlier starts win ties
                value = best[:, j - length] + score[length][:, j - length]
                better = value > top
                top[better] = value[better]
                back[better, j] = length
            best[:, j] = top
        rows, place, ids = np.arange(n), np.full(n, size), np.full((n, size), -2, np.int64)
        for step in range(size):
            live = np.flatnonzero(place > 0)
            if not len(live):
                break
            length = back[live, place[live]]
            start = place[live] - length
            for k in np.unique(length).tolist():
                of = length == k
                ids[live[of], size - 1 - step] = piece[k][live[of], start[of]]
            place[live] = start
        spelt = (ids == -1).any(axis=1)
        counts, packed = (ids >= 0).sum(axis=1), ids.astype("<i4")
        return [self.of_segment(segments[r]) if spelt[r] else packed[r, size - counts[r] :].tobytes() for r in rows.tolist()]

    def learn(self, segments: set[str]) -> None:
        by_length: dict[int, list[str]] = {}
        for s in segments:
            by_length.setdefault(len(s), []).append(s)
        for length, some in by_length.items():
            for i in range(0, len(some), 4096):
                run = some[i : i + 4096]
                self.known.update(zip(run, self.of_length(run) if length <= SHORT else map(self.of_segment, run), strict=True))

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of texts with their spaces marked, between sure cuts."""
        split = [self.segment.findall(t) for t in texts]
        new = set().union(*split).difference(self.known)
        self.learn(new)
        out = [b"".join(map(self.known.__getitem__, s)) for s in split]
        if len(self.known) > STORE:
            for s in new:
                del self.known[s]
        return out

    def encode(self, text: str) -> tuple[bytes, int]:
        """Ids and score of one text."""
        ids = self.encode_all([text])[0]
        return ids, self.score(ids)

    def score(self, ids: bytes) -> int:
        return int(self.score_of[np.frombuffer(ids, "<i4")].sum())

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.names.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text

    # --- chunks of a giant text: [0, size) of a string that goes on for ``longest`` characters ---

    def sure_cuts(self, chunk: str, size: int) -> tuple[int, int] | None:
        """The first sure cut that no entry passes, and the last in the chunk."""
        if not self.cuts:
            return None
        first = last = None
        for m in re.finditer(rf"(?<=[^{SPACE}]){SPACE}|\n", chunk):
            at = m.start()
            if self.longest <= at <= size:
                first = at if first is None else first
                last = at
        return None if first is None else (first, last)

    def out_vector(self, best: list[int], back: list[int], size: int) -> list[int]:
        """Scores of the first cut at or after the chunk's end, by how far after; entries that lie there count."""
        out = [NEVER] * self.longest
        for o in range(self.longest):
            if size + o < len(best) and (back[size + o] < size):
                out[o] = best[size + o]
        return out

    def transfer(self, chunk: str, size: int) -> np.ndarray:
        """Max-plus matrix: best score from each entry to each exit state (characters past the boundary)."""
        most, cut = self.longest, self.sure_cuts(chunk, size)
        if cut is None:
            return np.array([self.out_vector(*self.forward(chunk, {i: 0}, size), size) if i <= len(chunk) else [NEVER] * most
                             for i in range(most)], np.int64)
        first, last = cut
        head = np.array([self.forward(chunk[:first], {i: 0}, first)[0][first] for i in range(most)], np.int64)
        middle = self.encode(chunk[first:last])[1]
        best, back = self.forward(chunk[last:], {0: 0}, size - last)
        tail = np.array(self.out_vector(best, back, size - last), np.int64)
        return np.maximum(head[:, None] + np.where(tail == NEVER, NEVER, tail + middle)[None, :], NEVER)

    def entries(self, chunk: str, size: int, scores: np.ndarray) -> np.ndarray:
        """The entry state that the best path to each exit state comes from."""
        cut = self.sure_cuts(chunk, size)
        to = size if cut is None else cut[0]
        start = {i: int(s) for i, s in enumerate(scores) if s > NEVER // 2 and i <= len(chunk)}
        _, back = self.forward(chunk if cut is None else chunk[:to], start, to)
        exits = range(self.longest) if cut is None else [0]
        out = [walk(back, to + o, None)[0] if to + o < len(back) else 0 for o in exits]
        return np.array(out if cut is None else out * self.longest, np.int64)

    def trace(self, chunk: str, size: int, scores: np.ndarray, exit_: int) -> bytes:
        """Ids of the best path that leaves the chunk at an exit state."""
        cut = self.sure_cuts(chunk, size)
        start = {i: int(s) for i, s in enumerate(scores) if s > NEVER // 2 and i <= len(chunk)}
        if cut is None:
            _, back = self.forward(chunk, start, size)
            return np.array(self.ids(chunk, walk(back, size + exit_, None)), "<i4").tobytes()
        first, last = cut
        _, back = self.forward(chunk[:first], start, first)
        head = np.array(self.ids(chunk, walk(back, first, None)), "<i4").tobytes()
        _, back = self.forward(chunk[last:], {0: 0}, size - last)
        tail = np.array(self.ids(chunk[last:], walk(back, size - last + exit_, 0)), "<i4").tobytes()
        return head + self.encode(chunk[first:last])[0] + tail


def _piece_hash(piece: str) -> int:
    h = 0
    for c in piece:
        h = (h * int(_BASE) + ord(c)) % (1 << 64)
    return h


def walk(back: list[int], end: int, start: int | None) -> list[int]:
    """Places of the path to ``end``, from ``start`` or from the entry it comes from."""
    path = [end]
    while path[-1] != start and back[path[-1]] >= 0:
        path.append(back[path[-1]])
    return path[::-1]


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product of two transfer matrices, or of a vector and a matrix."""
    a = np.atleast_2d(a)
    return np.maximum((a[:, :, None] + b[None, :, :]).max(axis=1), NEVER)
