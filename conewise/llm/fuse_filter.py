"""Static binary-fuse filters (three-wise, 16-bit fingerprints) over 64-bit keys.

A filter is built once for a fixed set of distinct keys and never says no to
one of them; it says yes to about one foreign key in 65,536.  Keys are peeled in rounds: all
table places that only one key is left to use are taken at once.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

from conewise.llm.hashing import mix

SEEDS = 64


@dataclass(frozen=True)
class FuseFilter:
    seed: int
    segment: int  # places in a segment, a power of two
    starts: int  # places where a key's first segment may start
    table: np.ndarray  # uint16

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Three places of each key, in neighbouring segments; shape (3, keys)."""
        mask = np.uint64(self.segment - 1)
        first = ((hashes >> np.uint64(32)) * np.uint64(self.starts)) >> np.uint64(32)
        return np.stack([
            first,
            (first + np.uint64(self.segment)) ^ ((hashes >> np.uint64(18)) & mask),
            (first + np.uint64(2 * self.segment)) ^ (hashes & mask),
        ]).astype(np.int64)

    def hashes(self, keys: np.ndarray) -> np.ndarray:
        return mix(keys.astype(np.uint64) + np.uint64(self.seed) * np.uint64(0x9E3779B97F4A7C15))

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.table) or not len(keys):
            return np.zeros(len(keys), bool)
        h = self.hashes(keys)
        a, b, c = self.table[self.places(h)]
        return (a ^ b ^ c) == prints(h)


def prints(hashes: np.ndarray) -> np.ndarray:
    return (hashes ^ (hashes >> np.uint64(32))).astype(np.uint16)


def build(keys: np.ndarray) -> FuseFilter:
    """The filter of some keys; equal keys count once."""
    keys = np.unique(keys.astype(np.uint64))
    n = len(keys)
    if not n:
        return FuseFilter(0, 4, 4, np.zeros(0, np.uint16))
    segment = 1 << max(2, int(math.log(max(n, 2)) / math.log(3.33) + 2.25))
    factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2)))
    for seed in range(1, SEEDS):
        wide = n * factor * (1 + seed // 8)  # more room if many seeds fail
        starts = max(1, math.ceil(wide / segment) - 2) * segment
        empty = FuseFilter(seed, segment, starts, np.zeros(starts + 2 * segment, np.uint16))
        order = peel(empty.places(h := empty.hashes(keys)), len(empty.table))
        if order is None:
            continue
        at, mark, table = empty.places(h), prints(h), empty.table
        for who, where in reversed(order):
            others = table[at[0][who]] ^ table[at[1][who]] ^ table[at[2][who]]  # the own place still holds 0
            table[where] = mark[who] ^ others
        return empty
    raise RuntimeError(f"no seed builds a filter of {n} keys")


def peel(at: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
    """Rounds of (keys, their own places), or None if some keys never come free."""
    keys = at.shape[1]
    uses = np.bincount(at.ravel(), minlength=size)
    total = np.zeros(size, np.int64)  # sum of the keys that use a place: the key itself if it is alone
    for row in at:
        np.add.at(total, row, np.arange(keys))
    rounds, left, free = [], keys, np.flatnonzero(uses == 1)
    while len(free):
        who, one = np.unique(total[free], return_index=True)
        rounds.append((who, free[one]))
        left -= len(who)
        for row in at[:, who]:
            np.subtract.at(uses, row, 1)
            np.subtract.at(total, row, who)
        touched = np.unique(at[:, who])
        free = touched[uses[touched] == 1]
    return rounds if left == 0 else None
