import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from conewise.llm import merkle
from conewise.llm.common import lower_ascii

TYPES = "doc_id long, text string, source string, lang string, n_chars long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute(rows):
    """Leaves in order with subroot, proof and folded root, level by level over whole lists."""
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def lower(t):
        return t and "".join(c.lower() if "A" <= c <= "Z" else c for c in t)

    def leaf(i, text, source, lang, n):
        return h(*map(field, (i, source, lang, n, text)))

    def climb(digests):
        """Root, and for each digest the (left, right) digests of its path."""
        paths, at, level = [[] for _ in digests], list(range(len(digests))), digests
        while len(level) > 1:
            for p, i in zip(paths, at, strict=True):
                run = level[i // 8 * 8 : i // 8 * 8 + 8]
                p.append((run[: i % 8], run[i % 8 + 1 :]))
            at = [i // 8 for i in at]
            level = [h(*level[i : i + 8]) for i in range(0, len(level), 8)]
        return level[0], paths

    trees = {}
    for i, text, source, lang, n in rows:
        tampered = i is not None and zlib.crc32(str(i).encode()) % 3 == 0
        shown = leaf(i, lower(text) if tampered else text, source, lang, n)
        trees.setdefault(lang, []).append((i is not None, i or 0, leaf(i, text, source, lang, n), shown, i))
    out, subroots = [], []
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    for lang in langs:
        trees[lang].sort(key=lambda r: r[:3])
        subroots.append(climb([r[2] for r in trees[lang]]))
    root, top = climb([s for s, _ in subroots])
    for lang, (sub, paths), above in zip(langs, subroots, top, strict=True):
        for (_, _, own, shown, i), path in zip(trees[lang], paths, strict=True):
            folded = shown
            for left, right in path + above:
                folded = h(*left, folded, *right)
            out.append((repr(i), own, sub, root, h(*[x for left, right in path + above for x in left + right]), folded, folded == root))
    return sorted(out)


def tampering():
    hit = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return {"text": F.when(hit, lower_ascii(F.col("text"))).otherwise(F.col("text"))}


COLUMNS = ("leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def run(frame, rows, **sizes):
    got = merkle.Manifest(frame(rows, TYPES), tampering(), **sizes).verified().collect()
    return sorted((repr(r.doc_id), *(r[c] for c in COLUMNS)) for r in got)


@pytest.mark.parametrize("levels", [1, 4])  # many rounds of small blocks, and few of large ones
def test_manifest_equals_brute_force(frame, levels):
    rows = [(i, f"Text {i}", f"s{i % 3}", "en", i) for i in range(150)]
    rows += [(1000 + i, "Übung Ö" * i, None, lang, None) for i in range(9) for lang in ("de", "", None, "ü", "fr", "it", "es", "nl", "pt", "sv")]
    rows += [(None, None, None, None, None), (None, "A", "s", "en", 1), (7, None, None, "en", None), (7, "Text 7", "s1", "en", 7),
             (2000, "", "", "lone", 0), (2001, "X" * 300_000, "", "long", 300_000)]
    assert run(frame, rows, levels=levels, part_rows=50) == brute(rows)


def test_production_blocks(frame):
    rows = [(i, f"T{i}", "s", "en" if i % 5 else "de", 2) for i in range(6000)]
    assert run(frame, rows) == brute(rows)


@pytest.mark.parametrize("rows", [[(3, "a", "s", "en", 1)], [(3, None, None, None, None)] * 3])
def test_small_trees(frame, rows):
    assert run(frame, rows) == brute(rows)


def test_no_rows(frame):
    empty = merkle.Manifest(frame([(1, "a")], TYPES).filter("doc_id > 1"))
    assert empty.root is None and empty.verified().count() == 0


def test_siblings_prove_membership(frame):
    tree = merkle.Manifest(frame([(i, f"t{i}", "s", "en", 1) for i in range(20)], TYPES))
    got = tree.verified(with_siblings=True).collect()
    assert all(merkle.fold(r.leaf, r.siblings) == tree.root and r.verified for r in got)
