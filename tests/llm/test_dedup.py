import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from conewise.llm import exact_dedup, fuse_filter, jaccard_join, line_dedup, shingles
from conewise.llm.components import components

from .conftest import ODD


def test_filter_holds_every_key_and_few_others():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 17, 1000, 20_000):
        keys = rng.integers(0, 1 << 62, n).astype(np.uint64)
        made = fuse_filter.build(np.concatenate((keys, keys[:5])))
        assert made.may_hold(keys).all()
        assert made.may_hold(rng.integers(0, 1 << 62, 50_000).astype(np.uint64)).mean() < 0.001
        assert len(made.table) <= max(64, 1.6 * n)


def test_exact_dedup_groups_and_keepers(frame):
    rows = ODD + [(9, "old text"), (50, "old  text"), (51, "old\ttext"), (52, "new"), (53, "new")]
    found = exact_dedup.exact_dedup(*exact_dedup.generations(frame(rows))).collect()
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = defaultdict(list)
    for i, t in rows:
        groups[norm(t)].append(i)
    assert len(found) == len(rows)
    by_sha = {hashlib.sha256(t.encode()).digest(): g for t, g in groups.items()}
    kept = defaultdict(int)
    for r in found:
        group = by_sha[bytes(r.sha)]
        assert r.group_size == len(group)
        assert r.keep_id == min((i for i in group if i is not None), default=None)
        kept[bytes(r.sha)] += r.kept
    assert all(kept[s] == 1 for s in by_sha)


def test_exact_dedup_stage_keeps_one_row_and_all_columns(spark, frame):
    rows = [(5, "one two"), (5, "one two"), (7, "one  two"), (8, None), (9, "")]
    docs = frame(rows)
    left = exact_dedup.stage(spark, docs, "")
    assert left.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in left.collect()) == [(5, "one two"), (8, None)]
    assert exact_dedup.stage(spark, docs.filter("doc_id < 0"), "").count() == 0


def test_equal_digests_of_different_texts_are_found(spark, frame, monkeypatch):
    from pyspark.sql import functions as F
    monkeypatch.setattr(exact_dedup, "digest", lambda text: F.unhex(F.sha2(F.substring(text, 1, 3), 256)))
    with pytest.raises(ValueError, match="differ"):
        exact_dedup.exact_dedup([], frame([(1, "same but"), (2, "same not")]))


def test_new_generations_meet_old_ones(frame):
    docs = frame([(i, f"text {i % 40}") for i in range(120)])
    found = exact_dedup.exact_dedup(*exact_dedup.generations(docs)).collect()
    assert {(r.doc_id, r.keep_id, r.group_size) for r in found} == {(i, i % 40, 3) for i in range(120)}


# --- n-gram Jaccard join ---

def brute_components(rows, size, percent):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append(frozenset(zip(*(w[k:] for k in range(size)))) if len(w) >= size else frozenset([tuple(w)]) if w else frozenset())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if x and 100 * both >= percent * (len(x) + len(sets[j]) - both) and sets[j]:
                parent[root(i)] = root(j)
    low = {}
    for i, (doc_id, _) in enumerate(rows):
        ids = [z for z in (low.get(root(i)), doc_id) if z is not None]
        low[root(i)] = min(ids, default=None)
    return sorted(((d, len(sets[i]), low[root(i)]) for i, (d, _) in enumerate(rows)), key=repr)


def near_copies(rng, count, words, changes):
    base = [rng.choice("abcdefghijkl") * 2 for _ in range(words)]
    for _ in range(count):
        w = list(base)
        for _ in range(rng.randint(0, changes)):
            w[rng.randrange(words)] = str(rng.randrange(1000))
        yield " ".join(w)


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80)])
def test_jaccard_components_equal_brute_force(frame, texts, size, percent):
    rng = random.Random(5)
    rows = ODD + list(enumerate(texts[:120], 100))
    rows += [(1000 + i, t) for i, t in enumerate(near_copies(rng, 80, 60, 3))]
    rows += [(2000 + i, " ".join(rng.choice("ab") for _ in range(rng.randint(1, 14)))) for i in range(120)]
    # a chain: each links with the next only
    rows += [(3000 + i, " ".join(str(x) for x in range(3 * i, 3 * i + 70))) for i in range(12)]
    got = jaccard_join.jaccard_components(frame(rows), size, percent).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute_components(rows, size, percent)


@pytest.mark.parametrize("block", [5, 20, 1024])
def test_large_regions_are_joined_in_blocks(frame, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "LARGE_PARTS", 1)
    rng = random.Random(8)
    rows = [(i, t) for k in range(3) for i, t in enumerate(near_copies(rng, 25, 40, 4), 100 * k)]
    got = jaccard_join.jaccard_components(frame(rows), 3, 90).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute_components(rows, 3, 90)


def test_what_leaves_the_blocks_grows_with_the_members(spark, frame, monkeypatch):
    """One family, two of 200 words changed: links that leave the blocks are fewer than the members, at every size."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 64)
    monkeypatch.setattr(jaccard_join, "LARGE_PARTS", 1)
    seen = []
    plain = jaccard_join.block_links
    monkeypatch.setattr(jaccard_join, "block_links", lambda *a: seen.append(jaccard_join.written(plain(*a), "seen")) or seen[-1])
    rng = random.Random(9)
    base = [str(rng.randrange(10**6)) for _ in range(200)]
    rows = []
    for i in range(400):
        w = list(base)
        for k in rng.sample(range(200), 2):
            w[k] = f"x{rng.random()}"
        rows.append((i, " ".join(w)))
    for n in (200, 400):
        got = jaccard_join.jaccard_components(frame(rows[:n]), 3, 90).collect()
        assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute_components(rows[:n], 3, 90)
        assert all(links.count() < n for links in seen[-2:])


def test_close_sets_equal_brute_force():
    rng = np.random.default_rng(11)
    for many in (10, 60):
        base = rng.integers(0, 1 << 62, 60).astype(np.uint64)
        sets = [np.unique(np.concatenate((rng.permutation(base)[: int(rng.integers(1, 60))], rng.integers(0, 1 << 62, int(rng.integers(0, 4))).astype(np.uint64))))
                for _ in range(many)] + [np.unique(base)] * 3
        both = lambda x, y: len(np.intersect1d(x, y))
        want = [(x, y) for x in range(len(sets)) for y in range(x + 1, len(sets))
                if 100 * both(sets[x], sets[y]) >= 80 * (len(sets[x]) + len(sets[y]) - both(sets[x], sets[y]))]
        assert sorted(jaccard_join._close(sets, 80)) == want and want


def test_near_dedup_stage(spark, frame):
    words = [str(x) for x in range(100)]
    rows = [(4, " ".join(words)), (2, " ".join(words[:98])), (9, "quite another text of some words"), (None, " ".join(words[1:])), (7, None)]
    docs = frame(rows)
    left = jaccard_join.stage(spark, docs, "")
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [2, 7, 9]
    assert jaccard_join.stage(spark, docs.filter("doc_id < 0"), "").count() == 0


def test_linked_sets_share_the_regions_needed():
    """No link is lost: brute force over random pairs near the threshold."""
    rng = np.random.default_rng(2)
    linked = 0
    for percent in (80, 90):
        for _ in range(600):
            n = int(rng.integers(1, 300))
            x = rng.integers(0, 1 << 62, 2 * n + 12).astype(np.uint64)
            a = np.unique(x[:n])
            b = np.unique(np.concatenate((x[int(rng.integers(0, 2 + n // 8)) : n], x[n : n + int(rng.integers(0, 2 + n // 8))])))
            both = len(np.intersect1d(a, b))
            if len(b) and 100 * both >= percent * (len(a) + len(b) - both):
                linked += 1
                found, who = jaccard_join.first_pivots(np.concatenate((a, b)), np.array([len(a), len(b)]), percent)
                shared = np.intersect1d(found[who == 0], found[who == 1]).size
                assert shared >= max(jaccard_join.regions_needed(np.array([len(a), len(b)]), percent))
    assert linked > 300


def test_shared_regions_across_batches():
    import pyarrow as pa
    rows = [(1, 5), (1, 5), (2, 5), (2, 6), (2, 6), (2, 7), (3, 9), (4, 1), (4, 2)]
    want = sorted([5, 6, 7, 1, 2])
    for size in range(1, 10):
        batches = [pa.RecordBatch.from_pydict({"s": [r[0] for r in rows[i : i + size]], "hi": [r[1] for r in rows[i : i + size]]})
                   for i in range(0, len(rows), size)]
        assert sorted(x for b in jaccard_join._shared(iter(batches)) for x in b.column("hi").to_pylist()) == want


def test_shingles_of_long_texts_and_words():
    for text in ("x" * 3_000_000 + " a b " + "y z " * 400_000, "a b c" + " " * 3_000_000, "", "q" * 2_500_000):
        w = text.encode().split()
        _, counts = shingles.sets([text], 3)
        assert counts[0] == (len(set(zip(w, w[1:], w[2:]))) if len(w) > 2 else bool(w))


@pytest.mark.parametrize("part", [8, 1 << 19])  # many parts and stars, and one part
def test_components_of_paths_stars_and_loops(spark, monkeypatch, part):
    monkeypatch.setattr("conewise.llm.components.PART_EDGES", part)
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(200, 201), (201, 202), (202, 200)]
    edges = [(a, b) if rng.random() < 0.5 else (b, a) for a, b in edges]
    got = {r.node: r.comp for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200, 202: 200}


# --- lines ---

def brute_lines(rows):
    seen, out = set(), []
    for _, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        full = [x.strip(" \t\n\v\f\r") for x in (text or "").split("\n") if x.strip(" \t\n\v\f\r")]
        covered = set()
        for i in range(len(full) - 2):
            window = tuple(full[i : i + 3])
            if window in seen:
                covered |= {i, i + 1, i + 2}
            seen.add(window)
        out.append(line_dedup.remaining(text, covered)[0] if text is not None else None)
    return out


def test_line_dedup(frame):
    a, b = "l1\nl2\nl3\nl4", "x\n l1\nl2 \n\nl3\ny\nl2\nl3\nl4"
    rows = [(3, a), (1, b), (2, None), (4, ""), (5, "l1\nl2"), (6, "k\n" * 6), (7, "k\n" * 6), (8, "z\n" + a + "\nz"), (9, "a\r\nb\r\nc")]
    got = {r.doc_id: r.text for r in line_dedup.line_dedup(frame(rows)).collect()}
    assert [got[i] for i, _ in sorted(rows)] == brute_lines(rows)


def test_line_dedup_of_repeated_rows_and_null_ids(frame):
    rows = [(1, "a\nb\nc"), (1, "a\nb\nc"), (None, "a\nb\nc\nd"), (None, "e")]
    got = sorted(((r.doc_id, r.text, r.n_removed) for r in line_dedup.line_dedup(frame(rows)).collect()), key=repr)
    assert got == sorted([(1, "a\nb\nc", 0), (1, "a\nb\nc", 0), (None, "d", 3), (None, "e", 0)], key=repr)
