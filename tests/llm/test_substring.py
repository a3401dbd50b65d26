import random

import numpy as np
import pytest

from conewise.llm import hashing, substring_dedup

from .conftest import ODD

SPACE = " \t\n\v\f\r"


def words_of(text):
    return (text or "").encode().split()


def brute(rows, size):
    first = {}
    for i, text in rows:
        w = words_of(text)
        for a in range(len(w) - size + 1):
            key = tuple(w[a : a + size])
            first[key] = min(first.get(key, (2,)), (i is None, i or 0))
    out = []
    for i, text in rows:
        w = words_of(text)
        gone = {a + k for a in range(len(w) - size + 1) if first[tuple(w[a : a + size])] < (i is None, i or 0) for k in range(size)}
        out.append((repr(i), len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out)


def run(frame, rows, size, heavy=substring_dedup.HEAVY):
    got = substring_dedup.substring_dedup(frame(rows), size, heavy).collect()
    return sorted((repr(r.doc_id), r.n_words, r.n_removed, r.text) for r in got)


def corpus(rng, n, vocabulary, copies):
    pool = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 30))) for _ in range(copies)]
    rows = []
    for i in range(n):
        parts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 12))) if rng.random() < 0.5 else rng.choice(pool)
                 for _ in range(rng.randint(0, 8))]
        rows.append((rng.choice([i, i, None, i // 2]), rng.choice(SPACE + "  ").join(parts)))
    return rows


@pytest.mark.parametrize("size", [5, 13])
@pytest.mark.parametrize("heavy", [substring_dedup.HEAVY, 2])  # whole segments, and nearly all cut into windows
def test_equals_brute_force(frame, size, heavy):
    rng = random.Random(size)
    rows = ODD + corpus(rng, 150, ["aé", "Aé", "b", "c d", "漢", "x.", "y"], 12) + corpus(rng, 100, [f"w{i}" for i in range(500)], 20)
    rows += [(5000, "same " * 400), (5001, "same " * 300 + "end"), (5002, "p q r " * 200), (5003, "q r p " * 50)]
    assert run(frame, rows, size, heavy) == brute(rows, size)


def test_one_passage_in_a_third_of_all_documents(frame):
    rng = random.Random(1)
    passage = " ".join(f"h{i}" for i in range(30))
    rows = [(i, " ".join(f"u{rng.random()}" for _ in range(15)) + (f" {passage} " if i % 3 == 0 else " ") + f"v{i} " * 3) for i in range(300)]
    assert run(frame, rows, 13, heavy=20) == brute(rows, 13)


def test_very_long_texts_and_words(frame):
    rng = random.Random(2)
    long = " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(400_000))  # over the tables of powers
    word = "z" * (hashing.MOST_BYTES + 10)
    rows = [(1, long[1_000_000:2_000_000]), (2, long), (3, f"a b c {word} d e f g h i j k l m"), (4, f"x a b c {word} d e f g h i j k l m y")]
    assert run(frame, rows, 13) == brute(rows, 13)


def test_word_hashes_do_not_depend_on_the_texts_around():
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["a", "bb", "é"]) for _ in range(rng.randint(0, 9))).encode() for _ in range(50)]
    texts += [b"a " * hashing.MOST_BYTES, b"", b" \n", b"q" * (hashing.MOST_BYTES // 2 + 5)]
    h, counts = substring_dedup.word_hashes(texts)
    assert counts.tolist() == [len(t.split()) for t in texts]
    alone = np.concatenate([substring_dedup.word_hashes([t])[0] for t in texts])
    assert (h == alone).all()


def test_automaton_equals_brute_force():
    rng = random.Random(4)
    for _ in range(100):
        texts = [[rng.choice("ab") for _ in range(rng.randint(0, 12))] for _ in range(6)]
        automaton = substring_dedup.SuffixAutomaton()
        for i, t in enumerate(texts[:4]):
            automaton.add(t, 10 - i)
        automaton.finish()
        at = lambda t, i, n: t[i - n + 1 : i + 1] if i - n + 1 >= 0 else None
        holds = lambda t, s: any(t[k : k + len(s)] == s for k in range(len(t) - len(s) + 1))
        for t in texts:
            for i, (state, length) in enumerate(automaton.matches(t)):
                best = max(n for n in range(i + 2) if n == 0 or any(holds(x, at(t, i, n)) for x in texts[:4]))
                assert length == best
                if length:
                    assert automaton.first[state] == min(10 - k for k, x in enumerate(texts[:4]) if holds(x, at(t, i, length)))
            assert len(automaton.first_documents(t, 3)) == max(0, len(t) - 2)


def test_no_rows(frame):
    assert substring_dedup.substring_dedup(frame([(1, "a")]).filter("doc_id > 1")).count() == 0
