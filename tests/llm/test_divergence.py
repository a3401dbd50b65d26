import os
import random
import re
import subprocess
import sys
from collections import Counter

from conewise.llm import divergence

TYPES = "doc_id long, text string, source string, lang string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, ranks=200):
    docs = [(lang or "", source or "", [w.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
                                        for w in TERM.findall(text or "")]) for _, text, source, lang in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        seen = Counter(t for _, _, w in own for t in set(w))
        kept = [t for t in seen if seen[t] >= 3]
        count = {s: Counter(t for _, x, w in own if x == s for t in w) for s in {d[1] for d in own}}
        total = Counter(t for _, _, w in own for t in w)

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (n + len(kept)) for t in kept}

        def f(p, q):
            return (p - q) * (p - q) // q

        p = {s: shares(c) for s, c in count.items()}
        q = shares(total)
        for s in count:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in count if o != s]
            terms = [(-f(p[s][t], q[t]), t.encode(), t) for t in kept if count[s][t] and p[s][t] > q[t]]
            out += [(lang, s, "pair", o, -v, i) for i, (v, _, o) in enumerate(sorted(pairs), 1)]
            out += [(lang, s, "term", t, -v, i) for i, (v, _, t) in enumerate(sorted(terms)[:ranks], 1)]
    return sorted(out)


def rows_of(rng, n, words):
    vocabulary = [rng.choice(["é", "ß", "w", "漢", "İ"]) + str(i) + "ab"[i % 2] * (i % 7) for i in range(words)]
    return [(i, " ".join(rng.choice(vocabulary[: 3 + i % words]) for _ in range(rng.randint(0, 60))) + "\tUPPER-Case it's",
             rng.choice(["s0", "s0", "s1", "S2", "", None, "ü"]), rng.choice(["en", "de", None, ""])) for i in range(n)]


def test_audit_equals_brute_force(frame):
    rows = rows_of(random.Random(5), 300, 40)
    rows += [(None, None, "empty", "en"), (1, "", "empty", "xx"), (1, "a b c", "x", "lone"), (1, "a b c", "y", "lone"),
             (2, "word " * 3000 + "x" * 100_000, "s1", "en"), (2, "many " * 3000, "s1", "en")]
    got = [tuple(r) for r in divergence.audit(frame(rows, TYPES)).collect()]
    assert sorted(got) == brute(rows)
    assert ("lone", "x", "pair", "y", 0, 1) in got


def test_spills_and_ranks_change_nothing(frame):
    rows = rows_of(random.Random(6), 200, 60)
    docs = frame(rows, TYPES)
    want = brute(rows, ranks=4)
    assert sorted(tuple(r) for r in divergence.audit(docs, ranks=4, spill=20).collect()) == want
    assert divergence.stripes(docs, spill=20).count() > divergence.stripes(docs).count()


def test_long_texts_are_folded_in_parts(monkeypatch):
    text = "One two, zweié " * 500
    whole = divergence.term_counts(text)
    monkeypatch.setattr(divergence, "PART", 100)
    assert divergence.term_counts(text) == whole and whole[b"one"] == 500


def test_no_rows(frame):
    assert divergence.audit(frame([(1, "a")], TYPES).filter("doc_id > 1")).count() == 0


def test_pairs_need_nothing_that_others_import():
    """A worker that has only this module: pyarrow does not load its functions by itself."""
    code = """
import pyarrow as pa
from conewise.llm import divergence, packing, substring_dedup, token_files
kind = pa.list_(pa.struct([("source", pa.string()), ("p", pa.int64()), ("p0", pa.int64())]))
row = [{"source": "a", "p": 9, "p0": 2}, {"source": "b", "p": 4, "p0": 2}]
batch = pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array([row], kind)], ["lang", "counts"])
(out,) = divergence._met([batch])
print(sorted((r["source"], r["item"]) for r in out.to_pylist()))
"""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    ran = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert ran.stdout.strip() == "[('a', 'b'), ('b', 'a')]", ran.stderr
