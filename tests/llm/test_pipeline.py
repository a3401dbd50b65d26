import random
import re
import zlib

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from conewise.llm.common import new_folder, read_table

from .conftest import ODD, TOKENIZER

SF = "/root/testdata/sf0.001"


def test_pipeline(spark):
    docs = read_table(spark, SF, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "pii", "packing"]
    out = corpus_pipeline.run(spark, SF)
    kept = {r.doc_id for r in out.select("doc_id").distinct().collect()}
    assert 0 < len(kept) < docs.count()
    fill = out.groupBy("sequence_id").agg({"length": "sum"}).collect()
    assert all(r["sum(length)"] <= 2048 for r in fill)


def test_stages_take_an_empty_table(spark):
    docs = read_table(spark, SF, "documents").filter("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, docs, SF)
        assert left.columns == docs.columns and left.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 0


def brute_quality(rows):
    """(doc_id, text) of the rows that stay, without the lines above the host limits."""
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t)
    norm = lambda line: re.sub(r"[\x20\x09-\x0D]+", " ", line).strip(" ")
    seen, hosts = {}, {}
    for _, text, host in rows:
        hosts[host] = hosts.get(host, 0) + 1
        for line in (text or "").split("\n"):
            if words(line):
                seen.setdefault((host, norm(line)), set()).add(text)
    shared = {k for k, texts in seen.items() if len(texts) >= 20 and len(texts) > 0.005 * hosts[k[0]]}
    for doc_id, text, host in rows:
        w = words(text or "")
        places = {}
        for i in range(len(w) - 4):
            places.setdefault(tuple(w[i : i + 5]), []).append(i)
        repeated = {j for at in places.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
        left = "\n".join(x for x in (text or "").split("\n") if (host, norm(x)) not in shared)
        n, kept = len(w), len(words(left))
        if n >= 10 and 100 * len(repeated) <= 20 * n and (kept == n or (kept >= 10 and kept >= 0.3 * n)):
            yield doc_id, left


def brute_dedup(docs):
    """{doc_id: text} after exact and near dedup; the smallest id of each group stays."""
    first = {}
    for doc_id, text in sorted(docs):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text), (doc_id, text))
    left = dict(first.values())
    sets = {}
    for doc_id, text in left.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
        sets[doc_id] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    root = {i: i for i in left}

    def find(i):
        return i if root[i] == i else find(root[i])

    ids = sorted(left)
    for a in ids:
        for b in ids:
            if a < b and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: left[i] for i in ids if find(i) == i}


def test_pipeline_equals_brute_force(spark, frame, vocabulary):
    rng = random.Random(4)
    alphabet = ["".join(rng.choice("abcdefghijklmnoprstuvwz") for _ in range(rng.randint(3, 8))) for _ in range(3000)]
    text = lambda n: " ".join(rng.choice(alphabet) for _ in range(n))
    rows = [(100 + i, text(rng.randint(8, 300)), rng.choice(["a", "b", None])) for i in range(60)]
    whole = [r[1] for r in rows]
    rows += [(200 + i, whole[i].replace(" ", " \n\t", 3), "a") for i in range(0, 60, 4)]  # copies but for white space
    for i in range(1, 60, 3):  # near copies, and chains of them
        w = whole[i].split(" ")
        for step in range(3):
            w[rng.randrange(len(w))] = "changed"
            rows.append((300 + 3 * i + step, " ".join(w), rng.choice(["a", "c"])))
    rows += [(600 + i, f"home  about contact\n{text(40)}\nall our pages", "menu") for i in range(25)]  # lines of a host
    rows += [(700 + i, f"home about contact\n{text(4)}\nall our pages", "menu") for i in range(5)]  # depleted
    rows += [(800, text(12) * 9, "a"), (801, text(6000), "b"), rows[0], rows[0], (50, whole[1], "z")]
    rows += [(900 + i, t, "odd") for i, (_, t) in enumerate(ODD)]
    folder = new_folder(spark, "corpus")
    frame(rows).write.parquet(f"{folder}/documents.parquet")

    library = Tokenizer.from_file(vocabulary(TOKENIZER))
    expected = {}
    for doc_id, left in brute_dedup(brute_quality(rows)).items():
        expected[doc_id] = library.encode(left, add_special_tokens=False).ids + [0]
    assert 60 < len(expected) < 110 and 801 in expected and 800 not in expected and 50 in expected

    pieces = {}
    for r in corpus_pipeline.run(spark, folder).collect():
        pieces.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
    assert sorted(pieces) == sorted(expected)
    for doc_id, found in pieces.items():
        ids, at = expected[doc_id], 0
        for n, (piece, start, length, crc) in enumerate(sorted(found)):
            assert (piece, start) == (n, at) and length <= 2048
            assert crc == zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())
            at += length
        assert at == len(ids)
