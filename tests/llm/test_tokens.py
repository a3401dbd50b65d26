import os
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from conewise.llm import packing, token_files, tokens
from conewise.llm.common import new_folder

from .conftest import ODD, TOKENIZER


@pytest.fixture(scope="module")
def library(vocabulary):
    t = Tokenizer.from_file(vocabulary(TOKENIZER))
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_units_equal_the_library(vocabulary, library, texts):
    rng = random.Random(0)
    letters = "ab 1'’\n\t   é²½-.,s're<|endoftext|>\x1c\x85　\0ɐ漢"
    cases = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 25))) for _ in range(3000)] + texts[:60]
    cases += ["", " ", "<|endoftext|> a", "word " * 300_000, "x" * 200_000]
    got = tokens.encoder(vocabulary(TOKENIZER)).encode(cases)
    for text, ids in zip(cases, got, strict=True):
        assert np.frombuffer(ids, "<u2").tolist() == library(text), text[:50]


def test_added_tokens_as_the_library_has_them(vocabulary, library):
    mark = "<|endoftext|>"
    cases = [mark, f"{mark}a b", f"a {mark} b", f"a b{mark}", f"a b {mark}", f"a{mark}{mark}b  {mark}\n{mark} c", f"a <|endof text|> {mark[:-1]}",
             ("word " * 25_000) + mark + " more" * 30_000, ("word " * 19_999) + f"{mark} x {mark}" + " more" * 30_000]
    got = tokens.encoder(vocabulary(TOKENIZER)).encode(["plain text", *cases])
    for text, ids in zip(cases, got[1:], strict=True):
        assert np.frombuffer(ids, "<u2").tolist() == library(text), text[:50]
    assert library(f"a {mark} b") == [64, 220, 50256, 275]


def test_units_after_the_store_starts_anew(vocabulary, library, texts):
    small = tokens.Encoder(vocabulary(TOKENIZER))
    for text in texts[:20]:
        small.used = len(small.pool)
        assert np.frombuffer(small.encode([text])[0], "<u2").tolist() == library(text)


def test_cuts_join_again():
    text = ("a  b\n c " * 100_000)
    parts = tokens.cuts(text)
    assert "".join(parts) == text and len(parts) > 3


def test_token_files_round_trip(spark, frame, vocabulary, library, texts):
    rows = ODD + [(1000 - i, t) for i, t in enumerate(texts[:50])]
    folder = new_folder(spark, "test-files")
    manifest = token_files.write_token_files(frame(rows), folder, vocabulary(TOKENIZER), 2, files=4).collect()
    got = token_files.read_token_files(spark, folder).collect()
    assert len(got) == len(rows)
    want = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == [i for i, _ in want]
    assert sorted((repr(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted(
        (repr(i), len(library(t)) + 1, crc(library(t) + [2])) for i, t in rows)
    start = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == start
        start += r.n_tokens
    assert sum(m.ids for m in manifest) == start
    flat = np.concatenate([token_files.token_ids(folder, m.name, m.width) for m in sorted(manifest, key=lambda m: m.part)])
    one = next(r for r in got if r.doc_id == 1000)
    assert flat[one.start : one.start + one.n_tokens].tolist() == library(texts[0]) + [2]
    assert os.path.getsize(os.path.join(token_files.mounted(folder), manifest[0].name + ".idx")) == 8 * (manifest[0].documents + 1)


def test_token_files_of_no_documents(spark, frame, vocabulary):
    folder = new_folder(spark, "test-files")
    assert token_files.write_token_files(frame([(1, "a")]).filter("doc_id > 1"), folder, vocabulary(TOKENIZER), 2).count() == 0
    assert token_files.read_token_files(spark, folder).count() == 0


def test_token_files_need_a_mounted_folder():
    with pytest.raises(ValueError):
        token_files.mounted("hdfs://host/folder")


def test_packing(spark, frame, vocabulary, library, texts):
    rows = ODD + list(enumerate(texts, 100)) + [(99, " ".join(texts[:20]))]
    got = packing.packed(frame(rows), vocabulary(TOKENIZER), 0, capacity=512).toPandas()
    ids = {i: library(t) + [0] for i, t in rows if i is not None and i != 5}
    for i, g in got[got.doc_id.isin(list(ids))].sort_values("piece").groupby("doc_id"):
        at = 0
        assert list(g.piece) == list(range(len(g)))
        for p in g.itertuples():
            assert p.start == at and p.ids_crc32 == crc(ids[int(i)][at : at + p.length])
            assert p.length == 512 or p.piece == 0
            at += p.length
        assert at == len(ids[int(i)]) and len(g) == -(-at // 512)
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert list(g.offset) == list(g.length.cumsum() - g.length) and g.length.sum() <= 512
    floor = -(-got.length.sum() // 512)
    assert got.sequence_id.nunique() <= 1.02 * floor + 1
    assert got.doc_id.isna().sum() == 3 and (got.doc_id == 5).sum() == 2


def test_packed_sequences_hold_the_ids(spark, frame, vocabulary, library):
    pieces = packing.cut(frame([(1, "a b c"), (2, None), (3, "x " * 700)]), vocabulary(TOKENIZER), 0, 512, with_ids=True)
    got = {r.sequence_id: np.frombuffer(r.ids, "<u4").tolist()
           for r in packing.packed_sequences(pieces, packing.pack(pieces, 512)).collect()}
    assert sorted(x for s in got.values() for x in s) == sorted(
        library("a b c") + [0] + [0] + library("x " * 700) + [0])
    assert all(len(s) <= 512 for s in got.values())


def test_no_pieces(frame, vocabulary):
    assert packing.packed(frame([(1, "a")]).filter("doc_id > 1"), vocabulary(TOKENIZER), 0).count() == 0


def test_search_is_no_worse_than_best_fit_and_valid():
    rng = np.random.default_rng(3)
    for n, high in ((1, 100), (200, 100), (500, 60), (300, 40)):
        lengths = rng.integers(1, high, n)
        order = np.argsort(-lengths, kind="stable")
        plain = packing.best_fit(np.full(n, -1), order, lengths, np.zeros(0, np.int64), 100)
        best = packing.evolve(lengths, [], 100, 5)
        assert len(best.fill) <= len(set(plain.tolist()))
        assert np.bincount(best.of, weights=lengths).max() <= 100
        again = packing.evolve(lengths, [], 100, 5)
        assert (again.of == best.of).all()  # the same after a lost task
        elite = packing.evolve(lengths, [best.of], 100, 6)
        assert len(elite.fill) <= len(best.fill)


def test_crossover_keeps_every_piece_once():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 50, 100)
    one, two = (packing.Packing(packing.best_fit(np.full(100, -1), rng.permutation(100), lengths, np.zeros(0, np.int64), 100), lengths, 100)
                for _ in range(2))
    child = packing.cross(one, two, lengths, 100, rng)
    assert (child.of >= 0).all() and child.fill.sum() == lengths.sum() and child.fill.max() <= 100
