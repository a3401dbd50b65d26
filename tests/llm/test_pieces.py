import random
import re

import numpy as np
import pytest
import sentencepiece

from conewise.llm import piece_encoding, pieces

from .conftest import ODD


@pytest.fixture(scope="module")
def path(vocabulary):
    return vocabulary("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def cases(texts):
    rng = random.Random(1)
    return texts[:60] + ["".join(rng.choice("ab 1é\n\t  —😀the in") for _ in range(rng.randint(0, 60))) for _ in range(500)] + [
        "", "  ", " a", "\n", "x\n\ny"]


def test_pieces_equal_the_library(path, cases):
    """The library as a unigram model with the same scores segments alike."""
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    model, proto = pieces.model(path), pb.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    for p in proto.pieces:
        if p.type == 1:
            p.score = model.scores[p.piece][1]
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    for text in cases:
        assert np.frombuffer(model.encode(piece_encoding.marked(text))[0], "<i4").tolist() == library.encode(text), text[:50]


def by_chunks(model, text, size):
    n = max(1, len(text) // size)
    parts = [(text[i * size : (i + 1) * size + model.longest] if i < n - 1 else text[i * size :],
              size if i < n - 1 else len(text) - i * size) for i in range(n)]
    at, starts = np.full(model.longest, pieces.NEVER), []
    at[0] = 0
    matrices = [model.transfer(*p) for p in parts]
    for m in matrices:
        starts.append(at)
        at = pieces.product(at, m)[0]
    if n > 2:  # products combine in any order
        left = pieces.product(pieces.product(matrices[0], matrices[1]), matrices[2])
        right = pieces.product(matrices[0], pieces.product(matrices[1], matrices[2]))
        assert (left == right).all()
    state, exits = 0, []
    for p, s in zip(parts[::-1], starts[::-1], strict=True):
        exits.append(state)
        state = int(model.entries(*p, s)[state])
    return b"".join(model.trace(*p, s, e) for p, s, e in zip(parts, starts, exits[::-1], strict=True)), int(at[0])


def test_chunks_give_the_path_of_the_whole(path, cases):
    model = pieces.model(path)
    uncut = pieces.PieceModel(model.scores, model.byte_ids, model.names)
    uncut.cuts, uncut.segment = False, re.compile(r"(?s).+")
    for text in cases:
        if marked := piece_encoding.marked(text[:400]):
            whole = model.encode(marked)
            for m in (model, uncut):
                for size in (16, 37, 100):
                    assert by_chunks(m, marked, size) == whole


def test_encode_and_decode(frame, path, texts):
    model = pieces.model(path)
    rows = ODD + list(enumerate(texts[:40], 100)) + [(1000, " " * 3000 + "é😀\n" * 700), (1001, "x" * 5000), (1002, texts[0]), (1002, texts[0])]
    encoded = piece_encoding.encode(frame(rows), path, giant=1500, chunk=300)
    got = encoded.collect()
    key = lambda i, ids, score: (repr(i), np.array(ids, "<i4").tobytes(), score)
    assert sorted(key(r.doc_id, r.ids, r.score) for r in got) == sorted(
        (repr(i), *model.encode(piece_encoding.marked(t or ""))) for i, t in rows)
    back = piece_encoding.decode(encoded, path).collect()
    assert sorted((repr(r.doc_id), r.text) for r in back) == sorted((repr(i), t or "") for i, t in rows)


def test_no_documents(frame, path):
    assert piece_encoding.encode(frame([(1, "a")]).filter("doc_id < 0"), path).count() == 0


def test_scores_of_a_unigram_model_are_kept():
    class Model:
        pieces = [("<unk>", 0.0), ("▁", -2.5), ("a", -1.25), ("▁a", -3.0)]

        def get_piece_size(self):
            return len(self.pieces)

        def id_to_piece(self, i):
            return self.pieces[i][0]

        def get_score(self, i):
            return self.pieces[i][1]

        def piece_to_id(self, piece):
            return 0

        def is_unknown(self, i):
            return i == 0

        def is_byte(self, i):
            return False

        is_control = is_unused = is_byte

    model = pieces.PieceModel.of(Model())
    assert model.scores == {"▁": (1, -250), "a": (2, -125), "▁a": (3, -300)}
    assert model.encode("▁a")[1] == -300
