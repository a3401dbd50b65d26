"""SentencePiece encoding and decoding; giant documents by a parallel max-plus scan.

A text is a path over its places, whose pieces have scores; encoding finds the
best path.  Documents up to ``GIANT`` characters are encoded where they are.  A
giant is split into chunks:

1. every chunk yields its transfer matrix: the best score from each state at its
   left boundary (how far the piece that crosses it reaches) to each state at its
   right one;
2. matrices combine associatively by max-plus products: within blocks of chunks
   in parallel, then over the blocks of a document, which gives the scores of
   the states at every boundary;
3. with these, every chunk tells which left state the best path to each right
   state comes from; these maps combine the same way, from the end;
4. every chunk, now with its true boundary states, is backtraced on its own.

Chunks are rows spread over all tasks.  One task sees a chunk, a block of
``PER_BLOCK`` matrices, or the block results of one document (a text of 2 GB,
the most a row can hold, has about a thousand).

Spaces become a mark, and a mark stands before the text, as the model's
normaliser does; decoding undoes both.  Defined cases: a null or empty text has
no pieces; a mark in the text itself decodes to a space; equal rows are encoded
one by one; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conewise.llm import pieces, tokens
from conewise.llm.common import TEXT_ROWS, plain_text, read_table, ship, written

GIANT = 65_536
CHUNK = 16_384
PER_BLOCK = 64
#: Characters that a task encodes at a time.
SLICE = 1_000_000

ENCODED = "doc_id long, score long, ids array<int>"
_CHUNKS = "doc_id long, giant string, chunk long, block long, size int, text string"
_STATE = "giant string, chunk long, block long"


def marked(text: str) -> str:
    return pieces.SPACE + text.replace(" ", pieces.SPACE) if text else ""


def _id_lists(raw: list[bytes]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(r) // 4 for r in raw]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(raw), "<i4")))


def encode(docs: DataFrame, model_path: str, giant: int = GIANT, chunk: int = CHUNK) -> DataFrame:
    """One row per document: doc_id, ids and the score of its best segmentation."""
    ship(docs.sparkSession)

    def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces.model(model_path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in tokens.slices(map(len, texts), SLICE):
                got = model.encode_all([marked(t) for t in texts[a:b]])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array(map(model.score, got), pa.int64()), _id_lists(got)],
                    ["doc_id", "score", "ids"])

    texts = docs.select(F.col("doc_id").cast("long"), plain_text().alias("text"))
    done = texts.filter(F.length("text") <= giant).mapInArrow(small, ENCODED)
    return done.unionByName(encode_giants(texts.filter(F.length("text") > giant), model_path, chunk))


def encode_giants(texts: DataFrame, model_path: str, chunk: int = CHUNK) -> DataFrame:
    """The same for giant texts (doc_id, text), by chunks."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        over = pieces.model(model_path).longest
        for batch in batches:
            for doc_id, giant, text in zip(*(batch.column(c) for c in ("doc_id", "giant", "text")), strict=True):
                doc_id, giant, text = doc_id.as_py(), giant.as_py(), marked(text.as_py())
                n = -(-len(text) // chunk)
                if n > 1 and len(text) - (n - 1) * chunk < over:
                    n -= 1  # the last chunk is not shorter than a piece
                for k in range(n):
                    end = (k + 1) * chunk if k < n - 1 else len(text)
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array([doc_id], pa.int64()), "giant": [giant], "chunk": [k], "block": [k // PER_BLOCK],
                        "size": pa.array([end - k * chunk], pa.int32()), "text": [text[k * chunk : end + over]]})

    rows = texts.withColumn("giant", F.monotonically_increasing_id().cast("string"))
    chunks = written(rows.mapInArrow(split, _CHUNKS), "chunks", 1)
    per_chunk = lambda work, more, frame=chunks: written(
        frame.repartition("giant", "chunk").mapInArrow(_each(model_path, work), f"{_STATE}, {more} binary"), more, TEXT_ROWS)

    matrices = per_chunk(lambda m, r: m.transfer(r["text"], r["size"]).ravel(), "matrix")
    block_matrix = written(_blocks(matrices, "matrix", _products, "matrix"), "block-matrices")
    block_start = _over_document(block_matrix, "matrix", _forward, "start")
    starts = written(_in_blocks(matrices, block_start, "matrix", "start", _forward), "starts")

    known = written(chunks.join(starts.select("giant", "chunk", "start"), ["giant", "chunk"]), "chunks-with-starts", TEXT_ROWS)
    maps = per_chunk(lambda m, r: m.entries(r["text"], r["size"], r["start"]), "entry", known)
    block_map = written(_blocks(maps, "entry", _composed, "entry"), "block-maps")
    block_exit = _over_document(block_map, "entry", _backward, "exit")
    exits = written(_in_blocks(maps, block_exit, "entry", "exit", _backward), "exits")

    ends = known.join(exits.select("giant", "chunk", "exit"), ["giant", "chunk"])
    paths = per_chunk(lambda m, r: np.frombuffer(m.trace(r["text"], r["size"], r["start"], int(r["exit"][0])), "<i4"), "path", ends)
    last = matrices.join(starts.select("giant", "chunk", "start"), ["giant", "chunk"])
    whole = paths.groupBy("giant").agg(F.sort_array(F.collect_list(F.struct("chunk", "path"))).alias("p"))
    scores = last.groupBy("giant").agg(F.max_by(F.struct("start", "matrix"), "chunk").alias("last"))
    ids = chunks.filter("chunk = 0").select("giant", "doc_id").join(whole, "giant").join(scores, "giant")
    return ids.select("doc_id", "last.start", "last.matrix", F.col("p.path").alias("parts")).mapInArrow(_joined, ENCODED)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            start, matrix = np.frombuffer(r["start"], np.int64), np.frombuffer(r["matrix"], np.int64)
            score = int(pieces.product(start, matrix.reshape(len(start), -1))[0, 0])
            raw = b"".join(np.frombuffer(p, np.int64).astype("<i4").tobytes() for p in r["parts"])
            yield pa.RecordBatch.from_arrays([pa.array([r["doc_id"]], pa.int64()), pa.array([score]), _id_lists([raw])], ["doc_id", "score", "ids"])


def _each(model_path: str, work: Callable) -> Callable:
    """``work`` on each chunk; its numbers become one binary column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces.model(model_path)
        for batch in batches:
            for r in batch.to_pylist():
                r |= {c: np.frombuffer(r[c], np.int64) for c in ("start", "exit") if c in r}
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["giant"]]), pa.array([r["chunk"]]), pa.array([r["block"]]),
                     pa.array([np.asarray(work(model, r), np.int64).tobytes()], pa.binary())], ["giant", "chunk", "block", "out"])

    return run


def _values(table: pa.Table, column: str, by: str) -> list[np.ndarray]:
    return [np.frombuffer(v.as_py(), np.int64) for v in table.sort_by(by).column(column)]


def _products(matrices: list[np.ndarray]) -> np.ndarray:
    side = int(len(matrices[0]) ** 0.5)
    total = matrices[0].reshape(side, side)
    for m in matrices[1:]:
        total = pieces.product(total, m.reshape(side, side))
    return total.ravel()


def _composed(maps: list[np.ndarray]) -> np.ndarray:
    """The left state of the first chunk for each right state of the last."""
    total = maps[-1]
    for m in reversed(maps[:-1]):
        total = m[total]
    return total


def _forward(matrices: list[np.ndarray], start: np.ndarray | None) -> list[np.ndarray]:
    """Scores of the states before each matrix."""
    side = int(len(matrices[0]) ** 0.5)
    if start is None:
        start = np.full(side, pieces.NEVER)
        start[0] = 0
    out = []
    for m in matrices:
        out.append(start)
        start = pieces.product(start, m.reshape(side, side))[0]
    return out


def _backward(maps: list[np.ndarray], end: np.ndarray | None) -> list[np.ndarray]:
    """The right state of each map, if the last one's is ``end``."""
    end = np.zeros(1, np.int64) if end is None else end
    out = []
    for m in reversed(maps):
        out.append(end)
        end = m[end]
    return out[::-1]


def _blocks(frame: DataFrame, column: str, combine: Callable, out: str) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        total = combine(_values(table, column, "chunk"))
        return pa.table({"giant": table.column("giant").slice(0, 1), "block": table.column("block").slice(0, 1), out: [total.tobytes()]})

    return frame.groupBy("giant", "block").applyInArrow(run, f"giant string, block long, {out} binary")


def _over_document(blocks: DataFrame, column: str, scan: Callable, out: str) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        got = scan(_values(table, column, "block"), None)
        return pa.table({"giant": table.column("giant"), "block": table.column("block"), out: pa.array([g.tobytes() for g in got], pa.binary())})

    return written(blocks.groupBy("giant").applyInArrow(run, f"giant string, block long, {out} binary"), f"block-{out}")


def _in_blocks(frame: DataFrame, edges: DataFrame, column: str, out: str, scan: Callable) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        got = scan(_values(table, column, "chunk"), np.frombuffer(table.column(out)[0].as_py(), np.int64))
        return pa.table({"giant": table.column("giant"), "chunk": table.column("chunk"), out: pa.array([g.tobytes() for g in got], pa.binary())})

    return frame.join(edges, ["giant", "block"]).groupBy("giant", "block").applyInArrow(
        run, f"giant string, chunk long, {out} binary")


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids)."""
    ship(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces.model(model_path)
        for batch in batches:
            ids = batch.column("ids")
            texts = [model.decode(v.values.to_numpy(zero_copy_only=False)) if v.is_valid else "" for v in ids]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "text": pa.array(texts, pa.string())})

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def op3_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, score, ids, and the SHA-256 of the text decoded from them."""
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    encoded = encode(read_table(spark, sf_dir, "documents"), path)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        model = pieces.model(path)
        for batch in batches:
            texts = [model.decode(v.values.to_numpy(zero_copy_only=False)) for v in batch.column("ids")]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("doc_id", "score", "ids")],
                 pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string())],
                ["doc_id", "score", "ids", "decoded_sha256"])

    return encoded.mapInArrow(digests, f"{ENCODED}, decoded_sha256 string").select(
        "doc_id", F.size("ids").cast("long").alias("n_pieces"), "score", "ids", "decoded_sha256")
