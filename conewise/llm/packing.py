"""Best-fit packing of token pieces into sequences by a grouping genetic algorithm.

Documents are encoded and get an end id; only those longer than a sequence are
cut, the first piece shorter, the others full.  Full pieces are sequences of
their own.  The rest is split evenly into blocks of a bounded number of pieces,
each small enough for one task and large enough to pack almost without waste.

Each block is solved on several islands, one row and one task's work each.  An
island evolves a population of packings: a crossover injects well-filled whole
sequences of one parent into the other, removes the sequences that hold a piece
twice, and puts the displaced pieces back by best fit, longest first.  Between
epochs each island's elite, its best packing, moves to the next island of its
block, through a table in the shared folder.  The best island of a block wins.

Seeds depend on block, island and epoch only, so a lost task comes back the
same.  Token ids never move for the search: it sees lengths.

Defined cases: a null or empty text is the end id alone; equal rows are packed
one by one; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conewise.llm import tokens
from conewise.llm.common import parts_for, plain_text, read_table, ship, written

CAPACITY = 2048
#: Pieces that a block holds on average.
BLOCK = 4096
ISLANDS = 2
EPOCHS = 3
GENERATIONS = 8
POPULATION = 4
#: A sequence this full may be injected.
WELL_FILLED = 0.98

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"
STATE = "block long, island int, rows binary, lengths binary, packing binary, fitness double"
_SLICE = 2_000_000


def cut(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """The pieces of each document, with a number ``row`` of their own; ``ids`` (little-endian, 32 bits) if wanted."""
    ship(docs.sparkSession)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(tokenizer_path)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            sizes = pc.binary_length(batch.column(1)).to_pylist()
            for a, b in tokens.slices(sizes, _SLICE):
                out: list[tuple] = []
                texts, doc_ids = (batch.column(i).slice(a, b - a).to_pylist() for i in (1, 0))
                for doc_id, got in zip(doc_ids, encoder.encode(texts), strict=True):
                    raw = np.frombuffer(got, encoder.dtype).astype("<u4").tobytes() + end
                    n, at = len(raw) // 4, 0
                    for i in range(-(-n // capacity)):
                        to = n - (-(-n // capacity) - 1 - i) * capacity
                        part = raw[4 * at : 4 * to]
                        out.append((doc_id, i, at, to - at, zlib.crc32(part), part if with_ids else None))
                        at = to
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (
                        pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    cut_up = docs.select(F.col("doc_id").cast("long"), plain_text().alias("text")).mapInArrow(pieces, PIECES)
    return written(cut_up.withColumn("row", F.monotonically_increasing_id()), "pieces")


class Packing:
    """Pieces' sequences: ``of[i]`` is the sequence of piece i, ``fill[k]`` the tokens in sequence k."""

    def __init__(self, of: np.ndarray, lengths: np.ndarray, capacity: int) -> None:
        _, self.of = np.unique(of, return_inverse=True)
        self.fill = np.bincount(self.of, weights=lengths).astype(np.int64)
        # full sequences weigh more than their tokens: few, full sequences win
        self.fitness = float(np.square(self.fill / capacity).sum() / len(self.fill))

    def better(self, other: Packing) -> Packing:
        mine, yours = (-len(self.fill), self.fitness), (-len(other.fill), other.fitness)
        return self if mine >= yours else other


def best_fit(of: np.ndarray, todo: np.ndarray, lengths: np.ndarray, fill: np.ndarray, capacity: int) -> np.ndarray:
    """Put the pieces ``todo``, in this order, where the least room is left; new sequences where none has room."""
    room_of: list[list[int]] = [[] for _ in range(capacity + 1)]
    with_room = 0  # bit r: some sequence has r tokens of room
    for k, room in enumerate((capacity - fill).tolist()):
        if 0 < room < capacity:
            room_of[room].append(k)
            with_room |= 1 << room
    fresh = len(fill)
    for i, size in zip(todo.tolist(), lengths[todo].tolist(), strict=True):
        fits = with_room >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            k = room_of[room].pop()
            if not room_of[room]:
                with_room ^= 1 << room
        else:
            k, room, fresh = fresh, capacity, fresh + 1
        of[i] = k
        if room > size:
            if not room_of[room - size]:
                with_room |= 1 << (room - size)
            room_of[room - size].append(k)
    return of


def cross(one: Packing, two: Packing, lengths: np.ndarray, capacity: int, rng: np.random.Generator) -> Packing:
    """``one`` with some well-filled sequences of ``two``; displaced pieces go back by best fit."""
    good = np.flatnonzero(two.fill >= WELL_FILLED * capacity)
    if not len(good):
        good = np.argsort(-two.fill, kind="stable")[: max(1, len(two.fill) // 4)]
    chosen = np.zeros(len(two.fill), bool)
    chosen[good[rng.random(len(good)) < rng.uniform(0.2, 0.8)]] = True
    injected = chosen[two.of]
    broken = np.zeros(len(one.fill), bool)
    broken[one.of[injected]] = True
    # the emptiest sequences are opened too, else full parents leave nothing to refit
    broken[np.argsort(one.fill, kind="stable")[: max(1, len(one.fill) // 50)]] = True
    of = one.of.copy()
    of[injected] = len(one.fill) + two.of[injected]
    loose = np.flatnonzero(broken[one.of] & ~injected)
    of[loose] = -1
    fill = np.zeros(len(one.fill) + len(two.fill), np.int64)
    np.add.at(fill, of[of >= 0], lengths[of >= 0])
    order = loose[np.argsort(-lengths[loose] - rng.integers(0, 2 + capacity // 100, len(loose)), kind="stable")]
    return Packing(best_fit(of, order, lengths, fill, capacity), lengths, capacity)


def evolve(lengths: np.ndarray, elites: list[np.ndarray], capacity: int, seed: int) -> Packing:
    """The best packing after one epoch; ``elites`` start the population."""
    rng = np.random.default_rng(seed)
    people = [Packing(e, lengths, capacity) for e in elites]
    while len(people) < POPULATION:
        noise = 0 if not people else rng.integers(0, capacity // 20 + 2, len(lengths))
        order = np.argsort(-lengths - noise, kind="stable")
        of = best_fit(np.full(len(lengths), -1), order, lengths, np.zeros(0, np.int64), capacity)
        people.append(Packing(of, lengths, capacity))
    floor = -(-int(lengths.sum()) // capacity)  # no packing has fewer sequences
    best = people[0]
    for p in people[1:]:
        best = best.better(p)
    draw = random.Random(seed)
    for _ in range(GENERATIONS):
        if len(best.fill) == floor:
            break
        a, b = draw.sample(range(len(people)), 2)
        child = cross(people[a], people[b], lengths, capacity, rng)
        best = best.better(child)
        worst = max(range(len(people)), key=lambda i: (len(people[i].fill), -people[i].fitness))
        people[worst] = child.better(people[worst])
    return best


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(row, sequence_id, offset) for pieces (row, length) that a sequence can hold."""
    spark = pieces.sparkSession
    ship(spark)
    full = pieces.filter(F.col("length") == capacity).select(
        "row", (-F.col("row") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = pieces.filter(F.col("length") < capacity).select("row", "length")
    blocks = parts_for(rest.count(), BLOCK)

    def begin(table: pa.Table) -> pa.Table:
        table = table.sort_by("row")
        n = table.num_rows
        block = [table.column("block")[0].as_py()]
        rows, lengths = (table.column(c).to_numpy().astype("<i8").tobytes() for c in ("row", "length"))
        empty = np.zeros(0, "<i4").tobytes()
        return pa.table({
            "block": pa.array(block * ISLANDS, pa.int64()), "island": pa.array(range(ISLANDS), pa.int32()),
            "rows": pa.array([rows] * ISLANDS, pa.binary()), "lengths": pa.array([lengths] * ISLANDS, pa.binary()),
            "packing": pa.array([empty] * ISLANDS, pa.binary()), "fitness": pa.array([0.0 * n] * ISLANDS, pa.float64())})

    state = written(rest.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
                    .groupBy("block").applyInArrow(begin, STATE), "islands")
    for epoch in range(EPOCHS):
        came = state.select("block", ((F.col("island") + 1) % ISLANDS).alias("island"), F.col("packing").alias("migrant"))
        state = written(state.join(came, ["block", "island"]).repartition("block", "island")
                        .mapInArrow(_epoch(epoch, capacity), STATE), "islands")
    best = state.groupBy("block").agg(F.max_by(F.struct("rows", "lengths", "packing"), F.struct("fitness", -F.col("island"))).alias("best"))
    packed = best.select("block", "best.*").mapInArrow(_placed, "row long, sequence_id long, offset long")
    return full.unionByName(packed)


def _epoch(epoch: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                elites = [np.frombuffer(p, "<i4") for p in (r["packing"], r.pop("migrant")) if p]
                seed = (r["block"] * ISLANDS + r["island"]) * EPOCHS + epoch
                best = evolve(np.frombuffer(r["lengths"], "<i8"), elites, capacity, seed)
                # fewer sequences first, then fuller ones
                r |= {"packing": best.of.astype("<i4").tobytes(), "fitness": best.fitness - len(best.fill)}
                yield pa.RecordBatch.from_pydict(
                    {"block": pa.array([r["block"]], pa.int64()), "island": pa.array([r["island"]], pa.int32()),
                     "rows": pa.array([r["rows"]], pa.binary()), "lengths": pa.array([r["lengths"]], pa.binary()),
                     "packing": pa.array([r["packing"]], pa.binary()), "fitness": pa.array([r["fitness"]], pa.float64())})

    return run


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            rows, lengths = np.frombuffer(r["rows"], "<i8"), np.frombuffer(r["lengths"], "<i8")
            of = np.frombuffer(r["packing"], "<i4").astype(np.int64)
            order = np.argsort(of, kind="stable")
            upto = np.cumsum(lengths[order]) - lengths[order]
            first = np.concatenate(([True], np.diff(of[order]) > 0))
            offset = upto - np.maximum.accumulate(np.where(first, upto, 0))
            yield pa.RecordBatch.from_pydict(
                {"row": rows[order], "sequence_id": (r["block"] << 20) + of[order], "offset": offset})


def packed_sequences(pieces: DataFrame, packing: DataFrame) -> DataFrame:
    """(sequence_id, ids): the 32-bit ids of each sequence, from pieces that carry theirs."""
    placed = pieces.select("row", "ids").join(packing, "row")
    return placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p")).select(
        "sequence_id", F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))


def packed(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    pieces = cut(docs, tokenizer_path, end_id, capacity)
    return pieces.join(pack(pieces, capacity), "row").select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of ``docs`` stands in the packed sequences."""
    import public_tokenizers

    return packed(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(spark, read_table(spark, sf_dir, "documents"), sf_dir)
