r"""Exact n-gram Jaccard join in the metric space of shingle sets.

Documents link when the Jaccard distance 1 - |x & y| / |x | y| of their sets is
at most 1 - t.  The join works on distinct sets ("classes"); documents with
equal sets share a class.

Pivots and regions.  Unrelated texts all lie at a distance close to 1, so whole
documents would make poor pivots: windows around them would replicate nearly
every document to every region.  The pivots are therefore the one-shingle sets
{s}: d(x, {s}) is 1 - 1/|x| if s is in x, else 1.  A document is nearest to its own
shingles; ties go by one global order, so its Voronoi region is that of its first
shingle in this order.

Windows.  Take as a pivot the set p of the first k shingles of x: d(x, p) is
1 - k/|x|.  A y without any of them has d(y, p) = 1, and by the triangle
inequality d(x, y) >= k/|x|.  With k = D + 1, D = floor((1-t) |x|), that is more
than 1 - t, so replicating each document to its first k regions loses no link.
With k = D + 1 + m linked documents meet in at least 1 + m of their regions, as at
most D of either one's shingles are not common.  m is an ``EXTRA``-th of D, of the
smaller document of a pair.

First level.  All classes, in the order of the shingles' hashes.  One shuffle
brings the rows (region, class) together, and each class counts the regions that
it shares with any other.  Classes with fewer than a link needs have no partner
and are done; few texts go on.

Second level.  The classes left are joined again, now in an order that has the
shingles first that few of them have, and with k = D + 1.  If x and y meet at
places i and j of their orders first, at most min(|x| - i, |y| - j) shingles are
common; and the empty set as a pivot bounds their sizes to a factor of 1/t.

In each of these regions the smallest class is a document pivot, the same in all
regions of a group of near copies: all members are compared with it exactly, and
links make components.  All members that share a document pivot make its cell, so
a group of near copies, which fills a region for each of its rare shingles, is one
cell.  Linked documents share a region, hence a cell.

Recursion.  An open cell, one with members of several components, that has more
than ``LARGE_PARTS`` blocks takes a new document pivot p.  All members are compared with
it, links join components, and the cell splits into rings floor(d(x, p) / (1 - t)).
By the triangle inequality d(x, p) and d(y, p) of linked documents differ by at
most 1 - t, so their rings are the same or neighbours: each ring is joined with
the members of the next lower one, the boundary documents, which are replicated
to it.  Rings are cells of the next round.  A cell whose largest ring holds most
of it is not split, but may take further pivots.  Rounds go on while they split
cells or link at least a ``SETTLED`` part of the members of large open cells.

Blocks.  Open cells that are left are dealt in parts of about ``BLOCK`` members, with
their whole sets: first each part is a block, then, where components are still
apart, each two parts of a cell.  A block counts common shingles
of all its members at once and gives only links between components, one less
than the components it joins at most, so what leaves it grows with the members,
however many pairs link.

The order on the second level comes from counters of fixed size (``SKETCH``, one byte
each when broadcast); shingles that share a counter change the order, never the
result.

Defined cases: a null or empty text, or one without words, has the empty set, is
linked with nothing and is its own component; a component of rows without ids
has a null id; equal rows have equal sets; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from conewise.llm import hashing, shingles
from conewise.llm.common import PAIR_ROWS, TEXT_ROWS, plain_text, read_table, ship, written
from conewise.llm.components import components

#: On the first level, one region more for so many shingles that linked sets may differ in.
EXTRA = 1
#: Members up to which a cell is compared in one block, and blocks from which a cell takes pivots first:
#: a pivot moves each member's set about as often as this many blocks do.
BLOCK = 1024
LARGE_PARTS = 8
#: A cell is split if its largest ring is smaller than this share of it.
SPLIT = 0.7
#: Rounds at most, and links for each member in a large open cell from which components are formed anew after a round.
ROUNDS = 4
SETTLED = 0.1
#: Counters of the order on the second level, and how they are cut and added up.
SKETCH = 1 << 21
COUNTER_BLOCK = 1 << 17
FAN_IN = 32

_SALT = np.uint64(0x5851F42D4C957F2D)


def _texts(batch: pa.RecordBatch) -> list[str]:
    return batch.column("text").to_pylist()


def _bounds(counts: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(counts)))


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of each text's values, modulo 2**64."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    at = _bounds(counts)
    return total[at[1:]] - total[at[:-1]]


def set_hash(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that tell sets apart."""
    return (_sums(hashing.mix(values), counts).view(np.int64), _sums(hashing.mix(values ^ _SALT), counts).view(np.int64))


def first_pivots(values: np.ndarray, counts: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The first shingles in hash order of each set, enough for the first level, and the set of each."""
    differ = counts * (100 - percent) // 100
    of = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(values)) - _bounds(counts)[of]
    chosen = place <= (differ + differ // EXTRA)[of]
    return values[chosen].view(np.int64), of[chosen]


def regions_needed(n, percent: int):
    """Regions that a set of n shingles shares with any that it links with; columns or arrays."""
    smallest = (n * percent + 99 - (n * percent + 99) % 100) / 100  # sizes of partners
    differ = smallest * (100 - percent)
    return 1 + (differ - differ % (100 * EXTRA)) / (100 * EXTRA)


def shingle_sets(docs: DataFrame, size: int) -> DataFrame:
    """Written table: a row per document with the size and the hash of its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, counts = shingles.sets(_texts(batch), size)
            hi, lo = set_hash(values, counts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("tie"), pa.array(counts), pa.array(hi), pa.array(lo)], ["doc_id", "tie", "n", "hi", "lo"])

    texts = docs.select(F.col("doc_id").cast("long"), plain_text().alias("text"))
    return written(texts.select("doc_id", F.xxhash64("text").alias("tie"), "text")
                   .mapInArrow(run, "doc_id long, tie long, n long, hi long, lo long")
                   .withColumn("row", F.monotonically_increasing_id()), "shingle-sets", TEXT_ROWS)


def replicated(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(s, hi): each set, by half its hash, in its first regions; equal sets of a batch once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, counts = shingles.sets(_texts(batch), size)
            hi = set_hash(values, counts)[0]
            _, one = np.unique(hi, return_index=True)
            first = np.zeros(len(hi), bool)
            first[one] = True
            found, who = first_pivots(values[np.repeat(first, counts)], counts[first], percent)
            yield pa.RecordBatch.from_pydict({"s": found, "hi": hi[first][who]})

    return docs.select(plain_text().alias("text")).mapInArrow(run, "s long, hi long")


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows in order of (s, hi): each hi once for every s that it shares with another."""
    last = None  # (s, hi of its first run, hi of the run at hand, runs so far)
    for batch in batches:
        if not batch.num_rows:
            continue
        s, hi = (batch.column(c).to_numpy() for c in ("s", "hi"))
        s0, first0, hi0, runs0 = last or (~s[0], 0, 0, 0)
        new_s = np.concatenate(([s[0] != s0], s[1:] != s[:-1]))
        new_run = new_s | np.concatenate(([hi[0] != hi0], hi[1:] != hi[:-1]))
        at = np.flatnonzero(new_run)
        run_hi, opens = hi[at], new_s[at]
        out = [run_hi[~opens]]
        second = np.flatnonzero(~opens[1:] & opens[:-1])  # runs whose next is the second of its s
        out.append(run_hi[second])
        if len(at) and not opens[0] and runs0 == 1:
            out.append(np.array([first0]))
        yield pa.RecordBatch.from_pydict({"hi": np.concatenate(out).astype(np.int64)})
        if opens.any():
            k = int(np.flatnonzero(opens)[-1])
            last = (s[-1], run_hi[k], hi[-1], len(at) - k)
        else:
            last = (s[-1], first0, hi[-1], runs0 + len(at))


def sharing(docs: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """Classes that share as many regions with others as a link needs."""
    ordered = replicated(docs, size, percent).repartition("s").sortWithinPartitions("s", "hi")
    counts = ordered.mapInArrow(_shared, "hi long").groupBy("hi").agg(F.count("*").alias("regions"))
    counts = written(counts, "region-counts", TEXT_ROWS)
    return classes.join(counts, "hi").filter(F.col("regions") >= regions_needed(F.col("n"), percent))


def class_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """Written table: (node, n, shingles) of some classes, from the text of one
    document of each, and rows (part, block, counts) of counters of their shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(SKETCH, np.uint32)
        for batch in batches:
            values, counts = shingles.sets(_texts(batch), size)
            seen += np.bincount((values & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH).astype(np.uint32)
            at, raw = (_bounds(counts) * 8).tolist(), values.tobytes()
            none = [pa.nulls(len(counts), t) for t in (pa.int64(), pa.int32(), pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(counts), pa.array([raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary()),
                 *none], names)
        if seen.any():
            blocks = SKETCH // COUNTER_BLOCK
            none = [pa.nulls(blocks, t) for t in (pa.int64(), pa.int64(), pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [*none, pa.array([TaskContext.get().partitionId()] * blocks, pa.int64()), pa.array(range(blocks), pa.int32()),
                 pa.array([c.tobytes() for c in seen.reshape(blocks, -1)], pa.binary())], names)

    schema = "node long, n long, shingles binary, part long, block int, counts binary"
    names = [c.split()[0] for c in schema.split(", ")]
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), plain_text().alias("text"))
    texts = texts.select("id", F.xxhash64("text").alias("text_hash"), "text")
    chosen = texts.join(wanted, (texts.text_hash == wanted.tie) & texts.id.eqNullSafe(wanted.doc_id)).select("node", "text")
    return written(chosen.mapInArrow(run, schema), "class-sets", TEXT_ROWS)


def shingle_order(counters: DataFrame) -> np.ndarray:
    """Rank of each counter, one byte: the larger, the more classes have its shingles."""

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(c, np.uint32).astype(np.uint64) for c in table.column("counts").to_pylist())
        total = np.minimum(total, np.uint64(0xFFFFFFFF)).astype(np.uint32)
        return pa.table({"part": table.column("part").slice(0, 1), "block": table.column("block").slice(0, 1), "counts": [total.tobytes()]})

    parts = (counters.agg(F.max("part")).first()[0] or 0) + 1
    while parts > 1:
        parts = -(-parts // FAN_IN)
        counters = written(counters.withColumn("part", F.floor(F.col("part") / FAN_IN)).groupBy("part", "block")
                           .applyInArrow(add, "part long, block int, counts binary"), "counters")
    total = np.zeros(SKETCH, np.uint32)
    for r in counters.collect():  # SKETCH counters, whatever the input
        total[r["block"] * COUNTER_BLOCK : (r["block"] + 1) * COUNTER_BLOCK] = np.frombuffer(r["counts"], np.uint32)
    return np.floor(4 * np.log2(total.astype(np.float64) + 1)).astype(np.uint8)


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) with the sizes of both sets and of their common part: a, b, n, m, both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros((3, batch.num_rows), np.int64)
            for i, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"), strict=True)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                out[:, i] = len(x), len(y), _common(x, y)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), *map(pa.array, out)], ["a", "b", "n", "m", "both"])

    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long, n long, m long, both long")


def _common(x: np.ndarray, y: np.ndarray) -> int:
    x, y = (x, y) if len(x) < len(y) else (y, x)
    return int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())


def _links(n, m, both, percent: int):
    """100 |x & y| >= percent |x | y|, for columns or arrays."""
    return 100 * both >= percent * (n + m - both)


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 |x & y| >= percent |x | y|."""
    return compared(pairs, sets).filter(_links(F.col("n"), F.col("m"), F.col("both"), percent)).select("a", "b")


def second_level(sets: DataFrame, order, percent: int) -> DataFrame:
    """Members (s, node, n, place) of the regions of single shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = order.value
        for batch in batches:
            counts = batch.column("n").to_numpy()
            values = np.frombuffer(b"".join(batch.column("shingles").to_pylist()), np.uint64)
            of = np.repeat(np.arange(len(counts)), counts)
            at = np.lexsort((values, rank[(values & np.uint64(SKETCH - 1)).astype(np.int64)], of))
            place = np.arange(len(values)) - np.repeat(_bounds(counts)[:-1], counts)
            chosen = place <= (counts * (100 - percent) // 100)[of]
            who = of[chosen]
            yield pa.RecordBatch.from_pydict({
                "s": values[at][chosen].view(np.int64), "node": batch.column("node").to_numpy()[who], "n": counts[who],
                "place": place[chosen]})

    members = written(sets.select("node", "n", "shingles").mapInArrow(run, "s long, node long, n long, place long"), "second-level", TEXT_ROWS)
    shared = (members.groupBy("s").agg(F.min("node").alias("low"), F.max("node").alias("high"))
              .filter("low <> high").select("s"))
    return written(members.join(written(shared, "shared").hint("merge"), "s"), "members")  # the same join at every size


def _reachable(n: str, place: str, m: str, other: str, percent: int):
    """Bounds on the sizes and places at which two sets meet first."""
    n, place, m, other = (F.col(c) for c in (n, place, m, other))
    return ((100 * F.least(n, m) >= percent * F.greatest(n, m))
            & (F.least(n - place, m - other) * (100 + percent) >= percent * (n + m)))


def met_pivots(members: DataFrame, percent: int) -> DataFrame:
    """Written table (cell, node, n, near): the classes in the regions of each document pivot, the cell.

    ``near`` tells whether sizes and places allow a link with the pivot.
    """
    pivots = members.groupBy("s").agg(F.min(F.struct("node", "n", "place")).alias("p"))
    met = members.join(written(pivots, "pivots"), "s")
    near = (F.col("node") != F.col("p.node")) & _reachable("n", "place", "p.n", "p.place", percent)
    return written(met.select(F.col("p.node").alias("cell"), "node", "n", near.cast("int").alias("near"))
                   .groupBy("cell", "node").agg(F.first("n").alias("n"), F.max("near").alias("near")), "cells")


def _labelled(cells: DataFrame, found: DataFrame | None) -> DataFrame:
    if found is None:
        return cells.withColumn("comp", F.col("node"))
    return cells.join(found, "node", "left").withColumn("comp", F.coalesce("comp", "node"))


def _open(cells: DataFrame, found: DataFrame | None) -> DataFrame:
    """Written table (cell, node, n, comp, size) of the cells with several components."""
    labelled = _labelled(cells.select("cell", "node", "n"), found)
    sizes = labelled.groupBy("cell").agg(F.count("*").alias("size"), F.min("comp").alias("low"), F.max("comp").alias("high"))
    return written(labelled.join(sizes.filter("low < high").select("cell", "size"), "cell"), "open")


def _ring(percent: int) -> Column:
    """floor(distance / (1 - t)), exact."""
    union = F.col("n") + F.col("m") - F.col("both")
    return F.call_function("div", 100 * (union - F.col("both")), union * F.lit(100 - percent))


def pivot_round(cells: DataFrame, sets: DataFrame, percent: int, number: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One pivot for each cell: links (a, b), the cells' rings as new cells, and the cells that rings do not split."""
    pivots = cells.groupBy("cell").agg(F.min(F.struct(F.xxhash64("node", F.lit(number)).alias("h"), "node")).alias("p"))
    met = written(cells.join(pivots.select("cell", F.col("p.node").alias("pivot")), "cell"), "met")
    pairs = met.select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
    measured = written(compared(pairs, sets), "measured", PAIR_ROWS)
    links = measured.filter(_links(F.col("n"), F.col("m"), F.col("both"), percent) & (F.col("a") != F.col("b"))).select("a", "b")
    rings = written(met.join(measured.select(F.col("a").alias("node"), F.col("b").alias("pivot"), _ring(percent).alias("ring")),
                             ["node", "pivot"]).select("cell", "node", "n", "size", "ring"), "rings")
    whole = (rings.groupBy("cell", "size", "ring").count().groupBy("cell", "size").agg(F.max("count").alias("most"))
             .filter(F.col("most") >= SPLIT * F.col("size")).select("cell"))
    whole = written(whole, "whole")
    apart = rings.join(whole, "cell", "left_anti")
    ring = F.explode(F.array("ring", F.col("ring") + 1)).alias("of")  # its own ring, and the next as a boundary document
    split = apart.select("cell", "node", "n", ring).select(F.xxhash64("cell", "of").alias("cell"), "node", "n").distinct()
    return links, written(split, "ring-cells"), rings.join(whole, "cell").select("cell", "node", "n")


def block_links(cells: DataFrame, sets: DataFrame, percent: int, across: bool) -> DataFrame:
    """Links (a, b) between different components of open cells (cell, node, comp, size): within their parts, or across them."""
    parts = F.ceil(F.col("size") / BLOCK).cast("int")
    dealt = (cells.join(sets.select("node", "shingles"), "node")
             .withColumn("own", F.pmod(F.xxhash64("node"), parts).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)) if across else F.col("own"))
             .filter(F.col("own") != F.col("other") if across else F.lit(True))
             .select("cell", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                     (F.col("own") > F.col("other")).alias("second"), "node", "comp", "shingles"))
    key = ["cell", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            ends = _ends([table[c].to_numpy() for c in key])
            for a, b in pairwise([0, *ends]):
                yield from _joined(table.slice(a, b - a), percent)
            rest = table.slice(ends[-1] if ends else 0)  # the last block may go on
        if rest is not None:
            yield from _joined(rest, percent)

    return dealt.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, "a long, b long").distinct()


def _ends(columns: list[np.ndarray]) -> list[int]:
    """Where a row differs from the one before."""
    return (np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1).tolist() if len(columns[0]) else []


def _joined(block: pa.Table, percent: int) -> Iterator[pa.RecordBatch]:
    """Links of a block that join its components."""
    nodes, comps, second = (block[c].to_pylist() for c in ("node", "comp", "second"))
    if len(set(comps)) < 2:
        return
    i, j = block["i"][0].as_py(), block["j"][0].as_py()
    sets = [np.frombuffer(x, np.uint64) for x in block["shingles"].to_pylist()]
    root = {c: c for c in comps}

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = c = root[root[c]]
        return c

    out = []
    for x, y in _close(sets, percent):
        u, v = find(comps[x]), find(comps[y])
        if u != v and (i == j or second[x] != second[y]):
            root[max(u, v)] = min(u, v)
            out.append((nodes[x], nodes[y]))
    if out:
        yield pa.RecordBatch.from_pydict({"a": [max(p) for p in out], "b": [min(p) for p in out]})


def _close(sets: list[np.ndarray], percent: int) -> Iterator[tuple[int, int]]:
    """Pairs of sets (places x < y) that link."""
    size = np.array([len(x) for x in sets])
    if len(sets) <= 16:
        for x in range(len(sets)):
            for y in range(x + 1, len(sets)):
                if 100 * min(size[x], size[y]) >= percent * max(size[x], size[y]) and _links(size[x], size[y], _common(sets[x], sets[y]), percent):
                    yield x, y
        return
    values, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    own = np.repeat(np.arange(len(sets)), size)
    kept = count[at] > 1  # shingles of one member are common to none
    number = np.cumsum(count > 1) - 1
    at, own = number[at[kept]], own[kept]
    order = np.argsort(at, kind="stable")
    at, own = at[order], own[order]
    both = np.zeros((len(sets), len(sets)), np.float32)  # counts below 2**24 are exact
    for low in range(0, int(at[-1]) + 1 if len(at) else 0, 2048):
        a, b = np.searchsorted(at, (low, low + 2048))
        marks = np.zeros((len(sets), 2048), np.float32)
        marks[own[a:b], at[a:b] - low] = 1
        both += marks @ marks.T
    near = _links(size[:, None], size[None, :], both.astype(np.int64), percent)
    for x, y in zip(*(p.tolist() for p in np.nonzero(np.triu(near, 1))), strict=True):
        yield x, y


def join_components(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame | None:
    """(node, comp) of all linked classes; None without links."""
    cells = met_pivots(members, percent)
    pairs = cells.filter("near = 1").select(F.col("node").alias("a"), F.col("cell").alias("b"))
    links = written(linked(pairs, sets, percent), "links", PAIR_ROWS)
    found = None if links.isEmpty() else components(links)
    open_ = _open(cells, found)
    for number in range(ROUNDS):
        large = open_.filter(F.col("size") > BLOCK * LARGE_PARTS)
        left = large.count()
        if not left:
            break
        more, split, whole = pivot_round(large, sets, percent, number)
        more = written(more, "pivot-links")
        links = written(links.unionByName(more), "links")
        settled = more.count() >= SETTLED * left
        if not settled and split.isEmpty():
            break
        if settled:  # else the older components only leave more to compare
            found = components(links)
        small = open_.filter(F.col("size") <= BLOCK * LARGE_PARTS).select("cell", "node", "n")
        open_ = _open(small.unionByName(split).unionByName(whole), found)
    for across in (False, True):  # parts by themselves first: fewer components are left to join across them
        if across:
            open_ = open_.filter(F.col("size") > BLOCK)
            if open_.isEmpty():
                break
            found = None if links.isEmpty() else components(links)
            open_ = _open(open_.select("cell", "node", "n"), found)
        more = written(block_links(open_, sets, percent, across), "block-links")
        links = written(links.unionByName(more), "links")
    return None if links.isEmpty() else components(links)


def jaccard_components(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, tie (hash of its text), stays.

    One text of each component stays: ids before nulls, then the smallest id, then the smallest hash.

    ``size`` words make a shingle; documents link from ``percent`` percent on.
    """
    ship(docs.sparkSession)
    rows = shingle_sets(docs, size)
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tie", "row")
    classes = written(
        rows.filter("n > 0").groupBy("hi", "lo", "n").agg(F.min(first).alias("first"))
        .select("hi", "lo", "n", F.col("first.row").alias("node"), F.col("first.doc_id").alias("doc_id"), F.col("first.tie").alias("tie")),
        "classes")
    wanted = written(sharing(docs, classes, size, percent).select("node", "doc_id", "tie"), "wanted").hint("merge")
    made = class_sets(docs, wanted, size)
    order = docs.sparkSession.sparkContext.broadcast(shingle_order(made.filter("block is not null").select("part", "block", "counts")))
    sets = written(made.filter("node is not null").groupBy("node").agg(*[F.first(c).alias(c) for c in ("n", "shingles")]), "sets")
    found = join_components(second_level(sets, order, percent), sets, percent)
    of = classes if found is None else classes.join(found, "node", "left")
    of = of.withColumn("comp", F.col("node") if found is None else F.coalesce("comp", "node"))
    keeper = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tie"))
    lowest = of.groupBy("comp").agg(F.min("doc_id").alias("component_id"), keeper.alias("keeper"))
    labels = written(of.join(written(lowest, "lowest"), "comp").select("hi", "lo", "component_id", "keeper"), "labels")
    stays = F.col("doc_id").eqNullSafe(F.col("keeper.doc_id")) & (F.col("tie") == F.col("keeper.tie"))
    some = rows.filter("n > 0").join(labels, ["hi", "lo"]).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", "tie", stays.alias("stays"))
    none = rows.filter("n = 0").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), "tie", F.lit(True).alias("stays"))
    return some.unionByName(none)


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read_table(spark, sf_dir, "documents"), size=3, percent=90).select(
        "doc_id", "n_shingles", "component_id")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` with one document of each group of near copies (five-word shingles,
    similarity 0.8 or more), the one with the smallest id; all columns.

    Rows with the same id and text are one document and stay or go together.
    """
    columns = docs.columns
    drop = written(jaccard_components(docs).filter(~F.col("stays")).select("doc_id", "tie").distinct(), "near-copies").hint("merge")
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"), F.col("doc_id").cast("long").alias("id"),
                        F.xxhash64(plain_text()).alias("text_hash"))
    return keyed.join(drop, keyed.id.eqNullSafe(drop.doc_id) & (keyed.text_hash == drop.tie), "left_anti").select("doc.*")
