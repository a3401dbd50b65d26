"""Connected components of a graph of any size.

Edges are first contracted in parts of at most about ``PART_EDGES``: a task joins the
edges of its part and gives each node its part's smallest.  A graph that fits one part
is done then, whatever its shape; the rest is left to alternating large and small
stars over the contracted edges.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conewise.llm.common import parts_for, ship, written

#: Edges that one task joins.
PART_EDGES = 1 << 19


def contracted(edges: DataFrame, parts: int) -> DataFrame:
    """Edges (a, b) from each node to the smallest that it reaches within its part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up: dict[int, int] = {}

        def root(x: int) -> int:
            while up[x] != x:
                up[x] = x = up[up[x]]
            return x

        for batch in batches:
            for x, y in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                x, y = root(up.setdefault(x, x)), root(up.setdefault(y, y))
                up[max(x, y)] = min(x, y)
        hung = [(x, root(x)) for x in up]
        hung = [p for p in hung if p[0] != p[1]]
        yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in hung], pa.int64()) for i in (0, 1)], ["a", "b"])

    dealt = edges.coalesce(1) if parts == 1 else edges.repartition(parts, "a")
    return dealt.mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, comp) for the nodes of ``links`` (a, b); ``comp`` is the smallest node reachable.

    Each step hangs every node's neighbours on its smallest neighbour, so paths
    shorten by more than half; edges never grow in number.  A step's edges are
    written to the shared folder; a hub's edges are an aggregate and a plain
    join, which adaptive execution can split.
    """
    ship(links.sparkSession)
    edges = written(_directed(links.select("a", "b")), "edges")
    parts = parts_for(edges.count(), PART_EDGES)
    edges = written(contracted(edges, parts), "contracted")
    mark = _mark(edges)
    while parts > 1:
        edges = written(_small_star(_large_star(edges)), "edges")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    hung = edges.select(F.col("a").alias("node"), F.col("b").alias("comp"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct()
    return written(hung.unionByName(roots), "components")


def _directed(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger node to the smaller."""
    return edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    return _directed(both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("a").agg(F.min("b").alias("low"))
    hung = edges.join(low, "a")
    return _directed(hung.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(low.select("a", F.col("low").alias("b"))))
