r"""Merkle manifest of a dataset by time-forward processing.

Every row becomes a leaf; leaves of a language, in the order of their ids, are
folded eight at a time until one subroot is left, and the subroots, in the order
of their languages, are folded alike into the root.

Upward sweep.  A node's label is the place at which its last leaf ends, and its
level.  Digests are messages to the parent's label.  Within a block of
``FAN ** LEVELS`` consecutive nodes a priority queue ordered by label holds them: as soon as the
sweep has passed a label, all children of that node are at the head of the queue,
and the node's own digest is sent on.  Messages that leave a block go to the
external part of the queue, a written table that Spark sorts and deals by block
for the next round.  A round lifts the tree by ``LEVELS`` levels, so the rounds
are few however many rows there are.

Reversed sweep.  From the root down, each node hands its children their proof
suffix: the digests left and right of the child on its own level, then the node's
own suffix.  Only one suffix a block goes between rounds; the suffixes of leaves
are hashed, or folded up with a presented leaf, where they arrive.

Blocks have a fixed size, so a language with any share of the rows is spread
over many tasks; places come from a range sort with an offset for each part.

Defined cases: a null language is a tree of its own and comes first; null ids come
before all others, rows with the same id are ordered by their leaf digest; equal
rows are leaves of their own; null fields count as ``-``; texts of any length
are hashed whole; a lone leaf is its subroot and a lone subroot the root (a proof
without siblings is the hash of nothing); no rows give no rows; other columns
are not read.
"""

from __future__ import annotations

import hashlib
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from conewise.llm.common import lower_ascii, parts_for, read_table, ship, written

#: Children of a node.
FAN = 8
#: Levels that a round lifts the tree; a block has ``FAN ** LEVELS`` nodes.
LEVELS = 4
#: Rows that a part of the range sort holds on average.
PART_ROWS = 200_000

#: Fields of a leaf, in the order in which they are hashed.
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
_ITEM = "forest string, idx long, size long, digest string"
_SUFFIX = "forest string, idx long, suffix array<string>, subroot string, root string"


def field(value: Column) -> Column:
    """A field's bytes: ``-`` for null, else its length in bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*[field(values[c]) for c in FIELDS]), 256)


def node_digest(children: list[str]) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


def forest_key(lang: Column) -> Column:
    """Null first, then languages in the order of their bytes."""
    return F.when(lang.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), lang.cast("string")))


def numbered(items: DataFrame, order: list[str], name: str, part_rows: int = PART_ROWS) -> DataFrame:
    """``items`` with their place ``idx`` in their forest and its ``size``; ``order`` starts with the forest."""
    parts = parts_for(items.count(), part_rows)
    sorted_ = items.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = written(sorted_.withColumn("at", F.monotonically_increasing_id()), f"{name}-sorted").withColumn("part", F.shiftright("at", 33))
    before = Window.partitionBy("forest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy("forest", "part").agg(F.min("at").alias("low"), F.count("*").alias("n"))
               .withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
               .withColumn("size", F.sum("n").over(Window.partitionBy("forest"))).drop("n"))
    joined = placed.join(written(offsets, f"{name}-offsets"), ["forest", "part"])
    return written(joined.withColumn("idx", F.col("at") - F.col("low") + F.col("offset")).drop("at", "part", "low", "offset"), name)


def _sizes(size: int, levels: int) -> list[int]:
    """Nodes of each level from this round's lowest to its highest."""
    out = [size]
    while out[-1] > 1 and len(out) <= levels:
        out.append(-(-out[-1] // FAN))
    return out


def sweep(first: int, size: int, digests: list[str], levels: int = LEVELS) -> tuple[int, int, str]:
    """Place, number of nodes and digest of the one node that a block of consecutive nodes leaves."""
    sizes = _sizes(size, levels)
    queue: list[tuple[int, int, int, str]] = []  # (end of the parent's leaves, its level, child's place, digest)

    def send(level: int, index: int, digest: str) -> tuple[int, int, str] | None:
        if level == len(sizes) - 1:
            return index, sizes[-1], digest
        end = min((index // FAN + 1) * FAN ** (level + 1), size)
        heappush(queue, (end, level + 1, index, digest))
        return None

    left = None
    for i, digest in enumerate(digests, first):
        left = send(0, i, digest)
        while queue and queue[0][0] <= i + 1:  # the sweep has passed this label: all its children are here
            end, level, index, child = heappop(queue)
            children = [child]
            while queue and queue[0][:2] == (end, level):
                children.append(heappop(queue)[3])
            left = send(level, index // FAN, node_digest(children))
    return left


def _blocked(items: DataFrame, levels: int) -> DataFrame:
    return items.withColumn("block", F.floor(F.col("idx") / FAN**levels))


def rounds_up(items: DataFrame, name: str, levels: int = LEVELS) -> list[DataFrame]:
    """The nodes at the start of each round, at last one node for each forest."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("idx")
        index, size, digest = sweep(table["idx"][0].as_py(), table["size"][0].as_py(), table["digest"].to_pylist(), levels)
        return pa.table({"forest": table["forest"].slice(0, 1), "idx": [index], "size": [size], "digest": [digest]})

    rounds = [items]
    while not rounds[-1].filter("size > 1").isEmpty():
        queue = _blocked(rounds[-1].select("forest", "idx", "size", "digest"), levels)
        rounds.append(written(queue.groupBy("forest", "block").applyInArrow(run, _ITEM), f"{name}-{len(rounds)}"))
    return rounds


def suffixes(size: int, digests: list[str], suffix: list[str], levels: int = LEVELS) -> list[list[str]]:
    """Proof suffix of each node of a block whose last node has ``suffix``: left and right digests, level by level."""
    sizes = _sizes(size, levels)
    nodes_of = [digests]
    for _ in sizes[1:]:
        below = nodes_of[-1]
        nodes_of.append([node_digest(below[i : i + FAN]) for i in range(0, len(below), FAN)])
    below = [suffix]
    for level in range(len(sizes) - 2, -1, -1):
        nodes, above = nodes_of[level], below
        below = []
        for i in range(len(nodes)):
            run = i - i % FAN
            below.append(["".join(nodes[run:i]), "".join(nodes[i + 1 : run + FAN]), *above[i // FAN]])
    return below


def fold(leaf: str, suffix: list[str]) -> str:
    """The root that a leaf and its proof give."""
    for i in range(0, len(suffix), 2):
        leaf = node_digest([suffix[i], leaf, suffix[i + 1]])
    return leaf


def _delivered(nodes: DataFrame, messages: DataFrame, use, schema: str, levels: int) -> DataFrame:
    """``use(nodes of a block, their suffixes, subroot, root)`` for each block and the message that it gets."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        left, message = left.sort_by("idx"), right.to_pylist()[0]
        found = suffixes(left["size"][0].as_py(), left["digest"].to_pylist(), message["suffix"], levels)
        return use(left, found, message["subroot"], message["root"])

    by_block = messages.withColumn("block", F.col("idx"))
    return _blocked(nodes, levels).groupBy("forest", "block").cogroup(by_block.groupBy("forest", "block")).applyInArrow(run, schema)


def _hand_down(table: pa.Table, found: list[list[str]], subroot: str, root: str) -> pa.Table:
    n = table.num_rows
    return pa.table({"forest": table["forest"], "idx": table["idx"], "suffix": pa.array(found, pa.list_(pa.string())),
                     "subroot": [subroot] * n, "root": [root] * n})


def rounds_down(rounds: list[DataFrame], messages: DataFrame, name: str, levels: int) -> DataFrame:
    """Messages to the blocks of the first round, from those to the last round's nodes."""
    for i in range(len(rounds) - 2, 0, -1):
        messages = written(_delivered(rounds[i], messages, _hand_down, _SUFFIX, levels), f"{name}-down-{i}")
    return messages


class Manifest:
    """The written tree of ``docs``: ``leaves`` (forest, idx, digest and the rows' ids), ``rounds``, ``subroots``, ``root``.

    ``presented`` changes fields of the documents that are to be verified
    against the tree of the unchanged ones.
    """

    def __init__(self, docs: DataFrame, presented: dict[str, Column] | None = None, levels: int = LEVELS, part_rows: int = PART_ROWS) -> None:
        ship(docs.sparkSession)
        self.levels = levels
        given = {c: F.col(c) for c in FIELDS}
        rows = docs.select(*FIELDS).select(
            forest_key(F.col("lang")).alias("forest"), F.col("doc_id").cast("long"), leaf_digest(given).alias("digest"),
            leaf_digest({**given, **(presented or {})}).alias("presented"), F.monotonically_increasing_id().alias("row"))
        self.leaves = numbered(written(rows, "leaves"), ["forest", "doc_id", "digest", "row"], "places", part_rows)
        self.rounds = rounds_up(self.leaves, "nodes", levels)
        self.subroots = self.rounds[-1].select("forest", "digest")
        top = self.subroots.select(F.lit("*").alias("forest"), F.col("forest").alias("key"), "digest")
        self.top = numbered(top, ["forest", "key"], "subroots")
        self.top_rounds = rounds_up(self.top, "top", levels)

    @property
    def root(self) -> str | None:
        """The digest of the whole dataset; None without rows."""
        row = self.top_rounds[-1].select("digest").first()
        return row and row[0]

    def _messages(self) -> DataFrame:
        """The proof suffix of each leaf block's topmost node."""
        last = self.top_rounds[-1].select("forest", "idx", F.expr("cast(array() as array<string>)").alias("suffix"),
                                          F.lit("").alias("subroot"), F.col("digest").alias("root"))
        above = rounds_down(self.top_rounds, last, "top", self.levels)
        if len(self.top_rounds) > 1:
            above = written(_delivered(self.top, above, _hand_down, _SUFFIX, self.levels), "top-down-0")
        by_key = self.top.select("idx", "key", F.col("digest").alias("own")).join(above.select("idx", "suffix", "root"), "idx")
        return rounds_down(self.rounds, by_key.select(
            F.col("key").alias("forest"), F.lit(0).cast("long").alias("idx"), "suffix", F.col("own").alias("subroot"), "root"),
            "nodes", self.levels)

    def verified(self, with_siblings: bool = False) -> DataFrame:
        """One row per leaf: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

        ``with_siblings`` adds the proof itself, as digests left and right of the path, level by level.
        """

        def run(table: pa.Table, found: list[list[str]], subroot: str, root: str) -> pa.Table:
            folded = [fold(p, s) for p, s in zip(table["presented"].to_pylist(), found, strict=True)]
            n = table.num_rows
            columns = {"doc_id": table["doc_id"], "leaf": table["digest"], "subroot": [subroot] * n, "root": [root] * n,
                       "proof_sha256": [node_digest(s) for s in found], "folded_root": folded, "verified": [f == root for f in folded]}
            if with_siblings:
                columns["siblings"] = pa.array(found, pa.list_(pa.string()))
            return pa.table(columns)

        schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
        return _delivered(self.leaves, self._messages(), run, schema + (", siblings array<string>" if with_siblings else ""), self.levels)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's tampering: where 3 divides the crc32 of the id, A-Z of the text are lower-cased."""
    hit = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    text = F.when(hit, lower_ascii(F.col("text"))).otherwise(F.col("text"))
    return Manifest(read_table(spark, sf_dir, "documents"), {"text": text}).verified()


_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR END"
_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_STEP = "xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1))"  # one bit of the reflected CRC-32

ORACLE = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, lang, n_chars, text,
         CASE WHEN doc_id IS NULL THEN false ELSE xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(
           string_split(doc_id::VARCHAR, ''), lambda c: [ord(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0])),
           lambda a, x: {_STEP}), 4294967295) % 3 = 0 END AS hit
  FROM documents
),
h AS (
  SELECT doc_id, lang, sha256({" || ".join(_FIELD.format(c) for c in FIELDS)}) AS leaf,
         sha256({" || ".join(_FIELD.format("t") if c == "text" else _FIELD.format(c) for c in FIELDS)}) AS shown
  FROM (SELECT *, CASE WHEN hit THEN {_LOWERED} ELSE text END AS t FROM d)
),
leaf AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n FROM h
),
up AS (
  SELECT lang, 0 AS level, idx, n, leaf AS h FROM leaf
  UNION ALL
  SELECT lang, level + 1, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM up WHERE n > 1 GROUP BY lang, level, idx // 8, n
),
subroots AS (
  SELECT lang, level, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM up WHERE n = 1
),
top AS (
  SELECT 0 AS level, idx, n, h FROM subroots
  UNION ALL
  SELECT level + 1, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM top WHERE n > 1 GROUP BY level, idx // 8, n
),
nodes AS (
  SELECT 1 AS tree, lang, level, idx, n, h FROM up UNION ALL SELECT 2, NULL, level, idx, n, h FROM top
),
beside AS (
  SELECT tree, lang, level, idx,
         coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM nodes WHERE n > 1 WINDOW w AS (PARTITION BY tree, lang, level, idx // 8 ORDER BY idx)
),
path AS (
  SELECT row_number() OVER () AS id, 1 AS tree, lang, 0 AS level, idx, shown AS h, '' AS proof FROM leaf
  UNION ALL
  SELECT p.id, coalesce(b.tree, 2), CASE WHEN b.tree IS NULL THEN NULL ELSE p.lang END, CASE WHEN b.tree IS NULL THEN 0 ELSE p.level + 1 END,
         CASE WHEN b.tree IS NULL THEN s.idx ELSE p.idx // 8 END,
         CASE WHEN b.tree IS NULL THEN p.h ELSE sha256(b.l || p.h || b.r) END, p.proof || coalesce(b.l || b.r, '')
  FROM path p
  LEFT JOIN beside b ON p.tree = b.tree AND p.lang IS NOT DISTINCT FROM b.lang AND p.level = b.level AND p.idx = b.idx
  LEFT JOIN subroots s ON p.tree = 1 AND p.lang IS NOT DISTINCT FROM s.lang
  WHERE b.tree IS NOT NULL OR p.tree = 1
),
done AS (SELECT id, max_by(h, (tree, level)) AS folded_root, max_by(proof, (tree, level)) AS proof FROM path WHERE tree = 2 GROUP BY id),
numbered AS (SELECT row_number() OVER () AS id, * FROM leaf),
root AS (SELECT h FROM top WHERE n = 1)
SELECT l.doc_id, l.leaf, s.h AS subroot, root.h AS root, sha256(d.proof) AS proof_sha256, d.folded_root, d.folded_root = root.h AS verified
FROM numbered l JOIN done d USING (id) JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang CROSS JOIN root
"""
