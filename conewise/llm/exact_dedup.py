"""Exact duplicates against immutable snapshots, screened by static binary-fuse filters.

A corpus comes as generations: snapshots that no longer change, and one batch
of incoming documents.  Every text gets the SHA-256 of its normalised form (each
run of ASCII white space as one space).

1. Each snapshot's distinct digests are split into buckets by digest, and every
   bucket gets a binary-fuse filter (built once; it never misses a member).
2. The batch is grouped on its own, so a digest is looked up once.
3. A group that all filters of its bucket rule out is new and goes no further.
   The positives join the snapshots' exact buckets.
4. Each digest's documents are compared byte for byte: a task first reduces copies
   to their distinct texts, so a hot digest sends one text a task to its bucket;
   two different texts under one digest raise an error.

A group's smallest ``doc_id`` stays.  Digests are spread evenly, so buckets have
a bounded size; groups are reduced before each shuffle, and only plain joins
that adaptive execution can split see a group's rows.

Defined cases: a null text is the empty text; null ids come after all others;
among rows with the same id and text one stays; other columns are not read; no
rows give no rows; texts of any length are hashed and compared whole.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from conewise.llm import fuse_filter
from conewise.llm.common import parts_for, plain_text, read_table, ship, written

#: Digests that one bucket holds on average.
BUCKET = 4096


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")


def digest(text: Column) -> Column:
    """SHA-256 of the normalised text as 32 bytes."""
    return F.unhex(F.sha2(F.encode(normalised(text), "UTF-8"), 256))


def _key(sha: Column) -> Column:
    """The digest's first 60 bits."""
    return F.conv(F.substring(F.hex(sha), 1, 15), 16, 10).cast("long")


def _groups(rows: DataFrame, *more: str) -> DataFrame:
    """The row that stays in each group (ids before nulls, then the smallest, then the first row), and the size."""
    keep = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    return rows.groupBy(*more, "sha").agg(F.min(keep).alias("keep"), F.count("*").alias("n"))


def build_filters(groups: DataFrame, buckets: int) -> DataFrame:
    """One row (snapshot, bucket, filter) for each bucket of each snapshot's digests."""

    def build(table: pa.Table) -> pa.Table:
        made = fuse_filter.build(table.column("key").to_numpy())
        return pa.table({
            "snapshot": table.column("snapshot").slice(0, 1), "bucket": table.column("bucket").slice(0, 1),
            "seed": [made.seed], "segment": [made.segment], "starts": [made.starts], "data": [made.table.tobytes()]})

    keyed = groups.select("snapshot", _key(F.col("sha")).alias("key")).withColumn("bucket", F.col("key") % buckets)
    return keyed.groupBy("snapshot", "bucket").applyInArrow(
        build, "snapshot int, bucket long, seed long, segment long, starts long, data binary")


def screen(groups: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """``groups`` with ``maybe``: some snapshot's filter does not rule the digest out."""

    def look_up(left: pa.Table, right: pa.Table) -> pa.Table:
        keys = left.column("key").to_numpy()
        maybe = np.zeros(len(keys), bool)
        for f in right.to_pylist():
            maybe |= fuse_filter.FuseFilter(
                f["seed"], f["segment"], f["starts"], np.frombuffer(f["data"], np.uint16)).may_hold(keys)
        return pa.table({"sha": left.column("sha"), "maybe": maybe})

    keyed = groups.select("sha", _key(F.col("sha")).alias("key")).withColumn("bucket", F.col("key") % buckets)
    seen = keyed.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInArrow(look_up, "sha binary, maybe boolean")
    return groups.join(seen, "sha")


def exact_dedup(snapshots: list[DataFrame], batch: DataFrame, check_bytes: bool = True) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, sha (32 bytes), snapshot (null: batch)."""
    ship(batch.sparkSession)
    rows = written(
        reduce(DataFrame.unionByName, [
            d.select(F.col("doc_id").cast("long"), digest(plain_text()).alias("sha"),
                     F.lit(i if i < len(snapshots) else None).cast("int").alias("snapshot"))
            for i, d in enumerate([*snapshots, batch])
        ]).withColumn("row", F.monotonically_increasing_id()),
        "digests",
    )
    old = written(_groups(rows.filter(F.col("snapshot").isNotNull()), "snapshot"), "snapshot-groups")
    new = written(_groups(rows.filter(F.col("snapshot").isNull())), "batch-groups")
    buckets = parts_for(max(old.count(), new.count()), BUCKET)
    screened = written(screen(new, build_filters(old, buckets), buckets), "screened")
    of = ["sha", "keep", "n"]
    joined = (old.select(*of).unionByName(screened.filter("maybe").select(*of))
              .groupBy("sha").agg(F.min("keep").alias("keep"), F.sum("n").alias("n")))
    groups = written(joined.unionByName(screened.filter("not maybe").select(*of)), "groups")
    if check_bytes:
        verify([*snapshots, batch])
    return rows.join(groups, "sha").select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("row") == F.col("keep.row")).alias("kept"), "sha", "snapshot")


def verify(sources: list[DataFrame]) -> None:
    """Compare the normalised bytes of all documents that share a digest.

    A set aggregate: each task reduces the copies of a digest to their distinct
    texts, one unless digests clash, before they are shuffled to the digest's bucket.
    """
    texts = reduce(DataFrame.unionByName, [
        d.select(F.col("doc_id").cast("long"), normalised(plain_text()).alias("norm"),
                 digest(plain_text()).alias("sha")) for d in sources])
    buckets = texts.groupBy("sha").agg(F.size(F.collect_set("norm")).alias("texts"), F.min("doc_id").alias("doc_id"))
    differ = buckets.filter("texts > 1").agg(F.count("*"), F.min("doc_id")).first()
    if differ[0]:
        raise ValueError(f"texts differ under {differ[0]} digests, one of them has the id {differ[1]}")


def generations(docs: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Two snapshots and a batch by thirds of the id range; smaller ids are older, null ids are new."""
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    if low is None:
        return [], docs
    a, b = low + (high - low) // 3, low + 2 * (high - low) // 3
    i = F.col("doc_id")
    return [docs.filter(i <= a), docs.filter((i > a) & (i <= b))], docs.filter(i.isNull() | (i > b))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup(*generations(read_table(spark, sf_dir, "documents")))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id,
       min(doc_id) OVER g AS keep_id,
       count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept,
       text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` without the rows that a smaller id repeats; all columns.

    Rows with the same id and normalised text are one document and give one row.
    """
    columns = docs.columns
    found = exact_dedup(*generations(docs))
    wanted = (found.filter("kept").select("doc_id", "sha"))
    repeated = written(found.groupBy("doc_id", "sha").count().filter("count > 1").select("doc_id", "sha"), "repeated")
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"), F.col("doc_id").cast("long").alias("id"),
                        digest(plain_text()).alias("digest"))

    def with_keys(frame: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        return frame.join(keys, frame.id.eqNullSafe(keys.doc_id) & (frame.digest == keys.sha), how)

    stay = with_keys(keyed, wanted, "left_semi")
    if repeated.isEmpty():
        return stay.select("doc.*")
    once = with_keys(stay, repeated, "left_semi").groupBy("id", "digest").agg(F.first("doc").alias("doc"))
    return with_keys(stay, repeated, "left_anti").select("doc.*").unionByName(once.select("doc.*"))
