"""Distributed global rank: ``row_number``/``ntile`` over an ORDER BY with no PARTITION BY.

Spark evaluates a window without PARTITION BY in a single task, which does not
survive entity-sized inputs (customers, e-mails, phones, expenses).  Here the
frame is range-partitioned on the (unique) sort key, sorted inside each
partition and checkpointed so partition contents are fixed; each row's rank is
its position inside its partition (from ``monotonically_increasing_id``) plus
the number of rows in all earlier partitions.  The per-partition counts are one
row per partition, so the table broadcast back has a proven size bound (the
partition count), whatever the data size.  A hot sort value cannot pile up in
one task because callers end the sort key with a unique id, which the range
partitioner splits on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from conewise.session import checkpoint_dir

_LOCAL_MASK = (1 << 33) - 1


def _sorted_checkpoint(df: DataFrame, order: Sequence[Column], partitions: int | None) -> DataFrame:
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    # checkpoint, not localCheckpoint: the files live in the shared folder, so
    # losing an executor does not lose the fixed partitioning.
    fixed = ranged.checkpoint(eager=True)
    # fresh attribute ids, so the result can be joined back to its own source
    return fixed.select(*[F.col(c).alias(c) for c in fixed.columns])


def _with_positions(df: DataFrame, order: Sequence[Column], partitions: int | None) -> DataFrame:
    fixed = _sorted_checkpoint(df, order, partitions)
    tagged = fixed.withColumn("_pid", F.spark_partition_id()).withColumn(
        "_local", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOCAL_MASK))
    )
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        F.coalesce(
            F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("_offset"),
        F.sum("_n").over(Window.partitionBy(F.lit(1))).alias("_total"),
    )
    # one row per partition: bounded by the partition count, safe to broadcast
    return tagged.join(F.broadcast(offsets), "_pid")


def global_row_number(df: DataFrame, order: Sequence[Column], name: str = "rn",
                      partitions: int | None = None) -> DataFrame:
    """``row_number() over (order by <order>)`` as a distributed job.

    ``order`` must end with a unique column so the numbering is deterministic.
    """
    pos = _with_positions(df, order, partitions)
    return pos.withColumn(name, (F.col("_local") + F.col("_offset") + 1).cast("bigint")).drop(
        "_pid", "_local", "_offset", "_total"
    )


def ntile_from_rank(rank: Column, total: Column, n: int) -> Column:
    """SQL ``ntile(n)`` bucket of the 1-based ``rank`` among ``total`` rows."""
    q = F.floor(total / n).cast("bigint")
    r = (total % n).cast("bigint")
    big = r * (q + 1)
    first = F.floor((rank - 1) / (q + 1)) + 1
    rest = r + F.floor((rank - big - 1) / F.greatest(q, F.lit(1))) + 1
    return F.when(rank <= big, first).otherwise(rest).cast("bigint")


def global_ntile(df: DataFrame, order: Sequence[Column], n: int, name: str = "ntile",
                 partitions: int | None = None) -> DataFrame:
    """``ntile(n) over (order by <order>)`` as a distributed job."""
    pos = _with_positions(df, order, partitions)
    rank = F.col("_local") + F.col("_offset") + 1
    return pos.withColumn(name, ntile_from_rank(rank, F.col("_total"), n)).drop(
        "_pid", "_local", "_offset", "_total"
    )


def small_ntile(df: DataFrame, order: Sequence[Column], n: int, name: str = "ntile") -> DataFrame:
    """Plain window ntile for calendar-sized frames (e.g. one row per day)."""
    return df.withColumn(name, F.ntile(n).over(Window.orderBy(*order)).cast("bigint"))
