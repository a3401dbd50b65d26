"""Joins on keys of which a few hold a large share of the rows.

A key is hot if it holds more than ``share`` of the rows, so there are fewer than
``1 / share`` hot keys, whatever the input: their rows of the other side may be
broadcast.  All other rows shuffle on their key, of which none is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with more than this share of the rows is hot.
SHARE = 0.001
_SALTS = 4096


def hot_keys(rows: DataFrame, on: list[str], share: float = SHARE) -> DataFrame:
    """The hot keys of ``rows``: fewer than ``1 / share`` rows, counted by partial aggregates.  Null keys match nothing and are none."""
    counts = rows.dropna(subset=on).groupBy(*on).agg(F.count("*").alias("_n"))
    total = rows.agg(F.count("*").alias("_all"))  # one row
    return counts.join(F.broadcast(total), F.col("_n") > share * F.col("_all")).select(*on)


def join_hot(left: DataFrame, right: DataFrame, on: list[str], hot: DataFrame, how: str = "inner") -> DataFrame:
    """``left`` joined with ``right`` (few rows per key) on equal ``on``; ``how`` is ``inner`` or ``left``.

    ``hot`` are the hot keys of ``left``.  Their rows meet a broadcast of the
    right rows of these keys.  Rows with a hot or null key pass the shuffled join
    under keys of their own that match nothing, so they are spread evenly; null
    keys, ties and repeated rows of ``left`` behave as in a plain join.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how}")
    values = [c for c in right.columns if c not in on]
    packed = right.dropna(subset=on).select(*on, F.struct(F.lit(True).alias("in"), *[F.col(f"`{c}`") for c in values]).alias("_cold"))
    small = F.broadcast(hot).join(packed, on, "left").select(*on, F.struct(F.col("_cold").alias("of")).alias("_hot"))
    known = F.lit(True)
    for c in on:
        known = known & F.col(f"`{c}`").isNotNull()
    salt = F.when(F.col("_hot").isNotNull() | ~known, 1 + F.pmod(F.monotonically_increasing_id(), F.lit(_SALTS))).otherwise(0)
    # one struct as the key: a plain salt column would be folded into a filter, and hot rows would meet in one task
    salted = left.join(F.broadcast(small), on, "left").withColumn("_key", F.struct(*on, salt.alias("_salt"))).drop(*on)
    cold = packed.select(F.struct(*on, F.lit(0).cast("long").alias("_salt")).alias("_key"), "_cold")
    joined = salted.join(cold, "_key", "left").withColumn("_of", F.when(F.col("_hot").isNotNull(), F.col("_hot.of")).otherwise(F.col("_cold")))
    if how == "inner":
        joined = joined.filter(F.col("_of").isNotNull())
    return joined.select(*[F.col("_key")[c].alias(c) if c in on else F.col(f"`{c}`") for c in left.columns],
                         *[F.col("_of")[c].alias(c) for c in values])
