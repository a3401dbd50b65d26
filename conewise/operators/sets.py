"""Set operators with SQL's treatment of nulls."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_distinct(*frames: DataFrame) -> DataFrame:
    """``UNION``: each row once, nulls equal to nulls; partial aggregates, then one exchange."""
    return reduce(DataFrame.unionByName, frames).distinct()


def not_in(df: DataFrame, key: str, among: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``key`` is ``NOT IN`` the one column of ``among``.

    As in SQL nothing is left if ``among`` holds a null, and a null key is left
    only if ``among`` is empty.  The keys meet in a shuffled anti join; what is
    broadcast is one row that tells whether ``among`` has rows and nulls.
    """
    column = among.columns[0]
    keys = among.select(F.col(f"`{column}`").alias("_key"))
    known = keys.agg(F.count("*").alias("_rows"), F.count_if(F.col("_key").isNull()).alias("_nulls"))
    rest = df.join(keys.distinct(), F.col(f"`{key}`") == F.col("_key"), "left_anti")
    left = rest.crossJoin(F.broadcast(known)).filter(
        (F.col("_rows") == 0) | ((F.col("_nulls") == 0) & F.col(f"`{key}`").isNotNull()))
    return left.select(*[F.col(f"`{c}`") for c in df.columns])
