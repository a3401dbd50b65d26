"""Parts of a bounded number of rows, so that what a task sorts or hashes does not grow with the input.

Adaptive execution joins the parts of a shuffle up to a size on disk; the rows of
such a part may take many times as much in memory, and the more the larger the
input.  Here the number of parts follows from the number of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Rows that a part holds on average.
PART_ROWS = 500_000


def deal(df: DataFrame, keys: list[str], rows: int, part_rows: int = PART_ROWS) -> DataFrame:
    """``df``, of about ``rows`` rows, dealt by ``keys``: grouping by them, or by more columns, and joining on them needs no further shuffle of it."""
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // part_rows))
    return df.repartition(parts, *keys)
