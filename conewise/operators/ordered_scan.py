"""Running sums, forward fills and previous rows over series of any size, without a one-task window.

The series is range-partitioned by its order and written once, so that the parts
are fixed.  Each part is summed up in one row: its sums, its last known values and
its last row.  A prefix over these rows, one for each part, gives what comes in
from all parts before; windows within a part finish the work.  Sums and last known
values are associative, so parts may have any size; a part has about ``PART_ROWS``
rows, whatever the input.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from conewise.sources.sinks import materialise, scratch_root

#: Rows that a part holds on average.
PART_ROWS = 250_000


def ordered_scan(df: DataFrame, order: Sequence[str], sums: Mapping[str, Column] | None = None,
                 fills: Mapping[str, Column] | None = None, lags: Mapping[str, Column] | None = None,
                 part_rows: int = PART_ROWS) -> DataFrame:
    """W06-W09, W16 without keys: ``df`` with new columns in the order of ``order``, which ends in a unique column.

    ``sums``: running sum up to the row (null before the first known value);
    ``fills``: last known value up to the row; ``lags``: value of the row before.
    Nulls in ``order`` come first; no rows give no rows.
    """
    sums, fills, lags = (dict(x or {}) for x in (sums, fills, lags))
    names = [*sums, *fills, *lags]
    values = df.select("*", *[c.alias(f"_v_{n}") for n, c in {**sums, **fills, **lags}.items()])
    parts = max(1, -(-df.count() // part_rows))
    ranged = values.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    fixed = materialise(ranged.withColumn("_at", F.monotonically_increasing_id()), "ordered", root=scratch_root(df.sparkSession))
    fixed = fixed.withColumn("_part", F.shiftright("_at", 33))

    summary = fixed.groupBy("_part").agg(
        F.count("*").alias("_n"),
        *[F.sum(f"_v_{n}").alias(n) for n in sums],
        *[F.max_by(F.struct(F.col(f"_v_{n}").alias("v")), F.when(F.col(f"_v_{n}").isNotNull(), F.col("_at"))).alias(n) for n in fills],
        *[F.max_by(F.struct(F.col(f"_v_{n}").alias("v")), "_at").alias(n) for n in lags])
    before = Window.partitionBy(F.lit(1)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a part
    carried = summary.select(
        "_part",
        *[F.sum(n).over(before).alias(f"_c_{n}") for n in sums],
        *[F.last(n, ignorenulls=True).over(before)["v"].alias(f"_c_{n}") for n in fills],
        *[F.last(n, ignorenulls=True).over(before)["v"].alias(f"_c_{n}") for n in lags])

    within = Window.partitionBy("_part").orderBy("_at")
    upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = F.row_number().over(within) == 1
    out = fixed.join(F.broadcast(carried), "_part")
    plus = lambda a, b: F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)
    out = out.withColumns({
        **{n: plus(F.sum(f"_v_{n}").over(upto), F.col(f"_c_{n}")) for n in sums},
        **{n: F.coalesce(F.last(f"_v_{n}", ignorenulls=True).over(upto), F.col(f"_c_{n}")) for n in fills},
        **{n: F.when(first, F.col(f"_c_{n}")).otherwise(F.lag(f"_v_{n}").over(within)) for n in lags}})
    return out.select(*[F.col(f"`{c}`") for c in df.columns], *names)
