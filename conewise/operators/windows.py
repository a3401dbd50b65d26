"""Per-key window operators (W rows), written so a hot key does not sit in one task.

``row_number() = 1`` picks become ``max_by``/``min_by`` aggregates, which Spark
pre-aggregates map-side (partial aggregation), so a key holding a third of the
rows is reduced before the shuffle.  Counts "over (partition by k)" become an
aggregate joined back.  Only windows over calendar-sized frames (days,
months) use ``Window`` directly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from conewise.functions.columns import ddiv


def _cols(xs):
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def latest_per(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
               payload: Sequence[str], newest: bool = True) -> DataFrame:
    """The row with the greatest (or least) ``order`` tuple per key.

    ``order`` should end with a unique column (ties resolved by it).
    """
    pick = F.max_by if newest else F.min_by
    agg = pick(F.struct(*[F.col(p) for p in payload]), F.struct(*_cols(order))).alias("_pick")
    return df.groupBy(*keys).agg(agg).select(*keys, "_pick.*")


def newest_two(df: DataFrame, key: str, order: Sequence[str],
               payload: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The newest row per key and the one before it, from one scan.

    One aggregate finds the newest ``order`` tuple, a second, over rows below it,
    the one before; ``order`` must end with a unique column.
    """
    rank = F.struct(*[F.col(c) for c in order])
    row = F.struct(*[F.col(c) for c in payload])
    top = df.groupBy(key).agg(F.max(rank).alias("_top"), F.max_by(row, rank).alias("_row"))
    below = df.join(top.select(key, "_top"), key).filter(rank < F.col("_top"))
    previous = below.groupBy(key).agg(F.max_by(row, rank).alias("_row"))
    return top.select(key, "_row.*"), previous.select(key, "_row.*")


def first_event(df: DataFrame, key: str, ts: str, id_col: str,
                flag: str = "is_first", first_ts: str = "first_ts") -> DataFrame:
    """Flag the first event per key and attach the key's first timestamp.

    One partial aggregate (min by (ts, id)) and one join back; no self join over
    all events and no per-key sort.
    """
    firsts = df.groupBy(key).agg(
        F.min_by(F.struct(F.col(ts).alias(first_ts), F.col(id_col).alias("_first_id")),
                 F.struct(F.col(ts), F.col(id_col))).alias("_f")
    ).select(key, "_f.*")
    return (df.join(firsts, key, "inner")
              .withColumn(flag, F.col(id_col) == F.col("_first_id"))
              .drop("_first_id"))


def share_of_total(df: DataFrame, value: str, name: str, digits: int = 2,
                   scale: float = 100.0) -> DataFrame:
    """``scale * x / sum(x) over ()`` via a 1-row total, broadcast."""
    total = df.agg(F.sum(value).alias("_total"))
    from decimal import Decimal
    out = df.crossJoin(F.broadcast(total)).withColumn(
        name,
        F.round(ddiv(F.col(value) * F.lit(Decimal(str(scale))), F.nullif(F.col("_total"), F.lit(0))), digits),
    )
    return out.drop("_total")


def lag_change(df: DataFrame, order: str, value: str, prev: str, change: str | None = None,
               keys: Sequence[str] = (), digits: int = 1) -> DataFrame:
    """Previous value in order and change; for calendar-sized frames.

    ``change`` is the % change, null when the previous is not > 0.
    """
    w = Window.partitionBy(*keys).orderBy(order) if keys else Window.orderBy(order)
    from decimal import Decimal
    out = df.withColumn(prev, F.lag(value).over(w))
    if change:
        out = out.withColumn(
            change,
            F.when(F.col(prev) > 0,
                   F.round(ddiv((F.col(value) - F.col(prev)) * F.lit(Decimal("100.0")), F.col(prev)), digits)),
        )
    return out


def running_sum(df: DataFrame, order: str, value: str, name: str, keys: Sequence[str] = ()) -> DataFrame:
    """Cumulative sum, ROWS UNBOUNDED PRECEDING; for calendar-sized frames."""
    w = (Window.partitionBy(*keys) if keys else Window).orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.sum(value).over(w))


def forward_fill(df: DataFrame, order: str, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """``coalesce(v, last_value(v ignore nulls) over (order by ...))``."""
    w = (Window.partitionBy(*keys) if keys else Window).orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(value, F.coalesce(F.col(value), F.last(value, ignorenulls=True).over(w)))
