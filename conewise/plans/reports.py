"""Report-side jobs over the marts: reshape (R rows), report aggregates
(A17-A23), filters (P22-P25, P28) and sorts / top-k (T rows).

These are what the dashboard pages compute from the exported marts, written
as DataFrame jobs so they run next to the marts instead of in one process.
Every function takes a mart DataFrame and returns a DataFrame; none collects.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from conewise.functions import columns as C
from conewise.operators.windows import running_sum

# --------------------------------------------------------------------- filters


def facet_filter(df: DataFrame, facets: Mapping[str, Sequence | None]) -> DataFrame:
    """AND of multi-select IN filters.  ``None`` means "all non-null
    values" (the default selection), so null rows drop either way."""
    cond = F.lit(True)
    for c, values in facets.items():
        cond = cond & (F.col(c).isNotNull() if values is None else F.col(c).isin(list(values)))
    return df.filter(cond)


def text_search(df: DataFrame, column: str, pattern: str | None) -> DataFrame:
    """Case-insensitive regex search; null never matches; no pattern keeps all."""
    if not pattern:
        return df
    return df.filter(F.coalesce(F.col(column).rlike(f"(?i){pattern}"), F.lit(False)))


def between_dates(df: DataFrame, column: str, start: str | None, end: str | None) -> DataFrame:
    """Inclusive date range on the date part of ``column``."""
    d = F.to_date(F.col(column))
    if start:
        df = df.filter(d >= F.lit(start).cast("date"))
    if end:
        df = df.filter(d <= F.lit(end).cast("date"))
    return df


def tristate(df: DataFrame, column: str, mode: str = "all") -> DataFrame:
    """P25: ``all`` / ``only`` (flag = 1) / ``without`` (flag = 0)."""
    if mode == "all":
        return df
    if mode == "only":
        return df.filter(F.col(column) == 1)
    if mode == "without":
        return df.filter(F.col(column) == 0)
    raise ValueError(mode)


def dimension_filter(df: DataFrame, tipo: str = "overall") -> DataFrame:
    """One ``dimension_tipo`` of a long breakdown table."""
    return df.filter(F.col("dimension_tipo") == F.lit(tipo))


# ----------------------------------------------------------------- sort / top-k


def top_n(df: DataFrame, metric: str, n: int, tie: Sequence[str] = ()) -> DataFrame:
    """The ``n`` largest rows by ``metric`` (a top-k report: the limit is
    the feature).  ``tie`` makes the cut deterministic.  Spark plans this as
    TakeOrderedAndProject: each task keeps its own top n, the driver merges
    n x tasks rows."""
    return df.orderBy(F.col(metric).desc_nulls_last(), *[F.col(t).asc() for t in tie]).limit(n)


def order_by_labels(df: DataFrame, column: str, labels: Sequence[str], *then: Column) -> DataFrame:
    """Sort by a declared label order (unknown labels last)."""
    return df.orderBy(C.order_rank(column, labels), *then)


def latest_period_row(df: DataFrame, period: str) -> DataFrame:
    """The row of the last period, as a ``max_by`` over a struct of all
    columns (one partial aggregate per task, no sort of the frame)."""
    cols = df.columns
    return (df.agg(F.max_by(F.struct(*cols), F.col(period)).alias("_r"))
              .select(*[F.col(f"_r.{c}").alias(c) for c in cols]))


def head_sample(df: DataFrame, key: str, n: int = 3) -> DataFrame:
    """First ``n`` rows by ``key`` for a preview (the limit is the feature)."""
    return df.orderBy(key).limit(n)


def project_existing(df: DataFrame, cols: Sequence[str], sort: Sequence[Column | str] = ()) -> DataFrame:
    """The chosen columns that exist, in the chosen order, sorted."""
    have = [c for c in cols if c in df.columns]
    out = df.select(*have)
    return out.orderBy(*sort) if sort else out


# ------------------------------------------------------------------- reshape


def melt(df: DataFrame, ids: Sequence[str], cols: Sequence[str], var: str, val: str,
         value_type: str | None = None) -> DataFrame:
    """Wide metric columns -> (name, value) rows (``unpivot``, a map-side Expand)."""
    if value_type:
        df = df.select(*ids, *[F.col(c).cast(value_type).alias(c) for c in cols])
    return df.unpivot(list(ids), list(cols), var, val)


def statement_rows(df: DataFrame, rows: Sequence[tuple[str, str]], period: str,
                   value_type: str = "decimal(38,4)") -> DataFrame:
    """Statement in long form, (period, orden, concepto, valor), concepts in the declared order."""
    items = [F.struct(F.lit(i + 1).alias("orden"), F.lit(label).alias("concepto"), F.col(c).cast(value_type).alias("valor"))
             for i, (label, c) in enumerate(rows)]
    return df.select(period, F.explode(F.array(*items)).alias("_r")).select(period, "_r.*")


def statement(long: DataFrame, period: str, fmt: str = "%m-%y") -> DataFrame:
    """Statement matrix from its long form: one row per concept, one column
    per period, in date order and labelled ``fmt``.

    The periods (one per month: bounded by the calendar) become the pivot's
    explicit list, so columns come by date and not by label.
    """
    periods = [r[0] for r in long.select(period).distinct().orderBy(period).collect()]
    wide = long.groupBy("orden", "concepto").pivot(period, periods).agg(F.first("valor"))
    return wide.toDF("orden", "concepto", *[p.strftime(fmt) for p in periods]).orderBy("orden")


def waterfall(df: DataFrame, period: str, steps: Sequence[tuple[str, str, int]],
              total: tuple[str, str]) -> DataFrame:
    """Signed steps of the last period and a closing total row.

    ``steps`` are (label, column, sign); the output is (orden, paso, valor,
    medida) with medida 'relative' for steps and 'total' for the last row.
    """
    last = latest_period_row(df, period)
    items = [F.struct(F.lit(i + 1).alias("orden"), F.lit(label).alias("paso"),
                      (F.col(c) * F.lit(sign)).cast("decimal(38,2)").alias("valor"),
                      F.lit("relative").alias("medida"))
             for i, (label, c, sign) in enumerate(steps)]
    items.append(F.struct(F.lit(len(steps) + 1).alias("orden"), F.lit(total[0]).alias("paso"),
                          F.col(total[1]).cast("decimal(38,2)").alias("valor"), F.lit("total").alias("medida")))
    return last.select(F.col(period), F.explode(F.array(*items)).alias("_s")).select(period, "_s.*")


def composition(df: DataFrame, parts: Sequence[tuple[str, str]], side: str,
                positive_only: bool = False) -> DataFrame:
    """Period sums by source as (lado, fuente, monto); optionally keep > 0."""
    sums = df.agg(*[F.sum(c).alias(f"_{i}") for i, (_, c) in enumerate(parts)])
    out = sums.select(F.explode(F.array(*[
        F.struct(F.lit(side).alias("lado"), F.lit(label).alias("fuente"),
                 F.coalesce(F.col(f"_{i}"), F.lit(0)).cast("decimal(38,2)").alias("monto"))
        for i, (label, _) in enumerate(parts)])).alias("_c")).select("_c.*")
    return out.filter(F.col("monto") > 0) if positive_only else out


def period_running(df: DataFrame, period: str, start: str | None, end: str | None,
                   values: Mapping[str, str]) -> DataFrame:
    """Cumulative sums that start anew at the selected period; one row per month.

    ``values`` maps a column to the name of its cumulative sum."""
    out = between_dates(df, period, start, end)
    for value, name in values.items():
        out = running_sum(out, period, value, name)
    return out.select(period, *values, *values.values())


def points(df: DataFrame, x: str, y: str, *more: str) -> DataFrame:
    """Points of two metrics, with their labels."""
    return df.select(F.col(x).alias("x"), F.col(y).alias("y"), *more)


def signed_flow(df: DataFrame, period: str, inflow: str, outflow: str) -> DataFrame:
    """Inflow positive, outflow negative per period."""
    return df.select(period, F.col(inflow).alias("inflow"), (-F.col(outflow)).alias("outflow"))


def filter_to_top(df: DataFrame, key: str, value: str, n: int) -> DataFrame:
    """Rows whose ``key`` is among the top ``n`` by total ``value``.

    The totals are one row per key (aggregated before the shuffle), the top-n
    list has n rows and is broadcast for the semi join.
    """
    totals = df.groupBy(key).agg(F.sum(value).alias("_t"))
    top = top_n(totals, "_t", n, tie=[key]).select(key)
    return df.join(F.broadcast(top), key, "left_semi")


def rollup_time(df: DataFrame, date: str, grain: str, sums: Sequence[str]) -> DataFrame:
    """The same sums by day, Monday week or month (``grain`` = day/week/month)."""
    bucket = F.to_date(F.date_trunc(grain, F.col(date))).alias("periodo")
    return df.groupBy(bucket).agg(*[F.sum(c).alias(c) for c in sums])


def category_mean(df: DataFrame, key: str, mean_col: str, sums: Sequence[str], digits: int = 4) -> DataFrame:
    """Unweighted mean of a ratio per category, plus sums."""
    return df.groupBy(key).agg(F.round(F.avg(mean_col), digits).alias(f"{mean_col}_prom"),
                               *[F.sum(c).alias(c) for c in sums])


def total_by_category(df: DataFrame, key: str, value: str, name: str = "total") -> DataFrame:
    """Sum by category (treemap / pie data)."""
    return df.groupBy(key).agg(F.sum(value).alias(name))


def class_impact(df: DataFrame, class_col: str, count_col: str, means: Sequence[str],
                 digits: int = 1) -> DataFrame:
    """Days per class and the mean of each metric, ``digits`` decimals."""
    return df.groupBy(class_col).agg(
        F.count(count_col).alias("dias"),
        *[F.round(F.avg(c), digits).alias(f"{c}_prom") for c in means])


# ------------------------------------------------------------ page-level jobs


def payment_mix(daily: DataFrame) -> DataFrame:
    """Orders by means of payment per month, long form (A18 + R01)."""
    monthly = daily.groupBy(F.date_format("fecha", "yyyy-MM").alias("mes_str")).agg(
        F.sum("pagos_efectivo").alias("Efectivo"),
        F.sum("pagos_mercadopago").alias("MercadoPago"),
        F.sum("pagos_transferencia").alias("Transferencia"))
    return melt(monthly, ["mes_str"], ["Efectivo", "MercadoPago", "Transferencia"], "medio_pago", "pedidos")


def weather_days(daily: DataFrame) -> DataFrame:
    """R09 input: days with weather only, with kg per order (null when no orders)."""
    return (daily.filter(F.col("temperatura_promedio").isNotNull())
                 .withColumn("kg_por_pedido", C.ddiv("kg_totales", F.nullif(F.col("pedidos_totales"), F.lit(0)))))


def season_matrix(flavours: DataFrame, n: int = 15) -> DataFrame:
    """Top-``n`` flavours by times ordered x the four season shares."""
    return top_n(flavours, "veces_pedido", n, tie=["sabor_id"]).select(
        "sabor_id", "sabor", "veces_pedido", "pct_verano", "pct_otono", "pct_invierno", "pct_primavera")
