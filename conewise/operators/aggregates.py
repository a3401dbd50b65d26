"""Aggregate operators (A rows) that need more than one ``groupBy().agg``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def mode_per_key(df: DataFrame, key: str, value: str, name: str | None = None) -> DataFrame:
    """Most frequent value per key; ties go to the smallest value.

    Count per (key, value) pre-aggregates map-side; the pick is a ``min_by`` on
    (-count, value), also partially aggregated, so a key with many rows never
    lands whole in one task.
    """
    name = name or value
    counts = df.groupBy(key, value).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(key).agg(
        F.min_by(F.col(value), F.struct((-F.col("_n")).alias("a"), F.col(value).alias("b"))).alias(name)
    )


def count_when(cond: Column) -> Column:
    """``count(case when cond then 1 end)``."""
    return F.count(F.when(cond, F.lit(1)))


def sum_when(cond: Column, value: Column | str, zero=0) -> Column:
    """``sum(case when cond then value else 0 end)``."""
    v = F.col(value) if isinstance(value, str) else value
    return F.sum(F.when(cond, v).otherwise(F.lit(zero)))


def id_chunks(df: DataFrame, key: str, id_col: str, size: int = 100_000) -> DataFrame:
    """A07 as a table: the ordered ids of each key in chunks (key, chunk, position, first_id, n_ids, ids).

    A chunk holds the ids of one range of ``size`` ids, so chunks are in id order
    and a key of any size is spread over many rows and tasks (unique ids: at most
    ``size`` a chunk).  ``position`` is the place of the first id in the key's
    whole list, from 0: a prefix sum over narrow rows (key, chunk, count), of which
    a key has one per range.  Null ids are left out.
    """
    known = df.filter(F.col(id_col).isNotNull()).select(
        key, F.floor(F.col(id_col) / F.lit(size)).alias("chunk"), F.col(id_col).alias("_id"))
    before = Window.partitionBy(key).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    places = (known.groupBy(key, "chunk").agg(F.count(F.lit(1)).alias("n_ids"))
              .withColumn("position", F.coalesce(F.sum("n_ids").over(before), F.lit(0))))
    lists = known.groupBy(key, "chunk").agg(F.sort_array(F.collect_list("_id")).alias("ids"))
    return (lists.withColumnRenamed(key, "_key").withColumnRenamed("chunk", "_chunk")
            .join(places, F.col("_key").eqNullSafe(F.col(key)) & (F.col("_chunk") == F.col("chunk")))
            .select(key, "chunk", "position", F.col("ids")[0].alias("first_id"), "n_ids", "ids"))


def ids_text(chunks: DataFrame, key: str, name: str, sep: str = ", ") -> DataFrame:
    """A07 as text: the ids of each key's chunks in order, ``'1, 2, 3'``.

    Each chunk becomes one string where it lies; only these are put together for a
    key.  (That string grows with the key; jobs that need the ids read the chunks.)
    """
    parts = chunks.filter(F.size("ids") > 0).select(key, "chunk", F.array_join(F.col("ids").cast("array<string>"), sep).alias("_part"))
    return parts.groupBy(key).agg(F.expr(f"listagg(_part, '{sep}') within group (order by chunk)").alias(name))


def join_ids(df: DataFrame, key: str, id_col: str, name: str, sep: str = ", ", bucket: int = 100_000) -> DataFrame:
    """Ordered id list ``'1, 2, 3'`` per key, by way of its chunks."""
    return ids_text(id_chunks(df, key, id_col, bucket), key, name, sep)


def value_counts(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """Frequency table of one column, nulls dropped, most frequent first."""
    return (df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(name))
              .orderBy(F.col(name).desc(), F.col(column).asc()))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Sorted non-null distinct values (choices of a filter)."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def kpis(df: DataFrame, measures: Mapping[str, Column]) -> DataFrame:
    """One-row KPI set over the (filtered) frame."""
    return df.agg(*[c.alias(k) for k, c in measures.items()])


def grouping_sets(df: DataFrame, base: Sequence[str], dims: Sequence[str],
                  aggs: Mapping[str, str], overall_value: str = "total") -> DataFrame:
    """One Expand + one shuffle for (base), (base, d) for each d in dims.

    ``aggs`` maps output name -> SQL aggregate expression over the input
    columns.  ``dimension_tipo`` is 'overall' or the dim name,
    ``dimension_valor`` the dim value as text ('total' for overall); a null
    dim value stays null and is told from a subtotal by ``grouping_id``.
    """
    spark = df.sparkSession
    n = len(dims)
    dl = ", ".join([*base, *dims])  # grouping_id over all grouping columns; base bits are always 0
    tipo, valor = [], []
    for i, d in enumerate(dims):
        mask = sum(1 << (n - 1 - j) for j in range(n) if j != i)
        tipo.append(f"when grouping_id({dl}) = {mask} then '{d}'")
        valor.append(f"when grouping_id({dl}) = {mask} then cast({d} as string)")
    gsets = ", ".join(["(" + ", ".join(base) + ")"] + ["(" + ", ".join([*base, d]) + ")" for d in dims])
    agg_sql = ", ".join(f"{expr} as {name}" for name, expr in aggs.items())
    sql = (
        f"select {', '.join(base)}, case {' '.join(tipo)} else 'overall' end as dimension_tipo, "
        f"case {' '.join(valor)} else '{overall_value}' end as dimension_valor, {agg_sql} "
        f"from {{src}} group by grouping sets ({gsets})"
    )
    return spark.sql(sql, src=df)
