"""Data quality and profiling (Q rows): key checks, frame profile, cost coverage.

The checks return the offending keys / rows as DataFrames (empty = pass), so
they run distributed and can be written out or counted; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conewise.operators.digests import TASK, TOTALS, carried, digest_task, digest_totals
from conewise.session import ship

# The staging tables whose key the source project tests for
# unique and not null, and that key.
KEYED_TABLES = {
    "stg_pedidos": "pedido_id",
    "stg_pedidos_productos": "pedido_producto_id",
    "stg_pedidos_productos_sabores": "pedido_producto_sabor_id",
    "stg_clientes": "cliente_id",
    "stg_clientes_direcciones": "direccion_id",
    "stg_productos": "producto_id",
    "stg_productos_categorias": "categoria_id",
    "stg_sabores": "sabor_id",
    "stg_sabores_categorias": "categoria_id",
    "stg_delivery": "delivery_id",
    "stg_zonas": "zona_id",
}


def check_unique(df: DataFrame, key: str) -> DataFrame:
    """Q01: keys that occur more than once, with their count (partial
    aggregation per task before the shuffle, so a hot key is pre-counted)."""
    return (df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
              .filter(F.col("n") > 1))


def check_not_null(df: DataFrame, key: str) -> DataFrame:
    """Q02: rows whose key is null."""
    return df.filter(F.col(key).isNull())


def key_report(tables: Mapping[str, DataFrame], keys: Mapping[str, str] = KEYED_TABLES) -> DataFrame:
    """Q01 + Q02 for every keyed table in one long frame: (tabla, clave, filas,
    claves_duplicadas, claves_nulas).  Each table is one aggregate pass."""
    parts = []
    for name, key in keys.items():
        df = tables[name]
        per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        parts.append(per_key.agg(
            F.sum("_n").cast("bigint").alias("filas"),
            F.count_if(F.col(key).isNotNull() & (F.col("_n") > 1)).cast("bigint").alias("claves_duplicadas"),
            F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("_n"))), F.lit(0)).cast("bigint")
             .alias("claves_nulas"),
        ).select(F.lit(name).alias("tabla"), F.lit(key).alias("clave"), "*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NUMERIC = (*_WHOLE, T.FloatType, T.DoubleType, T.DecimalType)
_DATES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def column_kind(t: T.DataType) -> str:
    """Kind of a column, the same word for every engine."""
    if isinstance(t, _WHOLE):
        return "entero"
    if isinstance(t, _NUMERIC):
        return "numero"
    if isinstance(t, _DATES):
        return "fecha"
    return "logico" if isinstance(t, T.BooleanType) else "texto"


#: Size of the sketches (2^n registers) that tell columns with few values, and the most values counted in a set.
SKETCH, FEW = 10, 1000


def profile(df: DataFrame, sample_limit: int = 10, few: int = FEW) -> DataFrame:
    """Q03: one row per column - kind, rows, nulls, exact distinct count, range
    of numbers and dates, and the sorted values of text columns with at most
    ``sample_limit`` distinct values.

    A first pass takes counts, nulls, ranges and a sketch of each column.  Columns
    whose sketch tells at most ``few`` values are counted together, in sets that
    stay in the aggregate buffer; the others one by one, each from a scan of that
    column alone.  Sketches only choose the way: all counts are exact.  ``df``
    should be a table, as it is read once per column with many values.
    """
    few = max(few, sample_limit)
    fields = [(i + 1, f.name, column_kind(f.dataType)) for i, f in enumerate(df.schema.fields)]
    aggs = [F.count(F.lit(1)).alias("filas")]
    for i, name, kind in fields:
        c = F.col(f"`{name}`")
        aggs.append(F.count_if(c.isNull()).alias(f"nulos_{i}"))
        sketch = F.hll_sketch_agg(F.when(c.isNotNull(), F.xxhash64(c)), SKETCH)
        aggs.append(F.hll_sketch_estimate(sketch).alias(f"cerca_{i}"))
        for low, pick in (("min", F.min), ("max", F.max)):
            if kind in ("entero", "numero"):
                aggs.append(pick(c).cast("double").alias(f"{low}_n_{i}"))
            elif kind == "fecha":
                aggs.append(pick(c.cast("timestamp_ntz")).alias(f"{low}_d_{i}"))
    one = df.agg(*aggs).first().asDict()  # one row, a few values per column
    stats = df.sparkSession.createDataFrame(
        [(i, name, kind, one["filas"], len(fields), one[f"nulos_{i}"], *[one.get(f"{k}_{i}") for k in ("min_n", "max_n", "min_d", "max_d")])
         for i, name, kind in fields],
        "posicion int, columna string, tipo string, filas long, columnas int, nulos long, minimo double, maximo double, "
        "desde timestamp_ntz, hasta timestamp_ntz")

    small = [x for x in fields if (one[f"cerca_{x[0]}"] or 0) <= few]
    counts = []
    if small:
        sets = df.agg(*[F.collect_set(f"`{name}`").alias(f"s_{i}") for i, name, _ in small])
        rows = []
        for i, _, kind in small:
            s = F.col(f"s_{i}")
            listed = F.array_join(F.array_sort(s), ", ") if kind == "texto" else F.lit(None).cast("string")
            rows.append(F.struct(F.lit(i).alias("posicion"), F.size(s).cast("long").alias("distintos"),
                                 F.when(F.size(s).between(1, sample_limit), listed).alias("valores")))
        counts.append(sets.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*"))
    for i, name, _ in [x for x in fields if x not in small]:
        values = df.select(F.col(f"`{name}`").alias("v")).filter("v is not null").distinct()
        counts.append(values.agg(F.count("*").alias("distintos")).select(
            F.lit(i).alias("posicion"), "distintos", F.lit(None).cast("string").alias("valores")))
    found = counts[0]
    for c in counts[1:]:
        found = found.unionByName(c)
    # one row per column on both sides
    return stats.join(F.broadcast(found), "posicion").select(
        "posicion", "columna", "tipo", "filas", "columnas", "nulos", "distintos", "minimo", "maximo", "desde", "hasta", "valores")


def column_digests(frames: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table and column: (tabla, columna, filas, valores, suma).

    ``suma`` adds up the first 32 bits of each value's MD5 (numbers as decimals of
    six places), so it does not depend on the order of rows: two tables with the
    same digests hold the same values in each column.  One pass per table, in
    which each task hashes its columns as arrays (``operators.digests``).
    """
    parts = []
    for table, df in frames.items():
        ship(df.sparkSession)
        fields = df.schema.fields
        sent = [(i, *x) for i, f in enumerate(fields) for x in carried(F.col(f"`{f.name}`"), f.dataType)]
        tasks = (df.select(*[c.alias(f"c_{k}") for k, (_, c, _) in enumerate(sent)])
                 .mapInArrow(digest_task([kind for _, _, kind in sent]), TASK))
        # one row per task
        parts.append(tasks.repartition(1).mapInArrow(digest_totals([f.name for f in fields], [i for i, _, _ in sent]), TOTALS)
                     .select(F.lit(table).alias("tabla"), "*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def cost_coverage(order_cost: DataFrame) -> DataFrame:
    """Q04: exact versus fallback flavour costs per month (from D04)."""
    return order_cost.groupBy("mes").agg(
        F.count(F.lit(1)).alias("pedidos"),
        F.sum("total_lineas_sabor").cast("bigint").alias("lineas_sabor"),
        F.sum("sabores_con_costo").cast("bigint").alias("sabores_con_costo"),
        F.sum("sabores_con_promedio").cast("bigint").alias("sabores_con_promedio"),
        F.count_if(F.col("sabores_con_promedio") > 0).cast("bigint").alias("pedidos_con_promedio"),
    )
