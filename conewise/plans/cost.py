"""D04 order cost: ingredients by flavour-month cost, packaging by pot tier x inflation index."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from conewise.functions import columns as C
from conewise.functions import rules as R
from conewise.operators.dealing import deal


def order_dates(pedidos: DataFrame) -> DataFrame:
    return pedidos.select("pedido_id", F.to_date("created_at").alias("fecha"),
                          C.year_month("created_at").alias("mes"))


def cost_index(costos: DataFrame) -> DataFrame:
    """Monthly average cost per kg and its factor against the latest month.

    One row per month (calendar-sized); the latest-month reference is a
    ``max_by`` scalar joined as a 1-row broadcast.
    """
    idx = costos.filter(F.col("tiene_match")).groupBy("mes").agg(
        F.avg("costo_por_kg").alias("avg_costo_kg"))
    ref = idx.agg(F.max_by("avg_costo_kg", "mes").alias("avg_ref"))  # A14
    return idx.crossJoin(F.broadcast(ref)).select(
        "mes", "avg_costo_kg", F.try_divide(F.col("avg_costo_kg"), F.col("avg_ref")).alias("factor"))


def line_flavours(lineas: DataFrame, sabores_linea: DataFrame, productos: DataFrame) -> DataFrame:
    """One row per line and flavour with the line's product weight and number of flavours.

    The only join of lines with flavours in the warehouse: cost, fact and
    flavour rankings all read this table.  Flavours are dealt by line once, which
    serves their count and the join; lines take their weight before, as they carry
    fewer columns than the joined rows.
    """
    known = sabores_linea.filter(F.col("pedido_producto_id").isNotNull()).select("pedido_producto_id", "sabor_id")
    counted = deal(known, ["pedido_producto_id"], sabores_linea.count()).withColumn(
        "sabores_en_producto", F.count(F.lit(1)).over(Window.partitionBy("pedido_producto_id")))
    weighed = (lineas.select("pedido_producto_id", "pedido_id", "producto_id")
               .join(productos.select("producto_id", "peso_kg"), "producto_id", "left").drop("producto_id"))
    return (counted.join(weighed, "pedido_producto_id")
            .select("pedido_id", "pedido_producto_id", "sabor_id", "peso_kg", "sabores_en_producto"))


def order_cost(pedidos: DataFrame, lineas: DataFrame, sabores: DataFrame,
               productos: DataFrame, costos: DataFrame,
               pot_tiers=R.POT_TIERS, pot_default=R.POT_DEFAULT, bag_cost=R.BAG_COST) -> DataFrame:
    """``sabores`` is ``line_flavours``."""
    pf = order_dates(pedidos)
    weighed = productos.filter(F.col("peso_kg") > 0).select("producto_id", "peso_kg",
                                                            F.col("nombre").alias("producto_nombre"))
    lines = lineas.select("pedido_id", "pedido_producto_id", "producto_id").join(weighed, "producto_id")
    index = cost_index(costos)

    ls = (sabores.filter(F.col("peso_kg") > 0)
          .join(pf, "pedido_id")
          .join(costos.select("sabor_id", "mes", "costo_por_kg"), ["sabor_id", "mes"], "left")
          # one row per month: bounded by the calendar
          .join(F.broadcast(index.select("mes", "avg_costo_kg")), "mes", "left"))
    exact = F.col("costo_por_kg").isNotNull()
    # Each flavour gets kg / n of the line; summing its costs per line first and
    # dividing once is the same amount, computed exactly (no per-flavour rounding)
    # and on one row per line instead of one per flavour.
    per_line_cost = ls.groupBy("pedido_id", "pedido_producto_id", "peso_kg", "sabores_en_producto").agg(
        F.sum(F.coalesce("costo_por_kg", "avg_costo_kg", F.lit(0))).alias("_sum_cost"),
        F.count(F.lit(1)).alias("_rows"),
        F.sum(C.flag(exact)).alias("_exact"),
    )
    line_cost = F.try_divide(F.col("peso_kg") * F.col("_sum_cost"),
                             F.nullif(F.col("sabores_en_producto"), F.lit(0)))
    ingredients = per_line_cost.groupBy("pedido_id").agg(
        F.round(F.sum(F.coalesce(line_cost, F.lit(0))), 2).alias("costo_ingredientes"),
        F.sum("_rows").alias("total_lineas_sabor"),
        F.sum("_exact").cast("bigint").alias("sabores_con_costo"),
        (F.sum("_rows") - F.sum("_exact")).cast("bigint").alias("sabores_con_promedio"),
    )

    pot = C.tier("peso_kg", pot_tiers, pot_default, exclude=("producto_nombre", R.POT_EXCLUDED))
    prods = (lines.join(pf, "pedido_id")
             .join(F.broadcast(index.select("mes", "factor")), "mes", "left"))
    packaging = prods.groupBy("pedido_id", "mes").agg(
        F.round(F.sum(pot * F.coalesce("factor", F.lit(1))), 2).alias("costo_potes"),
        F.round(F.lit(Decimal(bag_cost)) * F.coalesce(F.min("factor"), F.lit(1)), 2).alias("costo_bolsa"),
    ).drop("mes")

    zero = F.lit(0)
    return (pf.join(ingredients, "pedido_id", "left").join(packaging, "pedido_id", "left").select(
        "pedido_id", "fecha", "mes",
        F.coalesce("costo_ingredientes", zero).alias("costo_ingredientes"),
        F.coalesce("costo_potes", zero).alias("costo_potes"),
        F.coalesce("costo_bolsa", zero).alias("costo_bolsa"),
        (F.coalesce("costo_ingredientes", zero) + F.coalesce("costo_potes", zero)
         + F.coalesce("costo_bolsa", zero)).alias("costo_total"),
        F.coalesce("total_lineas_sabor", zero).cast("bigint").alias("total_lineas_sabor"),
        F.coalesce("sabores_con_costo", zero).cast("bigint").alias("sabores_con_costo"),
        F.coalesce("sabores_con_promedio", zero).cast("bigint").alias("sabores_con_promedio"),
    ))
