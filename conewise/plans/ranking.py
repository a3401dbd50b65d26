"""Rankings: D20 products, D21 flavours (with seasonality), D22 flavour popularity, D24 zones."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conewise.functions import columns as C
from conewise.functions import rules as R
from conewise.operators.aggregates import count_when
from conewise.operators.dealing import deal
from conewise.operators.rank import global_row_number
from conewise.operators.windows import share_of_total
from conewise.plans.facts import fx_period_average

HUNDRED = Decimal("100.0")


def _delivered_active(pedidos: DataFrame) -> DataFrame:
    return pedidos.filter((F.col("is_activo") == 1) & (F.col("estado_id") == R.STATUS_DELIVERED))


# ---------------------------------------------------------------- D20

def product_ranking(lineas, pedidos, productos, categorias, costos, dolar) -> DataFrame:
    sold = lineas.select("producto_id", "pedido_id").join(
        _delivered_active(pedidos).select("pedido_id"), "pedido_id")
    counts = sold.groupBy("producto_id").agg(F.count(F.lit(1)).alias("_vv"),
                                              F.countDistinct("pedido_id").alias("_pd"))
    cg = costos.filter(F.col("tiene_match")).agg(F.round(F.avg("costo_por_kg"), 2).alias("avg_costo_kg"))
    dp = fx_period_average(dolar)
    cats = (categorias.select("categoria_id", F.col("nombre").alias("categoria")))
    p = (productos.filter(F.col("is_activo") == 1)
         .join(cats, "categoria_id", "left")
         .join(counts, "producto_id", "left")
         .crossJoin(F.broadcast(cg)).crossJoin(F.broadcast(dp)))
    vv = F.coalesce("_vv", F.lit(0))
    kg = F.coalesce("peso_kg", F.lit(0))
    ingreso = vv * F.col("precio_base")
    costo = vv * kg * F.col("avg_costo_kg")
    rate = F.nullif(F.col("avg_dolar"), F.lit(0))
    out = p.select(
        "producto_id", F.col("nombre").alias("producto"), "categoria", "precio_base", "peso_kg", "cantidad_gustos",
        vv.cast("bigint").alias("veces_vendido"), F.coalesce("_pd", F.lit(0)).cast("bigint").alias("pedidos_distintos"),
        F.round(vv * kg, 2).alias("kg_vendidos"),
        ingreso.alias("ingreso_estimado"),
        C.to_usd(ingreso, rate).alias("ingreso_estimado_usd"),
        F.round(costo, 2).alias("costo_estimado"),
        F.round(ingreso - costo, 2).alias("margen_estimado"),
        C.to_usd(ingreso - costo, rate).alias("margen_estimado_usd"),
        F.when(F.col("precio_base") > 0,
               F.round(C.ddiv((F.col("precio_base") - kg * F.col("avg_costo_kg")) * F.lit(HUNDRED),
                                F.col("precio_base")), 1)).alias("margen_pct"),
        F.col("_vv"),
    )
    out = global_row_number(out, [F.col("veces_vendido").desc(), F.col("producto_id").asc()], "ranking")
    return share_of_total(out, "veces_vendido", "porcentaje_del_total", 2).drop("_vv")


# ---------------------------------------------------------------- D21

def flavour_ranking(line_flavours, pedidos, costos, sabores, categorias, dolar,
                    multiplier: int = R.FLAVOUR_PRICE_MULTIPLIER) -> DataFrame:
    delivered = pedidos.filter(F.col("estado_id") == R.STATUS_DELIVERED).select("pedido_id", "created_at")
    weighed = line_flavours.filter(F.col("peso_kg") > 0).select("pedido_id", "sabor_id", "peso_kg", "sabores_en_producto")
    ls = deal(weighed, ["pedido_id"], line_flavours.count()).join(delivered, "pedido_id")
    est = C.season(F.month("created_at"))
    kg = F.try_divide(F.col("peso_kg"), F.nullif(F.col("sabores_en_producto"), F.lit(0)))
    seasons = {"n_verano": "Verano", "n_otono": "Otoño", "n_invierno": "Invierno", "n_primavera": "Primavera"}
    # rows of one order and flavour first, as they are dealt by order: an order is
    # then one row of its flavour, and no sum is dealt by both keys
    per_order = ls.groupBy("pedido_id", "sabor_id").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(kg).alias("_kg"),
        *[count_when(est == label).alias(n) for n, label in seasons.items()])
    m = per_order.groupBy("sabor_id").agg(
        F.sum("_n").alias("veces_pedido"), F.count(F.lit(1)).alias("pedidos_distintos"),
        F.round(F.sum("_kg").cast(per_order.schema["_kg"].dataType), 2).alias("kg_vendidos"),
        *[F.sum(n).alias(n) for n in seasons])
    cp = costos.filter(F.col("tiene_match")).groupBy("sabor_id").agg(
        F.round(F.avg("costo_por_kg"), 2).alias("_cp"))
    dp = fx_period_average(dolar)
    sc = (categorias.select("categoria_id", F.col("nombre").alias("categoria")))
    j = (m.join(sabores.select("sabor_id", F.col("nombre").alias("sabor"), "categoria_id", "is_sin_azucar"),
                "sabor_id")
         .join(sc, "categoria_id", "left").join(cp, "sabor_id", "left").crossJoin(F.broadcast(dp)))
    cpk = F.coalesce("_cp", F.lit(0))
    mul = F.lit(multiplier)
    kgv = F.col("kg_vendidos")
    rate = F.nullif(F.col("avg_dolar"), F.lit(0))
    usd = lambda x: C.to_usd(x, rate)
    vp = F.col("veces_pedido")
    out = j.select(
        "sabor_id", "sabor", "categoria", "is_sin_azucar", "veces_pedido", "pedidos_distintos", "kg_vendidos",
        F.round(kgv * cpk * mul, 2).alias("ingreso_estimado"), cpk.alias("costo_promedio_kg"),
        F.round(cpk * mul - cpk, 2).alias("margen_estimado_por_kg"),
        F.round(kgv * cpk, 2).alias("costo_total_estimado"),
        F.round(kgv * cpk * mul - kgv * cpk, 2).alias("margen_total_estimado"),
        usd(kgv * cpk * mul).alias("ingreso_estimado_usd"), usd(kgv * cpk).alias("costo_total_usd"),
        usd(kgv * cpk * mul - kgv * cpk).alias("margen_total_usd"), usd(cpk).alias("costo_promedio_kg_usd"),
        usd(cpk * mul - cpk).alias("margen_estimado_por_kg_usd"),
        C.argmax_label(["n_verano", "n_otono", "n_invierno", "n_primavera"],
                       ["Verano", "Otoño", "Invierno", "Primavera"]).alias("estacion_top"),
        *[F.round(C.ddiv(F.col(c) * F.lit(HUNDRED), vp), 1).alias(n) for c, n in
          [("n_verano", "pct_verano"), ("n_otono", "pct_otono"), ("n_invierno", "pct_invierno"),
           ("n_primavera", "pct_primavera")]],
    )
    out = global_row_number(out, [F.col("veces_pedido").desc(), F.col("sabor_id").asc()], "ranking")
    return share_of_total(out, "veces_pedido", "porcentaje_del_total", 2)


# ---------------------------------------------------------------- D22

def flavour_popularity(line_flavours, pedidos, sabores, categorias) -> DataFrame:
    sp = line_flavours.select("sabor_id", "pedido_id").join(_delivered_active(pedidos).select("pedido_id"), "pedido_id")
    ct = sp.groupBy("sabor_id").agg(F.count(F.lit(1)).alias("_vp"), F.countDistinct("pedido_id").alias("_pd"))
    sc = (categorias.select("categoria_id", F.col("nombre").alias("categoria")))
    j = (sabores.filter(F.col("is_activo") == 1).join(sc, "categoria_id", "left").join(ct, "sabor_id", "left"))
    out = j.select("sabor_id", F.col("nombre").alias("sabor"), "categoria", "is_sin_azucar",
                   F.coalesce("_vp", F.lit(0)).cast("bigint").alias("veces_pedido"),
                   F.coalesce("_pd", F.lit(0)).cast("bigint").alias("pedidos_distintos"), "_vp")
    out = global_row_number(out, [F.col("veces_pedido").desc(), F.col("sabor_id").asc()], "ranking")
    return share_of_total(out, "veces_pedido", "porcentaje_del_total", 2).drop("_vp")


# ---------------------------------------------------------------- D24

def zone_delivery(fact: DataFrame, direcciones: DataFrame, zonas: DataFrame) -> DataFrame:
    pd_ = (fact.filter((F.col("estado_id") == R.STATUS_DELIVERED) & (F.col("tipo_retiro") == "delivery"))
           .select("pedido_id", "cliente_id_mail_phone", "direccion_id", "total", "costo_envio", "demora_minutos",
                   "distancia_km", "total_usd", "kg_total")
           .join(direcciones.filter(F.col("zona_id").isNotNull()).select("direccion_id", "zona_id"), "direccion_id"))
    mz = pd_.groupBy("zona_id").agg(
        F.count(F.lit(1)).alias("total_pedidos"),
        F.countDistinct("cliente_id_mail_phone").alias("total_clientes"),
        F.round(F.sum("total"), 2).alias("venta_total"), F.round(F.avg("total"), 2).alias("ticket_promedio"),
        F.round(F.sum("costo_envio"), 2).alias("costo_envio_total"),
        F.round(F.sum("total") - F.sum("costo_envio"), 2).alias("ingreso_neto"),
        F.round(F.avg("demora_minutos"), 1).alias("demora_promedio_real"),
        F.round(F.avg("distancia_km"), 2).alias("distancia_promedio_real"),
        F.round(F.sum("total_usd"), 2).alias("venta_total_usd"),
        F.round(F.sum("kg_total"), 2).alias("kg_totales"))
    z = (zonas.select("zona_id", "distancia_max_km", "precio_envio", "demora_estimada_minutos"))
    out = mz.join(z, "zona_id")
    out = share_of_total(out, "total_pedidos", "pct_pedidos_total", 1)
    return out.select("zona_id", "distancia_max_km", "precio_envio", "demora_estimada_minutos", "total_pedidos",
                      "total_clientes", "venta_total", "ticket_promedio", "costo_envio_total", "ingreso_neto",
                      "demora_promedio_real", "distancia_promedio_real", "venta_total_usd", "kg_totales",
                      "pct_pedidos_total")
