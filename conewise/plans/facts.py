"""Order and daily facts: D05 first order, D06 order fact, D07 order wide,
D08 daily sales base, D09 daily sales fact, D10 weather classes, D12 monthly FX."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conewise.functions import columns as C
from conewise.functions import rules as R
from conewise.operators.aggregates import count_when, sum_when
from conewise.operators.bitmaps import distinct_from_bitmaps, distinct_of_whole, id_bitmaps
from conewise.operators.hot_keys import hot_keys, join_hot
from conewise.operators.rank import small_ntile
from conewise.operators.windows import first_event


# ---------------------------------------------------------------- D05

def first_order(pedidos: DataFrame, mails: DataFrame) -> DataFrame:
    """First non-cancelled order per identity: flag on every order + first date."""
    p = pedidos.filter(F.col("estado_id") != R.STATUS_CANCELLED).select("pedido_id", "cliente_id", "created_at")
    ident = mails.select("cliente_id", "cliente_id_mail_phone").filter(F.col("cliente_id_mail_phone").isNotNull())
    pi = p.join(ident, "cliente_id")
    out = first_event(pi, "cliente_id_mail_phone", "created_at", "pedido_id",
                      flag="is_primer_pedido", first_ts="fecha_primer_pedido")
    return out.select("pedido_id", "cliente_id", "cliente_id_mail_phone", "is_primer_pedido",
                      "fecha_primer_pedido")


# ---------------------------------------------------------------- D10

def weather_classes(clima: DataFrame) -> DataFrame:
    """Quintile classes for temperature, rain and wind.

    One row per day (calendar-sized), so plain windows are fine; ties are
    broken by the date so classes are deterministic.
    """
    d = clima
    d = small_ntile(d, [F.col("temperatura_maxima").asc_nulls_last(), F.col("fecha")], 5, "quintil_temperatura")
    d = small_ntile(d, [F.col("precipitacion_mm").asc_nulls_last(), F.col("fecha")], 5, "quintil_precipitacion")
    d = small_ntile(d, [F.col("viento_max_kmh").asc_nulls_last(), F.col("fecha")], 5, "quintil_viento")

    def lab(c, labels):
        return C.decode(c, {i + 1: v for i, v in enumerate(labels)})

    return d.select(
        "fecha", "temperatura_maxima", "temperatura_minima", "temperatura_promedio",
        "quintil_temperatura", lab("quintil_temperatura", R.TEMPERATURE_LABELS).alias("categoria_temperatura"),
        "flg_precipitaciones", "precipitacion_mm", "lluvia_mm",
        "quintil_precipitacion", lab("quintil_precipitacion", R.RAIN_LABELS).alias("categoria_precipitacion"),
        "viento_max_kmh", "quintil_viento", lab("quintil_viento", R.WIND_LABELS).alias("categoria_viento"),
    )


# ---------------------------------------------------------------- D12

def fx_monthly(dolar: DataFrame) -> DataFrame:
    """Monthly average rate, 2 decimals (one row per month)."""
    return dolar.groupBy(C.month_start("fecha").alias("mes")).agg(
        F.round(F.avg("valor_blue"), 2).alias("tipo_cambio_promedio"))


def fx_period_average(dolar: DataFrame) -> DataFrame:
    """Average rate of the whole period, 1 row."""
    return dolar.agg(F.round(F.avg("valor_blue"), 2).alias("avg_dolar"))


# ---------------------------------------------------------------- D06

def _left_where_known(df: DataFrame, side: DataFrame, key: str) -> DataFrame:
    """Left join on ``key`` that keeps rows with a null key out of the shuffle."""
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in side.schema.fields if f.name != key]
    known = df.filter(F.col(key).isNotNull()).join(side, key, "left")
    return known.unionByName(df.filter(F.col(key).isNull()).select("*", *missing))


def order_fact(pedidos, clientes, direcciones, zonas, lineas, sabores, productos,
               costos, dolar, primer, mails) -> DataFrame:
    """One row per order with calendar, money, counts, kg, cost, margin and USD; ``sabores`` is ``cost.line_flavours``."""
    # per-order pre-aggregates (map-side combined before any join)
    lp = lineas.select("pedido_id", "pedido_producto_id", "producto_id")
    prod_kg = lp.join(productos.select("producto_id", "peso_kg"), "producto_id", "left").groupBy("pedido_id").agg(
        F.count(F.lit(1)).alias("cantidad_productos"), F.sum("peso_kg").alias("kg_total"))
    # dealt by order, which serves the distinct count and the join alike
    flav = sabores.filter(F.col("pedido_id").isNotNull()).select("pedido_id", "sabor_id").repartition("pedido_id").groupBy("pedido_id").agg(F.countDistinct("sabor_id").alias("cantidad_sabores"))

    cli = clientes.select("cliente_id", F.col("nombre").alias("cliente_nombre"),
                          F.col("email").alias("cliente_email"), F.col("telefono").alias("cliente_telefono"))
    dirs = direcciones.select("direccion_id", "barrio", "direccion", "zona_id")
    # zones: one row per delivery zone, a small fixed dimension
    zon = (zonas.select("zona_id", F.col("precio_envio").alias("costo_envio_zona")))
    # one row per calendar day
    fx = F.broadcast(dolar.select(F.col("fecha").alias("_fx_fecha"), "valor_blue"))
    first = primer.select("pedido_id", "is_primer_pedido")
    ident = mails.select("cliente_id", "cliente_id_mail_phone")

    p = pedidos
    ts = F.col("created_at")
    month = F.month(ts)
    zero = F.lit(0)
    cost_total = F.coalesce("costo_total", zero)
    contrib = F.col("total") - cost_total
    rate = F.nullif(F.col("valor_blue"), zero)

    # Dimensions are joined to each other at their own size first (customer
    # fields + identity per customer; address + zone per address), so the fact
    # is shuffled once per key: direccion_id, cliente_id, pedido_id (all per-order
    # aggregates share that partitioning and come last, so they are carried
    # through no other shuffle).  Catch-all customers hold a large share of the
    # orders: their few rows of the dimension are broadcast.
    cust = cli.join(ident, "cliente_id", "left")
    addr = dirs.join(zon, "zona_id", "left").drop("zona_id")
    # orders without an address are one key of any size: they skip that join,
    # which is the first one, as both ways read what lies before it
    j = (p.transform(_left_where_known, addr, "direccion_id")
          .transform(join_hot, cust, ["cliente_id"], hot_keys(p, ["cliente_id"]), "left")
          .join(prod_kg, "pedido_id", "left")
          .join(flav, "pedido_id", "left")
          .join(costos.select("pedido_id", "costo_ingredientes", "costo_potes", "costo_bolsa", "costo_total"),
                "pedido_id", "left")
          .join(first, "pedido_id", "left")
          .join(fx, F.to_date(ts) == F.col("_fx_fecha"), "left"))
    return j.select(
        "pedido_id", "cliente_id", "cliente_id_mail_phone", "direccion_id",
        "cliente_nombre", "cliente_email", "cliente_telefono",
        "barrio", "direccion", "costo_envio_zona",
        "created_at",
        F.to_date(ts).alias("fecha"),
        C.week_start(ts).alias("semana"),
        C.month_start(ts).alias("mes"),
        F.year(ts).cast("bigint").alias("anio"),
        month.cast("bigint").alias("mes_num"),
        C.day_of_week_sun0(ts).cast("bigint").alias("dia_semana"),
        F.hour(ts).cast("bigint").alias("hora"),
        C.season(month).alias("estacion"),
        C.commercial_season(month, R.COMMERCIAL_SEASON_ORDERS).alias("temporada"),
        C.daypart(F.hour(ts)).alias("horario"),
        "tipo_retiro", "tipo_pago",
        "subtotal", "descuento", "descuento_ajuste", "costo_envio", "redondeo", "total",
        "mercadopago_id", "mercadopago_status", "mp_monto_transaccion", "mp_monto_neto_recibido", "mp_comision",
        "estado_id",
        C.decode("estado_id", R.STATUS_NAMES, R.STATUS_DEFAULT).alias("estado_nombre"),
        "is_pagado", "is_activo", "repartidor", "demora_minutos", "distancia_km",
        F.coalesce("cantidad_productos", zero).cast("bigint").alias("cantidad_productos"),
        F.coalesce("cantidad_sabores", zero).cast("bigint").alias("cantidad_sabores"),
        F.coalesce("kg_total", zero).alias("kg_total"),
        F.coalesce("costo_ingredientes", zero).alias("costo_ingredientes"),
        F.coalesce("costo_potes", zero).alias("costo_potes"),
        F.coalesce("costo_bolsa", zero).alias("costo_bolsa"),
        cost_total.alias("costo_total"),
        contrib.alias("contribucion_mg"),
        C.pct(contrib, F.col("total"), 1, 0).alias("margen_pct"),
        F.coalesce("is_primer_pedido", F.lit(False)).alias("is_primer_pedido"),
        C.to_usd(F.col("total"), rate).alias("total_usd"),
        C.to_usd(cost_total, rate).alias("costo_total_usd"),
        C.to_usd(contrib, rate).alias("contribucion_mg_usd"),
        "comentario", "motivo_cancelacion",
    )


# ---------------------------------------------------------------- D07

def order_wide(fact: DataFrame, clima: DataFrame, perfil: DataFrame, mails: DataFrame,
               dim_clientes: DataFrame, direcciones: DataFrame, zonas: DataFrame) -> DataFrame:
    """Order fact + weather + segment + neighbourhood fallback with provenance + zone."""
    dedup = perfil.select("cliente_id", "cliente_id_mail_phone", "ultimo_barrio")  # one row per customer
    seg = (mails.filter(F.col("cliente_id_mail_phone").isNotNull()).select("cliente_id", "cliente_id_mail_phone")
           .join(dim_clientes.select("cliente_id_mail_phone", "segmento_cliente"), "cliente_id_mail_phone")
           .select("cliente_id", "segmento_cliente"))
    dz = direcciones.select("direccion_id", F.col("zona_id").alias("_zona_id"),
                            F.col("distancia_km").alias("direccion_distancia_km"))
    z = (zonas.select(F.col("zona_id").alias("_zona_id"),
                                 F.col("distancia_max_km").alias("zona_distancia_max_km"),
                                 F.col("demora_estimada_minutos").alias("zona_demora_estimada")))
    cl = F.broadcast(clima.select(F.col("fecha").alias("_cl_fecha"), *[c for c in clima.columns if c != "fecha"]))
    barrio, origen = C.coalesce_from([("pedido", F.col("barrio")), ("cliente", F.col("ultimo_barrio"))])
    # both customer sides have one row per customer: joined at their own size, so the fact meets them once
    cust = dedup.withColumnRenamed("cliente_id_mail_phone", "_ci_ident").join(seg, "cliente_id", "full")
    addr = dz.join(z, "_zona_id", "left")
    j = (fact.withColumnRenamed("cliente_id_mail_phone", "_f_ident")
         .transform(_left_where_known, addr, "direccion_id")
         .transform(join_hot, cust, ["cliente_id"], hot_keys(fact, ["cliente_id"]), "left")
         .join(cl, F.col("fecha") == F.col("_cl_fecha"), "left"))
    return j.select(
        "pedido_id", "cliente_id", F.col("_ci_ident").alias("cliente_id_mail_phone"), "direccion_id",
        "cliente_nombre", "cliente_email", "cliente_telefono", "segmento_cliente",
        barrio.alias("barrio"), origen.alias("barrio_origen"), "direccion",
        F.col("_zona_id").alias("zona_id"), "costo_envio_zona", "direccion_distancia_km",
        "zona_distancia_max_km", "zona_demora_estimada",
        "created_at", "fecha", "semana", "mes", "anio", "mes_num", "dia_semana", "hora",
        "tipo_retiro", "tipo_pago", "subtotal", "descuento", "descuento_ajuste", "costo_envio", "redondeo", "total",
        "mercadopago_id", "mercadopago_status", "mp_monto_transaccion", "mp_monto_neto_recibido", "mp_comision",
        "estado_id", "estado_nombre", "is_pagado", "is_activo", "repartidor", "demora_minutos", "distancia_km",
        "cantidad_productos", "cantidad_sabores", "kg_total",
        "temperatura_maxima", "temperatura_minima", "temperatura_promedio", "quintil_temperatura",
        "categoria_temperatura", "flg_precipitaciones", "precipitacion_mm", "lluvia_mm", "quintil_precipitacion",
        "categoria_precipitacion", "viento_max_kmh", "quintil_viento", "categoria_viento",
        "comentario", "motivo_cancelacion",
    )


# ---------------------------------------------------------------- D08

def daily_sales_base(fact: DataFrame, registro: DataFrame,
                     commission: float = R.PLATFORM_COMMISSION) -> DataFrame:
    """Per day: system sales + platform orders estimated from the register."""
    d = fact.filter(F.col("estado_id") == R.STATUS_DELIVERED)
    daily = d.groupBy(F.col("fecha").alias("_sd_fecha")).agg(
        F.count(F.lit(1)).alias("pedidos_sistema"), F.sum("total").alias("venta_sistema"),
        F.sum("costo_total").alias("costo_total_sistema"), F.sum("kg_total").alias("kg_sistema"),
        F.round(F.avg("total"), 2).alias("ticket_promedio_dia"),
        F.round(F.avg("costo_total"), 2).alias("costo_promedio_dia"),
        F.round(F.avg("kg_total"), 3).alias("kg_promedio_dia"))
    monthly = d.groupBy(C.year_month("fecha").alias("_pm_mes")).agg(
        F.round(F.avg("total"), 2).alias("ticket_promedio_mes"),
        F.round(F.avg("costo_total"), 2).alias("costo_promedio_mes"),
        F.round(F.avg("kg_total"), 3).alias("kg_promedio_mes"))
    reg = registro.select(F.col("fecha").alias("_r_fecha"), F.col("mes").alias("_r_mes"), "q_pedidos",
                          "costo_rapiboy", "costo_delivery_total")
    zero = F.lit(0)
    # calendar-sized sides: days and months
    cross = (daily.join(reg, F.col("_sd_fecha") == F.col("_r_fecha"), "full")
             .join(F.broadcast(monthly),
                   F.coalesce(F.col("_r_mes"), C.year_month("_sd_fecha")) == F.col("_pm_mes"), "left"))
    c = cross.select(
        F.coalesce("_sd_fecha", "_r_fecha").alias("fecha"),
        F.col("_r_mes").alias("mes"),
        F.coalesce("pedidos_sistema", zero).alias("pedidos_sistema"),
        F.coalesce("venta_sistema", zero).alias("venta_sistema"),
        F.coalesce("costo_total_sistema", zero).alias("costo_total_sistema"),
        F.coalesce("kg_sistema", zero).alias("kg_sistema"),
        F.coalesce(F.col("q_pedidos").cast("bigint"), F.col("pedidos_sistema"), zero).alias("q_pedidos_real"),
        F.greatest(F.coalesce("q_pedidos", zero) - F.coalesce("pedidos_sistema", zero), zero).cast("bigint")
        .alias("pedidos_plataforma"),
        F.coalesce("ticket_promedio_mes", "ticket_promedio_dia", zero).alias("tk"),
        F.coalesce("costo_promedio_mes", "costo_promedio_dia", zero).alias("ck"),
        F.coalesce("kg_promedio_mes", "kg_promedio_dia", zero).alias("kk"),
        F.coalesce("costo_rapiboy", zero).alias("costo_rapiboy"),
        F.coalesce("costo_delivery_total", zero).alias("costo_delivery_total"),
    )
    com = F.lit(Decimal(str(commission)))
    n = F.col("pedidos_plataforma")
    venta_pl = n * F.col("tk")
    costo_pl = n * F.col("ck")
    comision = n * F.col("tk") * com
    venta_total = F.col("venta_sistema") + venta_pl
    costo_total = F.col("costo_total_sistema") + costo_pl + comision + F.col("costo_delivery_total")
    return c.select(
        "fecha", "mes", F.col("pedidos_sistema").cast("bigint").alias("pedidos_sistema"),
        "venta_sistema", "costo_total_sistema", "kg_sistema", "q_pedidos_real", "pedidos_plataforma",
        F.round(venta_pl, 2).alias("venta_plataforma_estimada"),
        F.round(costo_pl, 2).alias("costo_plataforma_estimado"),
        F.round(comision, 2).alias("comision_plataforma"),
        F.round(n * F.col("kk"), 3).alias("kg_plataforma_estimado"),
        "costo_rapiboy", "costo_delivery_total",
        (F.col("pedidos_sistema") + n).cast("bigint").alias("pedidos_totales"),
        F.round(venta_total, 2).alias("venta_total"),
        F.round(costo_total, 2).alias("costo_total"),
        F.round(venta_total - costo_total, 2).alias("contribucion_mg"),
        F.round(F.col("kg_sistema") + n * F.col("kk"), 2).alias("kg_totales"),
    )


# ---------------------------------------------------------------- D09

def daily_sales_fact(base: DataFrame, clima: DataFrame, dolar: DataFrame, fact: DataFrame) -> DataFrame:
    d = fact.filter(F.col("estado_id") == R.STATUS_DELIVERED)
    det = d.groupBy(F.col("fecha").alias("_sd_fecha")).agg(
        F.round(F.avg("total"), 2).alias("ticket_promedio"),
        count_when(F.col("tipo_retiro") == "delivery").alias("pedidos_delivery"),
        count_when(F.col("tipo_retiro") == "local").alias("pedidos_local"),
        count_when(F.col("tipo_retiro") == "mostrador").alias("pedidos_mostrador"),
        count_when(F.col("tipo_pago") == "cash").alias("pagos_efectivo"),
        count_when(F.col("tipo_pago") == "mp").alias("pagos_mercadopago"),
        count_when(F.col("tipo_pago") == "transfer").alias("pagos_transferencia"),
        sum_when(F.col("tipo_pago") == "cash", "total").alias("venta_efectivo"),
        sum_when(F.col("tipo_pago") == "mp", "total").alias("venta_mercadopago"),
        sum_when(F.col("tipo_pago") == "transfer", "total").alias("venta_transferencia"),
        F.sum("mp_comision").alias("comision_mp_total"),
        F.sum("mp_monto_neto_recibido").alias("neto_mp_total"),
        F.sum("cantidad_productos").alias("productos_vendidos"),
        F.sum("cantidad_sabores").alias("sabores_vendidos"),
        count_when(F.col("is_primer_pedido")).alias("pedidos_primer_pedido"),
    )
    # distinct customers on their own: in one aggregate with the sums, every day
    # and customer would carry a buffer of each sum through the shuffle
    who = (d.select(F.col("fecha").alias("_cu_fecha"), "cliente_id").distinct()
           .groupBy("_cu_fecha").agg(F.count("cliente_id").alias("clientes_unicos")))
    # calendar-sized sides (one row per day)
    cl = F.broadcast(clima.select(F.col("fecha").alias("_cl_fecha"), "temperatura_maxima", "temperatura_minima",
                                  "temperatura_promedio", "categoria_temperatura", "flg_precipitaciones",
                                  "precipitacion_mm", "categoria_precipitacion", "viento_max_kmh",
                                  "categoria_viento"))
    fx = F.broadcast(dolar.select(F.col("fecha").alias("_fx_fecha"), "valor_blue"))
    j = (base.join(cl, F.col("fecha") == F.col("_cl_fecha"), "left")
             .join(fx, F.col("fecha") == F.col("_fx_fecha"), "left")
             .join(det, F.col("fecha") == F.col("_sd_fecha"), "left")
             .join(who, F.col("fecha") == F.col("_cu_fecha"), "left"))
    month = F.month("fecha")
    rate = F.nullif(F.col("valor_blue"), F.lit(0))
    zero = F.lit(0)
    z = lambda c: F.coalesce(F.col(c), zero).alias(c)
    return j.select(
        "fecha", C.week_start("fecha").alias("semana"), "mes",
        F.year("fecha").cast("bigint").alias("anio"), month.cast("bigint").alias("mes_num"),
        C.day_of_week_sun0("fecha").cast("bigint").alias("dia_semana"),
        C.season(month).alias("estacion"),
        C.commercial_season(month, R.COMMERCIAL_SEASON_ORDERS).alias("temporada"),
        "temperatura_maxima", "temperatura_minima", "temperatura_promedio", "categoria_temperatura",
        "flg_precipitaciones", "precipitacion_mm", "categoria_precipitacion", "viento_max_kmh", "categoria_viento",
        "pedidos_sistema", "pedidos_plataforma", "pedidos_totales", "q_pedidos_real",
        "venta_sistema", "venta_plataforma_estimada", "venta_total",
        "costo_total_sistema", "costo_plataforma_estimado", "comision_plataforma", "costo_rapiboy",
        "costo_delivery_total", "costo_total", "contribucion_mg",
        C.pct("contribucion_mg", "venta_total", 1, 0).alias("margen_pct"),
        "kg_sistema", "kg_plataforma_estimado", "kg_totales",
        F.col("valor_blue").alias("tipo_cambio_blue"),
        C.to_usd(F.col("venta_total"), rate).alias("venta_total_usd"),
        C.to_usd(F.col("costo_total"), rate).alias("costo_total_usd"),
        C.to_usd(F.col("contribucion_mg"), rate).alias("contribucion_mg_usd"),
        z("clientes_unicos"), z("ticket_promedio"), z("pedidos_delivery"), z("pedidos_local"),
        z("pedidos_mostrador"), z("pagos_efectivo"), z("pagos_mercadopago"), z("pagos_transferencia"),
        z("venta_efectivo"), z("venta_mercadopago"), z("venta_transferencia"), z("comision_mp_total"),
        z("neto_mp_total"), z("productos_vendidos"), z("sabores_vendidos"), z("pedidos_primer_pedido"),
    )


# ---------------------------------------------------------------- A03 with A18

def customers_by_day(fact: DataFrame) -> DataFrame:
    """Bitmaps of the customers with delivered orders of each day: distinct counts of any longer span come from them."""
    return id_bitmaps(fact.filter(F.col("estado_id") == R.STATUS_DELIVERED), [F.col("fecha")], "cliente_id")


def distinct_customers(by_day: DataFrame, level: str) -> DataFrame:
    """Distinct customers by ``day``, ``week`` or ``month`` of the daily bitmaps."""
    start = {"day": F.col("fecha"), "week": C.week_start("fecha"), "month": C.month_start("fecha")}[level]
    distinct = distinct_of_whole if level == "day" else distinct_from_bitmaps  # a day's bitmaps are whole as they are
    return distinct(by_day, [start.cast("date").alias("periodo")], "clientes_unicos")
