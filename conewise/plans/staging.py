"""Staging models: typed, renamed views over raw tables and seeds (P01 and seeds)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conewise.functions import columns as C
from conewise.functions import rules as R
from conewise.operators.rank import global_row_number
from conewise.operators.windows import forward_fill


def _audit():
    """Common audit columns of every raw table."""
    return [
        ("activo", "is_activo"),
        (C.epoch_to_ts("fecha_sys"), "created_at"),
        (C.epoch_to_ts("last_fecha_update"), "updated_at"),
        ("admin_insert", "created_by_admin_id"),
        ("last_admin_update", "updated_by_admin_id"),
    ]


def stage(df: DataFrame, renames, key: str, audit: bool = True) -> DataFrame:
    """Drop rows with a null key, select and rename.

    ``renames`` is a list of (source column name or Column, new name).
    """
    items = list(renames) + (_audit() if audit else [])
    cols = [(F.col(src) if isinstance(src, str) else src).alias(dst) for src, dst in items]
    return df.filter(F.col(key).isNotNull()).select(*cols)


def stg_pedidos(raw: DataFrame) -> DataFrame:
    low_retiro = F.lower(F.col("tipo_retiro"))
    return stage(raw, [
        ("codigo", "pedido_id"), ("cliente", "cliente_id"), ("direccion", "direccion_id"),
        ("tipo_retiro", "tipo_retiro"), (C.flag(low_retiro.like("%delivery%")), "is_delivery"),
        ("tipo_pago", "tipo_pago"), (C.flag(F.lower(F.col("tipo_pago")) == "cash"), "is_cash"),
        ("mp_ID", "mercadopago_id"), ("mp_Status", "mercadopago_status"),
        ("mp_TransactionAmount", "mp_monto_transaccion"), ("mp_totalPaidAmount", "mp_monto_pagado"),
        ("mp_netReceivedAmount", "mp_monto_neto_recibido"), ("mp_Fee", "mp_comision"),
        ("mp_PaymentType", "mp_tipo_pago"), ("telefono", "telefono"), ("comentario", "comentario"),
        ("subtotal", "subtotal"), ("redondeo", "redondeo"), ("total", "total"),
        ("envio", "costo_envio"), ("descuento", "descuento"), ("descuento_ajuste", "descuento_ajuste"),
        ("descuento_alianza", "descuento_alianza"), ("abona_con", "abona_con"),
        ("estado", "estado_id"), ("pagado", "is_pagado"), ("demora", "demora_minutos"),
        ("distancia", "distancia_km"), ("repartidor", "repartidor"), ("motivo", "motivo_cancelacion"),
        ("fecha_sys", "created_at_unix"),
    ], "codigo")


def stg_pedidos_productos(raw: DataFrame) -> DataFrame:
    return stage(raw, [("codigo", "pedido_producto_id"), ("id_pedido", "pedido_id"),
                       ("id_producto", "producto_id"), ("extras", "extras")], "codigo")


def stg_pedidos_productos_sabores(raw: DataFrame) -> DataFrame:
    return stage(raw, [("codigo", "pedido_producto_sabor_id"),
                       ("id_pedido_producto", "pedido_producto_id"), ("sabor", "sabor_id")], "codigo")


def stg_clientes(raw: DataFrame) -> DataFrame:
    return stage(raw, [("codigo", "cliente_id"), ("nombre", "nombre"), ("email", "email"),
                       ("telefono", "telefono"), ("google_id", "google_id"), ("tipo", "tipo_cliente")],
                 "codigo")


def stg_clientes_direcciones(raw: DataFrame) -> DataFrame:
    return stage(raw, [("codigo", "direccion_id"), ("cliente", "cliente_id"), ("direccion", "direccion"),
                       ("piso", "piso"), ("depto", "depto"), ("barrio", "barrio"),
                       ("map_lat", "latitud"), ("map_lng", "longitud"), ("distancia", "distancia_km"),
                       ("zona", "zona_id"), ("observaciones", "observaciones")], "codigo")


def stg_productos(raw: DataFrame) -> DataFrame:
    """Catalogue with all price lists and the weight from the name."""
    return stage(raw, [
        ("codigo", "producto_id"), ("categoria", "categoria_id"), ("nombre", "nombre"),
        ("descripcion", "descripcion"), ("precio", "precio_base"), ("precio_efectivo", "precio_efectivo"),
        ("precio_mp", "precio_mercadopago"), ("precio_transferencia", "precio_transferencia"),
        ("precio_alianza", "precio_alianza"), ("precio_mostrador", "precio_mostrador"),
        ("precio_mostrador_efectivo", "precio_mostrador_efectivo"),
        ("precio_mostrador_mp", "precio_mostrador_mercadopago"),
        ("precio_mostrador_transferencia", "precio_mostrador_transferencia"),
        ("precio_mostrador_alianza", "precio_mostrador_alianza"),
        ("descuento", "descuento_porcentaje"), ("gustos", "cantidad_gustos"),
        ("dias", "dias_disponible"), ("mostrador", "is_solo_mostrador"),
        (C.weight_kg("nombre"), "peso_kg"),
    ], "codigo")


def stg_categorias(raw: DataFrame) -> DataFrame:
    return stage(raw, [("codigo", "categoria_id"), ("nombre", "nombre"), ("orden", "orden_display")], "codigo")


def stg_sabores(raw: DataFrame) -> DataFrame:
    return stage(raw, [("codigo", "sabor_id"), ("categoria", "categoria_id"), ("nombre", "nombre"),
                       ("sinazucar", "is_sin_azucar")], "codigo")


def stg_zonas(raw: DataFrame) -> DataFrame:
    return stage(raw, [("codigo", "zona_id"), ("distancia", "distancia_max_km"), ("precio", "precio_envio"),
                       ("demora", "demora_estimada_minutos")], "codigo")


def stg_delivery(raw: DataFrame) -> DataFrame:
    # the id list stays opaque text, as in the source
    return stage(raw, [("codigo", "delivery_id"), ("pedidos", "pedidos_ids"), ("repartidor", "repartidor"),
                       ("total", "total"), ("estado", "estado_id")], "codigo")


# ------------------------------------------------------------------ seeds

def stg_clima(seed: DataFrame) -> DataFrame:
    """Daily weather with average temperature and rain flag."""
    return seed.select(
        F.to_date("fecha").alias("fecha"),
        F.col("temp_max_c").alias("temperatura_maxima"),
        F.col("temp_min_c").alias("temperatura_minima"),
        F.round((F.col("temp_max_c") + F.col("temp_min_c")) / 2, 1).alias("temperatura_promedio"),
        C.flag(F.col("precipitacion_mm") > 0).alias("flg_precipitaciones"),
        "precipitacion_mm", "lluvia_mm", "viento_max_kmh",
    )


def stg_costos_sabores(seed: DataFrame, sabores: DataFrame) -> DataFrame:
    """Flavour cost per month, with the system flavour name and a match flag."""
    mes_fecha = C.month_from_text("mes")
    s = seed.select(
        "sabor_nombre",
        F.expr("try_cast(sabor_id as int)").alias("sabor_id"),
        mes_fecha.alias("mes_fecha"), "mes",
        F.year(mes_fecha).cast("bigint").alias("anio"),
        F.month(mes_fecha).cast("bigint").alias("mes_num"),
        F.round(F.col("costo_por_kg").cast("decimal(10,2)"), 2).alias("costo_por_kg"),
        F.col("sabor_id").isNotNull().alias("tiene_match"),
    )
    names = sabores.select("sabor_id", F.col("nombre").alias("sabor_sistema"))
    # the flavour table is a dimension (one row per flavour); AQE broadcasts it
    # when its measured size is under the threshold, else this is a hash join
    return s.join(names, "sabor_id", "left").select(
        "sabor_nombre", "sabor_id", "sabor_sistema", "mes_fecha", "mes", "anio", "mes_num",
        "costo_por_kg", "tiene_match")


def stg_dolar_blue(seed: DataFrame) -> DataFrame:
    """Business-day rate -> continuous daily rate (spine, left join, forward fill)."""
    src = seed.select(F.to_date("fecha").alias("fecha"),
                      F.col("valor_blue").cast("decimal(10,2)").alias("valor_blue"))
    bounds = src.agg(F.min("fecha").alias("lo"), F.max("fecha").alias("hi"))
    spine = bounds.select(F.explode(C.date_spine("lo", "hi")).alias("fecha"))
    joined = spine.join(src, "fecha", "left")
    # one row per calendar day: bounded by the date range, not by data volume
    return forward_fill(joined, "fecha", "valor_blue")


def stg_egresos(seed: DataFrame) -> DataFrame:
    """Expenses with normalised category and means of payment and a running id."""
    fecha = F.to_date("fecha")
    base = seed.filter(F.col("fecha").isNotNull()).select(
        fecha.alias("fecha"), "descripcion",
        C.normalise("categoria", R.EXPENSE_CATEGORY_MAP, R.EXPENSE_CATEGORY_DEFAULT).alias("categoria"),
        "monto", "moneda",
        C.normalise("medio_pago", R.EXPENSE_MEANS_MAP, R.EXPENSE_MEANS_DEFAULT).alias("medio_pago"),
        "cantidad",
        F.year(fecha).cast("bigint").alias("anio"),
        F.month(fecha).cast("bigint").alias("mes_num"),
        C.year_month(fecha).alias("mes"),
    )
    return base


def with_expense_ids(egresos: DataFrame) -> DataFrame:
    """Running id by (fecha, descripcion), distributed; ties broken by the row's other columns."""
    order = [F.col("fecha").asc_nulls_last(), F.col("descripcion").asc_nulls_last(),
             F.col("categoria").asc_nulls_last(), F.col("monto").asc_nulls_last(),
             F.col("medio_pago").asc_nulls_last(), F.col("cantidad").asc_nulls_last()]
    return global_row_number(egresos, order, "egreso_id")


def stg_puntos(puntos: DataFrame, points_clientes: DataFrame, as_of) -> DataFrame:
    """Loyalty movements mapped to main customer ids; ``as_of`` replaces current_date."""
    pc = points_clientes.select(F.col("id").alias("points_cliente_id"), F.col("remote_id").alias("cliente_id"))
    venc = F.to_date("vencimiento")
    return puntos.join(pc, puntos["cliente_id"] == pc["points_cliente_id"], "left").select(
        F.col("id").alias("punto_id"), pc["cliente_id"].alias("cliente_id"),
        puntos["cliente_id"].alias("points_cliente_id"), "puntos",
        C.classify_sign("puntos").alias("tipo_movimiento"),
        F.abs("puntos").alias("puntos_abs"),
        F.col("fecha").cast("timestamp_ntz").alias("fecha"),
        venc.alias("vencimiento"),
        C.flag(venc >= F.lit(as_of).cast("date")).alias("is_vigente"),
    )


def stg_registro_diario(seed: DataFrame, surcharge: float = R.COURIER_SURCHARGE) -> DataFrame:
    """Register rows with courier cost x surcharge and calendar columns."""
    from decimal import Decimal
    fecha = F.to_date("fecha")
    return seed.filter(F.col("fecha").isNotNull()).select(
        fecha.alias("fecha"), "dia_nombre", "q_pedidos",
        F.col("total_rapiboys").alias("costo_rapiboy"),
        F.round(F.col("total_rapiboys") * F.lit(Decimal(str(surcharge))), 2).alias("costo_delivery_total"),
        F.year(fecha).cast("bigint").alias("anio"),
        F.month(fecha).cast("bigint").alias("mes_num"),
        C.year_month(fecha).alias("mes"),
    )
