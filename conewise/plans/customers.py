"""Customer models: D02 profile, D13 dimension (RFM), D14 RFM report, D15 cohorts, D23 points."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conewise.functions import columns as C
from conewise.functions import rules as R
from conewise.operators.aggregates import count_when, id_chunks, ids_text, sum_when
from conewise.operators.ntile_cuts import ntile_by_cuts
from conewise.operators.windows import lag_change, latest_per, newest_two
from conewise.sources.sinks import cut_lineage

# ---------------------------------------------------------------- D02

ADDRESS_PAYLOAD = ["direccion_id", "direccion", "piso", "depto", "barrio", "latitud", "longitud",
                   "distancia_km", "zona_id"]


def identity_ids(clientes: DataFrame, mails: DataFrame) -> DataFrame:
    """Chunks of the customer ids of each identity, which D02 and D13 read."""
    known = mails.select("cliente_id", "cliente_id_mail_phone").filter(F.col("cliente_id_mail_phone").isNotNull())
    return id_chunks(known.join(clientes.select("cliente_id"), "cliente_id"), "cliente_id_mail_phone", "cliente_id")


def customer_profile(clientes: DataFrame, mails: DataFrame, direcciones: DataFrame,
                     zonas: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per customer; ``ids`` are the chunks of ``identity_ids``."""
    order = ["created_at", "direccion_id"]
    newest, previous = newest_two(direcciones, "cliente_id", order, ADDRESS_PAYLOAD)
    zm = direcciones.join((zonas.select("zona_id", "distancia_max_km", "demora_estimada_minutos")),
                          "zona_id").groupBy("cliente_id").agg(
        F.max("demora_estimada_minutos").alias("demora_estimada_max"),
        F.min("demora_estimada_minutos").alias("demora_estimada_min"),
        F.round(F.avg("demora_estimada_minutos"), 1).alias("demora_estimada_avg"),
        F.max("distancia_max_km").alias("distancia_max_km_max"),
        F.min("distancia_max_km").alias("distancia_max_km_min"),
        F.round(F.avg("distancia_max_km"), 1).alias("distancia_max_km_avg"))

    ident = mails.select("cliente_id", "cliente_id_mail_phone")
    members = (ident.filter(F.col("cliente_id_mail_phone").isNotNull())
               .join(clientes.select("cliente_id", "created_at"), "cliente_id"))
    # newest member and size of each identity, as partial aggregates
    per_ident = members.groupBy("cliente_id_mail_phone").agg(
        F.max_by("cliente_id", F.struct("created_at", "cliente_id")).alias("_newest_id"),
        F.count(F.lit(1)).alias("total_clientes_identidad"))
    member_info = cut_lineage(members.join(per_ident, "cliente_id_mail_phone").select(
        "cliente_id", "cliente_id_mail_phone", "total_clientes_identidad",
        (F.col("cliente_id") == F.col("_newest_id")).alias("_is_newest")))
    newest_ids = member_info.filter("_is_newest").select("cliente_id_mail_phone", F.col("cliente_id").alias("_newest_id"))
    earlier = ids_text(ids.join(newest_ids, "cliente_id_mail_phone").withColumn("ids", F.array_remove("ids", F.col("_newest_id"))),
                       "cliente_id_mail_phone", "cliente_ids_anteriores")
    member_info = member_info.drop("cliente_id_mail_phone")

    ud = newest.select("cliente_id", *[F.col(c).alias(f"ud_{c}") for c in ADDRESS_PAYLOAD])
    da = previous.select("cliente_id", *[F.col(c).alias(f"da_{c}") for c in ADDRESS_PAYLOAD])
    j = (clientes.join(ident, "cliente_id", "left")
         .join(member_info, "cliente_id", "left")
         .join(earlier.withColumnRenamed("cliente_id_mail_phone", "_e_ident"),
               (F.col("cliente_id_mail_phone") == F.col("_e_ident")) & F.col("_is_newest"), "left")
         .join(ud, "cliente_id", "left")
         .join(da, "cliente_id", "left")
         .join(zm, "cliente_id", "left"))
    return j.select(
        "cliente_id", "cliente_id_mail_phone", "nombre", "email", "telefono", "google_id", "tipo_cliente",
        "is_activo", "created_at", "updated_at",
        F.col("ud_barrio").alias("ultimo_barrio"), F.col("da_barrio").alias("barrio_anterior"),
        F.coalesce("total_clientes_identidad", F.lit(0)).cast("bigint").alias("total_clientes_identidad"),
        F.when(F.col("_is_newest").isNull() | F.col("_is_newest"), 1).otherwise(0).alias("is_ultimo_cliente_identidad"),
        "cliente_ids_anteriores",
        F.col("ud_direccion_id").alias("direccion_ultima_id"), F.col("ud_direccion").alias("direccion_ultima"),
        F.col("ud_piso").alias("direccion_ultima_piso"), F.col("ud_depto").alias("direccion_ultima_depto"),
        F.col("ud_barrio").alias("direccion_ultima_barrio"), F.col("ud_latitud").alias("direccion_ultima_lat"),
        F.col("ud_longitud").alias("direccion_ultima_lng"),
        F.col("ud_distancia_km").alias("direccion_ultima_distancia_km"),
        F.col("ud_zona_id").alias("direccion_ultima_zona_id"),
        F.col("da_direccion_id").alias("direccion_anterior_id"), F.col("da_direccion").alias("direccion_anterior"),
        F.col("da_barrio").alias("direccion_anterior_barrio"), F.col("da_zona_id").alias("direccion_anterior_zona_id"),
        "demora_estimada_max", "demora_estimada_min", "demora_estimada_avg",
        "distancia_max_km_max", "distancia_max_km_min", "distancia_max_km_avg",
    )


# ---------------------------------------------------------------- D13

def customer_dimension(clientes: DataFrame, mails: DataFrame, direcciones: DataFrame,
                       fact: DataFrame, as_of, chunks: DataFrame) -> DataFrame:
    """One row per identity with RFM scores and segment; ``as_of`` replaces current_date, ``chunks`` are of ``identity_ids``."""
    asof = F.lit(as_of).cast("date")
    ident = mails.select("cliente_id", "cliente_id_mail_phone", "tipo_identidad").filter(
        F.col("cliente_id_mail_phone").isNotNull())
    cci = clientes.join(ident, "cliente_id")
    rep_cols = ["tipo_identidad", "cliente_id", "nombre", "email", "telefono", "tipo_cliente", "created_at",
                "is_activo"]
    # representative and number of ids of an identity from one aggregate
    rep = cci.groupBy("cliente_id_mail_phone").agg(
        F.max_by(F.struct(*rep_cols), F.struct("created_at", "cliente_id")).alias("_rep"),
        F.count(F.lit(1)).alias("n_cliente_ids")).select("cliente_id_mail_phone", "_rep.*", "n_cliente_ids")
    ids = ids_text(chunks, "cliente_id_mail_phone", "todos_cliente_ids")
    addr = (cci.select("cliente_id", "cliente_id_mail_phone")
            .join(direcciones.filter(F.col("is_activo") == 1)
                  .select("cliente_id", "direccion_id", "barrio", "direccion", F.col("created_at").alias("_dc")),
                  "cliente_id"))
    main_addr = latest_per(addr, ["cliente_id_mail_phone"], ["_dc", "direccion_id"], ["barrio", "direccion"])

    d = fact.filter((F.col("estado_id") == R.STATUS_DELIVERED) & F.col("cliente_id_mail_phone").isNotNull())
    per = d.groupBy("cliente_id_mail_phone").agg(
        F.count(F.lit(1)).alias("total_pedidos"), F.sum("total").alias("total_gastado"),
        F.round(F.avg("total"), 2).alias("ticket_promedio"), F.sum("kg_total").alias("kg_total"),
        F.sum("total_usd").alias("total_gastado_usd"),
        F.min("created_at").alias("primer_pedido"), F.max("created_at").alias("ultimo_pedido"),
        count_when(F.col("tipo_retiro") == "delivery").alias("pedidos_delivery"),
        count_when(F.col("tipo_retiro") == "local").alias("pedidos_local"),
        count_when(F.col("tipo_retiro") == "mostrador").alias("pedidos_mostrador"),
        count_when(F.col("tipo_pago") == "cash").alias("pagos_efectivo"),
        count_when(F.col("tipo_pago") == "mp").alias("pagos_mercadopago"),
        count_when(F.col("tipo_pago") == "transfer").alias("pagos_transferencia"),
    )
    weeks = C.weeks_between("primer_pedido", asof)
    per = per.withColumn("dias_desde_ultimo_pedido", C.days_between("ultimo_pedido", asof).cast("bigint")) \
        .withColumn("pedidos_por_semana",
                    F.when(weeks > 0, F.col("total_pedidos") / weeks).otherwise(F.col("total_pedidos").cast("double")))
    # monetary score: ntile(5) by kg over all buyers, by exact cut points
    per = ntile_by_cuts(per, "kg_total", "cliente_id_mail_phone", 5, "monetario_score")
    per = per.withColumn("recencia_score", C.recency_score("dias_desde_ultimo_pedido")) \
             .withColumn("frecuencia_score", C.frequency_score("pedidos_por_semana"))

    zero = F.lit(0)
    z = lambda c: F.coalesce(F.col(c), zero)
    j = rep.join(ids, "cliente_id_mail_phone", "left").join(main_addr, "cliente_id_mail_phone", "left") \
        .join(per, "cliente_id_mail_phone", "left")
    return j.select(
        "cliente_id_mail_phone", "tipo_identidad", "cliente_id", "todos_cliente_ids",
        F.col("n_cliente_ids").cast("bigint").alias("n_cliente_ids"),
        "nombre", "email", "telefono", "tipo_cliente", F.col("created_at").alias("fecha_registro"), "is_activo",
        "barrio", F.col("direccion").alias("direccion_principal"),
        z("total_pedidos").cast("bigint").alias("total_pedidos"), z("total_gastado").alias("total_gastado"),
        F.round(z("ticket_promedio"), 2).alias("ticket_promedio"), F.round(z("kg_total"), 2).alias("kg_total"),
        z("total_gastado_usd").alias("total_gastado_usd"), "primer_pedido", "ultimo_pedido",
        F.coalesce("dias_desde_ultimo_pedido", F.lit(9999)).cast("bigint").alias("dias_desde_ultimo_pedido"),
        F.round(z("pedidos_por_semana"), 4).cast("double").alias("pedidos_por_semana"),
        z("pedidos_delivery").cast("bigint").alias("pedidos_delivery"),
        z("pedidos_local").cast("bigint").alias("pedidos_local"),
        z("pedidos_mostrador").cast("bigint").alias("pedidos_mostrador"),
        C.preferred_of_three("pedidos_delivery", "pedidos_local", "pedidos_mostrador",
                             ["delivery", "local", "mostrador"]).alias("tipo_retiro_preferido"),
        z("pagos_efectivo").cast("bigint").alias("pagos_efectivo"),
        z("pagos_mercadopago").cast("bigint").alias("pagos_mercadopago"),
        z("pagos_transferencia").cast("bigint").alias("pagos_transferencia"),
        C.preferred_of_three("pagos_efectivo", "pagos_mercadopago", "pagos_transferencia",
                             ["efectivo", "mercadopago", "transferencia"]).alias("tipo_pago_preferido"),
        z("recencia_score").cast("bigint").alias("recencia_score"),
        z("frecuencia_score").cast("bigint").alias("frecuencia_score"),
        z("monetario_score").cast("bigint").alias("monetario_score"),
        (z("recencia_score") + z("frecuencia_score") + z("monetario_score")).cast("bigint").alias("rfm_total"),
        C.segment("total_pedidos", "dias_desde_ultimo_pedido", "recencia_score", "frecuencia_score",
                  "monetario_score").alias("segmento_cliente"),
    )


# ---------------------------------------------------------------- D14

def rfm_report(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col("total_pedidos") > 0).select(
        "cliente_id_mail_phone", "cliente_id", "nombre", "email", "tipo_cliente", "tipo_identidad", "barrio",
        "dias_desde_ultimo_pedido", "total_pedidos", "pedidos_por_semana", "total_gastado", "total_gastado_usd",
        "kg_total", "ticket_promedio", "primer_pedido", "ultimo_pedido",
        "recencia_score", "frecuencia_score", "monetario_score", "rfm_total", "segmento_cliente",
        C.score_label("recencia_score", R.RECENCY_LABELS).alias("recencia_label"),
        C.score_label("frecuencia_score", R.FREQUENCY_LABELS).alias("frecuencia_label"),
        C.score_label("monetario_score", R.VOLUME_LABELS).alias("volumen_label"),
        "tipo_retiro_preferido", "tipo_pago_preferido",
    )


# ---------------------------------------------------------------- D15

def cohort_retention(primer: DataFrame, fact: DataFrame, horizons=R.RETENTION_HORIZONS) -> DataFrame:
    """Acquisition month, first channel/payment/ticket, retention at each horizon, change vs previous month."""
    firsts = primer.filter(F.col("is_primer_pedido")).select(
        "cliente_id_mail_phone", "fecha_primer_pedido", F.col("pedido_id").alias("primer_pedido_id"))
    cohort = firsts.withColumn("mes_adquisicion", C.month_start("fecha_primer_pedido"))
    info = cohort.join(fact.select(F.col("pedido_id").alias("primer_pedido_id"), "tipo_retiro", "tipo_pago",
                                   F.col("total").alias("ticket_primer_pedido")), "primer_pedido_id")
    repeats = (primer.select("cliente_id_mail_phone", "pedido_id", "is_primer_pedido", "fecha_primer_pedido")
               .join(fact.filter(F.col("estado_id") == R.STATUS_DELIVERED)
                     .select("pedido_id", F.col("created_at").alias("fecha_pedido")), "pedido_id", "left"))
    # every order carries its identity's first date: no join of cohorts with repeat orders
    ret = repeats.groupBy("cliente_id_mail_phone", C.month_start("fecha_primer_pedido").alias("mes_adquisicion")).agg(*[
        F.max(C.flag(~F.col("is_primer_pedido") & (F.col("fecha_pedido") <= C.plus_days("fecha_primer_pedido", h))))
        .alias(f"retuvo_{h}d") for h in horizons])
    new = info.groupBy(F.col("mes_adquisicion").alias("mes")).agg(
        F.countDistinct("cliente_id_mail_phone").alias("clientes_nuevos"),
        count_when(F.col("tipo_retiro") == "delivery").alias("nuevos_delivery"),
        count_when(F.col("tipo_retiro") == "local").alias("nuevos_local"),
        count_when(F.col("tipo_retiro") == "mostrador").alias("nuevos_mostrador"),
        count_when(F.col("tipo_pago") == "cash").alias("nuevos_efectivo"),
        count_when(F.col("tipo_pago") == "mp").alias("nuevos_mp"),
        count_when(F.col("tipo_pago") == "transfer").alias("nuevos_transferencia"),
        F.round(F.avg("ticket_primer_pedido"), 2).alias("ticket_promedio_primer_pedido"))
    hundred = F.lit(Decimal("100.0"))
    rm = ret.groupBy(F.col("mes_adquisicion").alias("mes")).agg(*[
        F.round(C.ddiv(F.sum(f"retuvo_{h}d") * hundred, F.count(F.lit(1))), 1).alias(f"retencion_{h}d_pct")
        for h in horizons])
    # one row per month: calendar-sized window
    out = new.join(rm, "mes", "left")
    out = lag_change(out, "mes", "clientes_nuevos", "clientes_nuevos_mes_anterior", "var_vs_mes_anterior_pct")
    month = F.month("mes")
    return out.select(
        "mes", F.year("mes").cast("bigint").alias("anio"), month.cast("bigint").alias("mes_num"),
        C.season(month).alias("estacion"),
        C.commercial_season(month, R.COMMERCIAL_SEASON_COHORTS).alias("temporada"),
        "clientes_nuevos", "nuevos_delivery", "nuevos_local", "nuevos_mostrador", "nuevos_efectivo", "nuevos_mp",
        "nuevos_transferencia", "ticket_promedio_primer_pedido",
        *[f"retencion_{h}d_pct" for h in horizons],
        "clientes_nuevos_mes_anterior", "var_vs_mes_anterior_pct",
    )


# ---------------------------------------------------------------- D23

def loyalty_points(movs: DataFrame, mails: DataFrame, dim: DataFrame, as_of) -> DataFrame:
    asof = F.lit(as_of).cast("date")
    acc = F.col("tipo_movimiento") == "acumulacion"
    red = F.col("tipo_movimiento") == "canje"
    m = movs.filter(F.col("cliente_id").isNotNull()).join(
        mails.filter(F.col("cliente_id_mail_phone").isNotNull()).select("cliente_id", "cliente_id_mail_phone"),
        "cliente_id")
    ri = m.groupBy("cliente_id_mail_phone").agg(
        sum_when(acc, "puntos_abs").alias("puntos_acumulados"),
        count_when(acc).alias("movimientos_acumulacion"),
        sum_when(red, "puntos_abs").alias("puntos_canjeados"),
        count_when(red).alias("movimientos_canje"),
        (sum_when(acc & (F.col("is_vigente") == 1), "puntos_abs") - sum_when(red, "puntos_abs")).alias("saldo_vigente"),
        sum_when(acc & (F.col("is_vigente") == 0), "puntos_abs").alias("saldo_vencido"),
        F.count(F.lit(1)).alias("total_movimientos"),
        F.min(F.when(acc, F.col("fecha"))).alias("fecha_primera_acumulacion"),
        F.max(F.when(acc, F.col("fecha"))).alias("fecha_ultima_acumulacion"),
        F.max(F.when(red, F.col("fecha"))).alias("fecha_ultimo_canje"),
        (count_when(F.col("fecha") >= F.date_sub(asof, 90).cast("timestamp_ntz")) > 0).alias("is_activo_puntos"),
    )
    j = ri.join(dim.select("cliente_id_mail_phone", "cliente_id", "nombre", "segmento_cliente"),
                "cliente_id_mail_phone")
    return j.select(
        "cliente_id_mail_phone", "cliente_id", "nombre", "segmento_cliente",
        F.col("puntos_acumulados").cast("bigint").alias("puntos_acumulados"),
        F.col("puntos_canjeados").cast("bigint").alias("puntos_canjeados"),
        F.greatest("saldo_vigente", F.lit(0)).cast("bigint").alias("saldo_vigente"),
        F.col("saldo_vencido").cast("bigint").alias("saldo_vencido"),
        "total_movimientos", "movimientos_acumulacion", "movimientos_canje",
        C.pct("puntos_canjeados", "puntos_acumulados", 1, 0).cast("double").alias("ratio_canje"),
        "fecha_primera_acumulacion", "fecha_ultima_acumulacion", "fecha_ultimo_canje", "is_activo_puntos",
    )
