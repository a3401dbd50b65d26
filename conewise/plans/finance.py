"""Monthly finance: D16 P&L, D17 cash flow, D18 expenses year-over-year, D19 margin breakdown.

All frames here are one row per month (or month x category / dimension), so
windows over months are calendar-sized and the monthly FX table (D12) is
broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conewise.functions import columns as C
from conewise.functions import rules as R
from conewise.operators.aggregates import grouping_sets, sum_when
from conewise.operators.windows import running_sum


def _usd(x, rate="tipo_cambio_promedio"):
    return C.to_usd(x, rate, 2)


def expenses_by_month(egresos: DataFrame) -> DataFrame:
    """Expenses by month, category and means of payment: what D16 to D18 read (a table of calendar size)."""
    return egresos.groupBy(C.month_start("fecha").alias("mes"), F.year("fecha").cast("bigint").alias("anio"),
                           F.month("fecha").cast("bigint").alias("mes_num"), "categoria", "medio_pago").agg(
        F.sum("monto").alias("monto"), F.count(F.lit(1)).alias("cantidad_egresos"))


# ---------------------------------------------------------------- D16

def pnl_monthly(daily: DataFrame, egresos: DataFrame, fx_month: DataFrame) -> DataFrame:
    """P&L; ``egresos`` are the expenses by month."""
    inc = daily.groupBy(C.month_start("fecha").alias("mes"),
                        F.year("fecha").cast("bigint").alias("anio"),
                        F.month("fecha").cast("bigint").alias("mes_num")).agg(
        F.sum("venta_sistema").alias("venta_sistema"),
        F.sum("venta_plataforma_estimada").alias("venta_plataforma"),
        F.sum("venta_total").alias("ingresos_totales"),
        F.sum("costo_total_sistema").alias("cogs_sistema"),
        F.sum("costo_plataforma_estimado").alias("cogs_plataforma"),
        (F.sum("costo_total_sistema") + F.sum("costo_plataforma_estimado")).alias("cogs_total"),
        F.sum("comision_mp_total").alias("comision_mp"),
        F.sum("comision_plataforma").alias("comision_plataforma"),
        (F.sum("comision_mp_total") + F.sum("comision_plataforma")).alias("total_comisiones"),
        F.sum("costo_delivery_total").alias("costo_delivery"),
        F.sum("pedidos_totales").alias("pedidos_totales"),
        F.sum("kg_totales").alias("kg_totales"))
    cat = F.col("categoria")
    supply = cat.isin(R.PNL_SUPPLY_CATEGORIES)
    named = [c for _, c in R.PNL_NAMED_CATEGORIES]
    exp = egresos.groupBy("mes").agg(
        sum_when(supply, "monto").alias("gasto_insumos"),
        *[sum_when(cat == c, "monto").alias(name) for name, c in R.PNL_NAMED_CATEGORIES],
        sum_when(~cat.isin(named + R.PNL_SUPPLY_CATEGORIES + [R.PNL_INVESTMENT]), "monto").alias("gasto_otros"),
        sum_when(~cat.isin(R.PNL_SUPPLY_CATEGORIES + [R.PNL_INVESTMENT]), "monto").alias("total_gastos_operativos"))
    j = inc.join(exp, "mes", "left").join(F.broadcast(fx_month), "mes", "left")
    zero = F.lit(0)
    z = lambda c: F.coalesce(F.col(c), zero)
    ing = F.col("ingresos_totales")
    bruto = ing - z("gasto_insumos")
    result = ing - z("gasto_insumos") - z("total_gastos_operativos") - F.col("total_comisiones") - F.col("costo_delivery")
    return j.select(
        "mes", "anio", "mes_num", "venta_sistema", "venta_plataforma", "ingresos_totales",
        z("gasto_insumos").alias("gasto_insumos"),
        bruto.alias("margen_bruto"), C.pct(bruto, ing, 1, 0).alias("margen_bruto_pct"),
        "cogs_sistema", "cogs_plataforma", "cogs_total",
        *[z(name).alias(name) for name, _ in R.PNL_NAMED_CATEGORIES],
        z("gasto_otros").alias("gasto_otros"), z("total_gastos_operativos").alias("total_gastos_operativos"),
        "comision_mp", "comision_plataforma", "total_comisiones", "costo_delivery",
        result.alias("resultado_operativo"), C.pct(result, ing, 1, 0).alias("resultado_operativo_pct"),
        "tipo_cambio_promedio",
        _usd(ing).alias("ingresos_totales_usd"), _usd(z("gasto_insumos")).alias("gasto_insumos_usd"),
        _usd(bruto).alias("margen_bruto_usd"), _usd(F.col("cogs_total")).alias("cogs_total_usd"),
        _usd(z("total_gastos_operativos")).alias("total_gastos_operativos_usd"),
        _usd(result).alias("resultado_operativo_usd"),
        "pedidos_totales", "kg_totales",
    )


# ---------------------------------------------------------------- D17

def cash_flow_monthly(daily: DataFrame, egresos: DataFrame, fx_month: DataFrame) -> DataFrame:
    """Cash flow; ``egresos`` are the expenses by month."""
    inf = daily.groupBy(C.month_start("fecha").alias("mes"),
                        F.year("fecha").cast("bigint").alias("anio"),
                        F.month("fecha").cast("bigint").alias("mes_num")).agg(
        F.sum("venta_efectivo").alias("cobros_efectivo"),
        F.sum("neto_mp_total").alias("cobros_mp_neto"),
        F.sum("venta_transferencia").alias("cobros_transferencia"),
        (F.sum("venta_efectivo") + F.sum("neto_mp_total") + F.sum("venta_transferencia")).alias("total_inflows"),
        F.sum("costo_delivery_total").alias("costo_delivery"))
    out = egresos.filter(F.col("categoria") != R.PNL_INVESTMENT).groupBy("mes").agg(
        *[sum_when(F.col("medio_pago") == m, "monto").alias(name) for name, m in R.CASH_OUT_MEANS],
        F.sum("monto").alias("total_egresos"))
    zero = F.lit(0)
    z = lambda c: F.coalesce(F.col(c), zero)
    j = inf.join(out, "mes", "left").join(F.broadcast(fx_month), "mes", "left")
    cf = j.select(
        "mes", "anio", "mes_num", "cobros_efectivo", "cobros_mp_neto", "cobros_transferencia", "total_inflows",
        *[z(name).alias(name) for name, _ in R.CASH_OUT_MEANS],
        z("costo_delivery").alias("costo_delivery"),
        (z("total_egresos") + z("costo_delivery")).alias("total_outflows"),
        (F.col("total_inflows") - z("total_egresos") - z("costo_delivery")).alias("flujo_neto"),
        "tipo_cambio_promedio")
    cf = running_sum(cf, "mes", "flujo_neto", "flujo_neto_acumulado")
    return cf.select("*", _usd("total_inflows").alias("total_inflows_usd"),
                     _usd("total_outflows").alias("total_outflows_usd"),
                     _usd("flujo_neto").alias("flujo_neto_usd"))


# ---------------------------------------------------------------- D18

def expenses_yoy(egresos: DataFrame, fx_month: DataFrame) -> DataFrame:
    """Expenses against the same month a year before; ``egresos`` are the expenses by month."""
    em = egresos.groupBy("mes", "anio", "mes_num", "categoria").agg(
        F.sum("monto").alias("monto_total"), F.sum("cantidad_egresos").alias("cantidad_egresos"))
    prev = em.select("categoria", "mes_num", (F.col("anio") + 1).alias("anio"),
                     F.col("monto_total").alias("monto_mismo_mes_anio_anterior"))
    j = em.join(prev, ["categoria", "mes_num", "anio"], "left").join(F.broadcast(fx_month), "mes", "left")
    p = F.col("monto_mismo_mes_anio_anterior")
    return j.select(
        "mes", "anio", "mes_num", "categoria", "monto_total", "cantidad_egresos",
        _usd("monto_total").alias("monto_total_usd"), "monto_mismo_mes_anio_anterior",
        C.pct(F.col("monto_total") - p, p, 1, None).alias("var_interanual_pct"),
        "tipo_cambio_promedio")


# ---------------------------------------------------------------- D19

def margin_breakdown(fact: DataFrame, fx_month: DataFrame) -> DataFrame:
    """Overall / by pickup / by payment per month in one GROUPING SETS pass."""
    d = fact.filter(F.col("estado_id") == R.STATUS_DELIVERED).select(
        "mes", "tipo_retiro", "tipo_pago", "total", "costo_total", "contribucion_mg", "kg_total")
    g = grouping_sets(d, ["mes"], ["tipo_retiro", "tipo_pago"], {
        "pedidos": "count(1)",
        "venta_total": "round(sum(total), 2)",
        "costo_total": "round(sum(costo_total), 2)",
        "contribucion_mg": "round(sum(contribucion_mg), 2)",
        "kg_totales": "round(sum(kg_total), 2)",
        "_total": "sum(total)",
        "_margen": "sum(contribucion_mg)",
    }).withColumn("margen_pct", C.pct("_margen", "_total", 1, 0))
    from pyspark.sql import Window
    w = Window.partitionBy("dimension_tipo", "dimension_valor").orderBy("mes")
    j = g.join(F.broadcast(fx_month), "mes", "left")
    return j.select(
        "mes", F.year("mes").cast("bigint").alias("anio"), F.month("mes").cast("bigint").alias("mes_num"),
        "dimension_tipo", "dimension_valor", "pedidos", "venta_total", "costo_total", "contribucion_mg",
        "kg_totales", "margen_pct",
        _usd("venta_total").alias("venta_total_usd"), _usd("costo_total").alias("costo_total_usd"),
        _usd("contribucion_mg").alias("contribucion_mg_usd"),
        F.when(F.col("dimension_tipo") == "overall",
               F.col("margen_pct") - F.lag("margen_pct").over(w)).alias("margen_pct_vs_mes_anterior"),
        "tipo_cambio_promedio")
