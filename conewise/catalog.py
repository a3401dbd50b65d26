"""Operator-level queries (S, P, J, A, T, R, Q rows) over the marts built from the test tables.

Each query builds the warehouse from the whole test tables (``Shop``) and
applies one report-side operator, so its work grows with the data.  The
oracle SQL runs on DuckDB over the same model CTEs (``oracle.models_sql``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conewise import quality as Q
from conewise.functions import columns as C
from conewise.functions.rules import RETENTION_LABELS
from conewise.operators.aggregates import distinct_values, kpis, value_counts
from conewise.oracle.models_sql import AVG, D
from conewise.functions.rules import STATUS_DELIVERED as DELIVERED
from conewise.operators.ntile_cuts import ntile_by_cuts
from conewise.operators.ordered_scan import ordered_scan
from conewise.operators import trigrams
from conewise.operators.sets import not_in, union_distinct
from conewise.plans import reports as R
from conewise.plans.facts import distinct_customers
from conewise.plans.warehouse import Shop
from conewise.sources import readers, sinks
from conewise.sources.readers import row_counts
from conewise.sources.sinks import table_root

# Report rows and labels as the source dashboard shows them.
PNL_ROWS_ARS = [
    ("Ingresos", "ingresos_totales"),
    ("Insumos (compra real)", "gasto_insumos"),
    ("Margen Bruto", "margen_bruto"),
    ("Margen Bruto %", "margen_bruto_pct"),
    ("Gastos Operativos", "total_gastos_operativos"),
    ("  Mano de Obra", "gasto_mano_obra"),
    ("  Alquiler", "gasto_alquiler"),
    ("  Servicios", "gasto_servicios"),
    ("  Marketing", "gasto_marketing"),
    ("  Impuestos", "gasto_impuestos"),
    ("  Logistica", "gasto_logistica"),
    ("  Otros", "gasto_otros"),
    ("Comisiones", "total_comisiones"),
    ("Delivery", "costo_delivery"),
    ("Resultado Operativo", "resultado_operativo"),
    ("Resultado Op. %", "resultado_operativo_pct"),
    ("COGS Sistema (ref.)", "cogs_total"),
    ("Pedidos (Q)", "pedidos_totales"),
    ("KG", "kg_totales"),
]
PNL_ROWS_USD = [
    ("Ingresos", "ingresos_totales_usd"),
    ("Insumos (compra real)", "gasto_insumos_usd"),
    ("Margen Bruto", "margen_bruto_usd"),
    ("Margen Bruto %", "margen_bruto_pct"),
    ("Gastos Operativos", "total_gastos_operativos_usd"),
    ("Resultado Operativo", "resultado_operativo_usd"),
    ("Resultado Op. %", "resultado_operativo_pct"),
    ("COGS Sistema (ref.)", "cogs_total_usd"),
    ("Tipo Cambio", "tipo_cambio_promedio"),
    ("Pedidos (Q)", "pedidos_totales"),
    ("KG", "kg_totales"),
]
WATERFALL_STEPS = [
    ("Ingresos", "ingresos_totales", 1),
    ("Insumos", "gasto_insumos", -1),
    ("Gastos Op.", "total_gastos_operativos", -1),
    ("Comisiones", "total_comisiones", -1),
    ("Delivery", "costo_delivery", -1),
]
WATERFALL_TOTAL = ("Resultado", "resultado_operativo")
INFLOW_PARTS = [("Efectivo", "cobros_efectivo"), ("MP Neto", "cobros_mp_neto"),
                ("Transferencia", "cobros_transferencia")]
OUTFLOW_PARTS = [("Egresos Efectivo", "egresos_efectivo"), ("Egresos Tarjeta", "egresos_tarjeta"),
                 ("Egresos MP", "egresos_mp"), ("Egresos Otro", "egresos_otro"), ("Delivery", "costo_delivery")]
RETENTION_COLS = ["retencion_30d_pct", "retencion_60d_pct", "retencion_90d_pct"]
RFM_TABLE_COLS = [
    "cliente_id", "nombre", "segmento_cliente",
    "recencia_score", "frecuencia_score", "monetario_score", "rfm_total",
    "total_pedidos", "kg_total", "total_gastado", "total_gastado_usd", "ticket_promedio",
    "dias_desde_ultimo_pedido", "recencia_label", "frecuencia_label",
]
TEMPERATURE_ORDER = ["Muy frio", "Frio", "Templado", "Calido", "Muy calido"]
TEMP_MEANS = ["pedidos_totales", "kg_totales", "kg_por_pedido", "venta_total_usd",
              "pedidos_delivery", "pedidos_local", "pedidos_mostrador"]
RAIN_MEANS = ["pedidos_totales", "kg_totales", "kg_por_pedido", "pedidos_delivery"]
SCATTER_METRICS = ["pedidos_totales", "kg_totales", "kg_por_pedido", "venta_total_usd"]
SELECTED_PERIOD = ("1996-01-01", "1997-12-31")
RUNNING = {"flujo_neto": "acumulado_periodo", "flujo_neto_usd": "acumulado_periodo_usd"}
INDEXED_PATTERN = "customer#0+[1-4]7"
SALES_SUMS = ["pedidos_totales", "kg_totales", "venta_total", "venta_total_usd"]


def _on_shop(fn: Callable[[Shop], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """A query over a warehouse built from the whole test tables under ``sf_dir``."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Shop.from_test_tables(spark, sf_dir))
    run.__name__ = fn.__name__
    return run


# ------------------------------------------------------------------ Spark side

def _r01(shop):
    return R.melt(shop.rpt_clientes_nuevos, ["mes"], RETENTION_COLS, "horizonte", "retencion_pct",
                  value_type="decimal(10,1)")


def _r02(rows):
    def run(shop):
        return R.statement_rows(shop.rpt_pnl, rows, "mes")
    return run


def _r03(shop):
    return R.waterfall(shop.rpt_pnl, "mes", WATERFALL_STEPS, WATERFALL_TOTAL)


def _r04(shop):
    cf = shop.rpt_cash_flow
    return R.composition(cf, INFLOW_PARTS, "inflow").unionByName(
        R.composition(cf, OUTFLOW_PARTS, "outflow", positive_only=True))


def _r05(shop):
    return R.season_matrix(shop.rpt_sabores, 15)


def _r06(shop):
    return R.filter_to_top(shop.rpt_egresos, "categoria", "monto_total", 5).select(
        "mes", "categoria", "monto_total")


def _r07(shop):
    return R.signed_flow(shop.rpt_cash_flow, "mes", "total_inflows", "total_outflows")


def _r08(shop):
    return R.payment_mix(shop.fct_ventas_diarias)


def _r09_temp(shop):
    days = R.weather_days(shop.fct_ventas_diarias)
    return R.order_by_labels(R.class_impact(days, "categoria_temperatura", "fecha", TEMP_MEANS),
                             "categoria_temperatura", TEMPERATURE_ORDER)


def _r09_rain(shop):
    days = R.weather_days(shop.fct_ventas_diarias)
    return R.class_impact(days, "categoria_precipitacion", "fecha", RAIN_MEANS).orderBy("pedidos_totales_prom")


def _r10(shop):
    return R.project_existing(shop.rpt_rfm, RFM_TABLE_COLS,
                              [F.col("rfm_total").desc(), F.col("cliente_id")])


def _r11(shop):
    return R.top_n(shop.rpt_sabores, "kg_vendidos", 50, tie=["sabor_id"]).select(
        "sabor_id", "sabor", "categoria", "kg_vendidos", "margen_estimado_por_kg_usd", "veces_pedido")


def _r11_rfm(shop):
    return R.points(shop.rpt_rfm, "frecuencia_score", "monetario_score", "cliente_id_mail_phone", "nombre", "total_pedidos",
                    "kg_total", "segmento_cliente")


def _r11_weather(shop):
    return R.melt(R.weather_days(shop.fct_ventas_diarias), ["fecha", "temperatura_promedio", "estacion"], SCATTER_METRICS,
                  "metrica", "valor", value_type="decimal(38,4)")


def _w13(shop):
    return shop.egresos_numerados.select("egreso_id", "fecha", "descripcion", "categoria", "monto")


def _w16(shop):
    return R.period_running(shop.rpt_cash_flow, "mes", *SELECTED_PERIOD, RUNNING)


def _a17(shop):
    return value_counts(shop.dim_clientes, "segmento_cliente", "clientes")


def _a18(grain):
    def run(shop):
        return R.rollup_time(shop.fct_ventas_diarias, "fecha", grain, SALES_SUMS)
    run.__name__ = f"_a18_{grain}"
    return run


def _a19(shop):
    return R.category_mean(shop.rpt_productos_vendidos, "categoria", "margen_pct",
                           ["kg_vendidos", "ingreso_estimado"], digits=2)


def _a20(shop):
    d = shop.fct_ventas_diarias
    return kpis(d, {
        "dias": F.count(F.lit(1)),
        "pedidos": F.sum("pedidos_totales"),
        "kg": F.sum("kg_totales"),
        "venta": F.sum("venta_total"),
        "venta_usd": F.sum("venta_total_usd"),
        "clientes_dia_max": F.max("clientes_unicos"),
    })


def _a21(shop):
    return R.total_by_category(shop.rpt_egresos, "categoria", "monto_total", "monto_total")


def _a23(shop):
    return distinct_values(shop.dim_clientes, "barrio")


def _p22(shop):
    f = R.facet_filter(shop.fct_pedidos,
                       {"tipo_retiro": ["delivery", "local"], "tipo_pago": None, "estado_nombre": None})
    return f.select("pedido_id", "tipo_retiro", "tipo_pago", "estado_nombre", "total")


def _p23(shop):
    d = R.facet_filter(shop.dim_clientes, {"segmento_cliente": None})
    return R.text_search(d, "nombre", "#0+1").select(
        "cliente_id_mail_phone", "nombre", "segmento_cliente", "total_gastado")


def _p23_index(shop):
    return trigrams.search(shop.dim_clientes, shop.nombres_trigramas, "cliente_id_mail_phone", "nombre", INDEXED_PATTERN).select(
        "cliente_id_mail_phone", "nombre", "segmento_cliente", "total_gastado")


def _p24(shop):
    return R.between_dates(shop.fct_ventas_diarias, "fecha", "1996-01-01", "1997-12-31").select(
        "fecha", "pedidos_totales", "venta_total")


def _p25(mode):
    def run(shop):
        return R.tristate(shop.rpt_sabores, "is_sin_azucar", mode).select("sabor_id", "sabor", "veces_pedido", "kg_vendidos")
    return run


def _p28(shop):
    return R.dimension_filter(shop.rpt_margenes, "tipo_pago").select(
        "mes", "dimension_valor", "pedidos", "venta_total", "margen_pct")


def _t02(shop):
    return R.top_n(shop.dim_clientes, "total_gastado", 20, tie=["cliente_id_mail_phone"]).select(
        "cliente_id_mail_phone", "nombre", "total_pedidos", "total_gastado")


def _t04(shop):
    return R.latest_period_row(shop.rpt_pnl, "mes")


def _t05(shop):
    return R.head_sample(shop.fct_pedidos, "pedido_id", 3).select("pedido_id", "fecha", "total")


def _q01(shop):
    shop = shop
    return Q.key_report({n: shop.model(n) for n in Q.KEYED_TABLES})


def _q03(shop):
    return Q.profile(shop.fct_pedidos).drop("posicion")


def _q04(shop):
    return Q.cost_coverage(shop.int_costos_pedido)


def _s03(shop):
    return row_counts(shop.raw)


# ---- sources and sinks: a given table is written in the form needed and read back through the operator

#: Column types of a raw table as its source declares them.
ZONE_TYPES = {"codigo": "bigint(20)", "distancia": "double", "precio": "decimal(10,2)", "demora": "int(11)", "activo": "tinyint(1)"}


def _folder(shop, name):
    return f"{table_root(shop.spark)}/{name}"


def _s01(shop):
    path = _folder(shop, "zonas")
    shop.raw["zonas"].select(*[F.col(c).cast("string").alias(c) for c in ZONE_TYPES]).write.parquet(path)
    return readers.read_raw(shop.spark, path, ZONE_TYPES)


def _order_lines(shop):
    """Orders as CSV lines; every 97th is cut short and every 101st has a word for a number."""
    o, text = shop.raw["pedidos"], lambda c: F.col(c).cast("string")
    line = (F.when(F.col("codigo") % 97 == 0, F.concat_ws(",", text("codigo"), F.lit("x")))
            .when(F.col("codigo") % 101 == 0, F.concat_ws(",", text("codigo"), F.lit("many"), text("total")))
            .otherwise(F.concat_ws(",", text("codigo"), text("cliente"), text("total"))))
    return o.repartitionByRange("codigo").sortWithinPartitions("codigo").select(line.alias("value"))


def _s02(shop):
    path = _folder(shop, "orders-csv")
    _order_lines(shop).write.text(path)
    schema = T.StructType([T.StructField("codigo", T.LongType()), T.StructField("cliente", T.LongType()),
                           T.StructField("total", T.DecimalType(12, 2))])
    good, bad = readers.read_with_quarantine(shop.spark, path, schema)
    kept = good.agg(F.count(F.lit(1)).alias("filas"), F.sum("total").alias("total"))  # one row
    return kept.crossJoin(F.broadcast(readers.quarantine_report(bad)))


def _s04(shop):
    path = _folder(shop, "euro-csv")
    v = F.col("valor_blue").cast("decimal(10,2)").cast("string")
    whole, cents = F.regexp_extract(v, r"^(\d+)", 1), F.regexp_extract(v, r"\.(\d+)$", 1)
    dotted = F.regexp_replace(whole, r"(\d)(?=(\d{3})+$)", "$1.")
    (shop.raw["dolar_blue"].select(F.date_format("fecha", "dd.MM.yyyy").alias("Fecha"), F.concat_ws(",", dotted, cents).alias("Cierre"))
     .write.option("header", True).option("quoteAll", True).csv(path))
    return readers.read_euro_csv(shop.spark, path)


def _s05(shop):
    path = _folder(shop, "seed")
    seed = shop.raw["clima_buenos_aires"]
    seed.write.option("header", True).csv(path)
    return readers.read_seed(shop.spark, path, seed.schema)


def _s06(shop):
    path = _folder(shop, "fct_ventas_diarias")
    sinks.write_clustered(shop.fct_ventas_diarias, path, "fecha")
    return readers.load_table(shop.spark, path, "fecha", "1996-01-01", "1996-12-31").select("fecha", "pedidos_totales", "venta_total")


def _exported(shop, path, names):
    """Digests of every column of the written tables, read back."""
    return Q.column_digests({n: shop.spark.read.parquet(f"{path}/{n}") for n in names})


def _s07(shop):
    path = _folder(shop, "marts")
    status = sinks.export_marts({n: shop.model(n) for n in shop.EXPORTED}, path)
    return _exported(shop, path, [n for n, s in status.items() if s == "ok"])


def _s08(shop):
    path = _folder(shop, "dated")
    names = [*shop.EXPORTED, *shop.INTERNAL, "stg_zonas"]
    status = sinks.export_all({n: shop.model(n) for n in names}, path, shop.as_of)
    return _exported(shop, f"{path}/{shop.as_of.replace('-', '')}", [n for n, s in status.items() if s == "ok"])


def _s10(shop):
    path = _folder(shop, "csv")
    sinks.write_csv(shop.stg_dolar_blue, path, "fecha", "valor_blue")
    return shop.spark.read.option("header", True).csv(path)


def _f18(shop):
    return shop.rpt_pnl.select("mes", C.money_text("resultado_operativo").alias("ars"),
                               C.money_text("resultado_operativo_usd", "U$D ").alias("usd"), C.pct_text("margen_bruto_pct").alias("pct"))


def _f19(shop):
    return _r01(shop).withColumn("horizonte", C.label_map("horizonte", RETENTION_LABELS))


def _u02(shop):
    phones = [shop.dim_mails.filter(c).select("telefono", "is_activo") for c in (F.col("tipo_identidad") == "email", F.col("tipo_identidad") != "email")]
    return union_distinct(*phones)


def _u02_not_in(shop):
    m = shop.dim_mails
    resolved = union_distinct(*[m.filter(F.col("tipo_identidad") == t).select("cliente_id") for t in ("email", "phone_bridge", "phone_only")])
    return not_in(shop.stg_clientes.select("cliente_id", "nombre"), "cliente_id", resolved)


def _w08(shop):
    canje = F.col("tipo_movimiento") == "canje"
    moves = shop.stg_puntos.select("punto_id", "fecha", "puntos", "tipo_movimiento")
    return ordered_scan(moves, ["fecha", "punto_id"], sums={"saldo": F.col("puntos")}, fills={"ultimo_canje": F.when(canje, F.col("punto_id"))},
                        lags={"puntos_previos": F.col("puntos")}).drop("tipo_movimiento")


def _w05(shop):
    lines = shop.fct_pedidos.select("pedido_id", "total")
    return ntile_by_cuts(lines, "total", "pedido_id", 10, "decil")


def _a07(shop):
    return shop.identidad_ids.select("cliente_id_mail_phone", "chunk", "position", "first_id", "n_ids",
                                     F.array_join(F.col("ids").cast("array<string>"), ", ").alias("ids"))


def _a03(level):
    return lambda shop: distinct_customers(shop.clientes_por_dia, level)


ON_SHOP: dict[str, Callable[[Shop], DataFrame]] = {
    "R01_retention_melt": _r01,
    "R02_pnl_statement": _r02(PNL_ROWS_ARS),
    "R02_pnl_statement_usd": _r02(PNL_ROWS_USD),
    "R03_pnl_waterfall": _r03,
    "R04_cash_composition": _r04,
    "R05_season_matrix": _r05,
    "R06_expense_top5_trend": _r06,
    "R07_signed_flow": _r07,
    "R08_payment_mix": _r08,
    "R09_weather_by_temperature": _r09_temp,
    "R09_weather_by_rain": _r09_rain,
    "R10_rfm_table": _r10,
    "R11_flavour_scatter": _r11,
    "R11_rfm_scatter": _r11_rfm,
    "R11_weather_scatter": _r11_weather,
    "W13_expense_ids": _w13,
    "W16_selected_period": _w16,
    "U02_union_distinct": _u02,
    "U02_unresolved_customers": _u02_not_in,
    "W08_points_balance": _w08,
    "W05_order_deciles": _w05,
    "A07_identity_id_chunks": _a07,
    "A03_customers_daily": _a03("day"),
    "A03_customers_weekly": _a03("week"),
    "A03_customers_monthly": _a03("month"),
    "A17_segment_counts": _a17,
    "A18_sales_daily": _a18("day"),
    "A18_sales_weekly": _a18("week"),
    "A18_sales_monthly": _a18("month"),
    "A19_category_margin_mean": _a19,
    "A20_sales_kpis": _a20,
    "A21_expenses_by_category": _a21,
    "A23_barrio_choices": _a23,
    "P22_order_facets": _p22,
    "P23_customer_search": _p23,
    "P23_customer_search_indexed": _p23_index,
    "P24_sales_date_window": _p24,
    "P25_sugar_free_flavours": _p25("only"),
    "P25_sugared_flavours": _p25("without"),
    "P28_margins_by_payment": _p28,
    "T02_top_customers": _t02,
    "T04_latest_pnl": _t04,
    "T05_order_preview": _t05,
    "Q01_Q02_key_checks": _q01,
    "Q03_profile_order_fact": _q03,
    "Q04_cost_coverage": _q04,
    "S01_raw_scan": _s01,
    "S02_quarantine": _s02,
    "S03_load_audit": _s03,
    "S04_euro_csv": _s04,
    "S05_seed_scan": _s05,
    "S06_mart_window": _s06,
    "S07_mart_export": _s07,
    "S08_dated_export": _s08,
    "S10_csv_sink": _s10,
    "F18_money_text": _f18,
    "F19_retention_labels": _f19,
}


# ------------------------------------------------------------------ oracle side

def _union(parts: list[str]) -> str:
    return "\nunion all\n".join(parts)


def _oracle() -> dict[str, str]:
    from conewise.sources.testdata import raw_sql
    o: dict[str, str] = {}
    o["R01_retention_melt"] = _union([
        f"select mes, '{c}' as horizonte, cast({c} as decimal(10,1)) as retencion_pct from rpt_clientes_nuevos"
        for c in RETENTION_COLS])
    for name, rows in (("R02_pnl_statement", PNL_ROWS_ARS), ("R02_pnl_statement_usd", PNL_ROWS_USD)):
        o[name] = _union([f"select mes, {i + 1} as orden, '{label}' as concepto, cast({c} as decimal(38,4)) as valor from rpt_pnl"
                          for i, (label, c) in enumerate(rows)])
    last = "(select * from rpt_pnl where mes = (select max(mes) from rpt_pnl))"
    steps = [f"select mes, {i + 1} as orden, '{label}' as paso, cast({c} * {sign} as decimal(38,2)) as valor, "
             f"'relative' as medida from {last}" for i, (label, c, sign) in enumerate(WATERFALL_STEPS)]
    steps.append(f"select mes, {len(WATERFALL_STEPS) + 1} as orden, '{WATERFALL_TOTAL[0]}' as paso, "
                 f"cast({WATERFALL_TOTAL[1]} as decimal(38,2)) as valor, 'total' as medida from {last}")
    o["R03_pnl_waterfall"] = _union(steps)
    comp = [f"select 'inflow' as lado, '{label}' as fuente, cast(coalesce(sum({c}), 0) as decimal(38,2)) as monto "
            f"from rpt_cash_flow" for label, c in INFLOW_PARTS]
    comp += [f"select * from (select 'outflow' as lado, '{label}' as fuente, "
             f"cast(coalesce(sum({c}), 0) as decimal(38,2)) as monto from rpt_cash_flow) where monto > 0"
             for label, c in OUTFLOW_PARTS]
    o["R04_cash_composition"] = _union(comp)
    o["R05_season_matrix"] = """select sabor_id, sabor, veces_pedido, pct_verano, pct_otono, pct_invierno, pct_primavera
from rpt_sabores order by veces_pedido desc nulls last, sabor_id limit 15"""
    o["R06_expense_top5_trend"] = """select mes, categoria, monto_total from rpt_egresos
where categoria in (select categoria from rpt_egresos group by categoria
                    order by sum(monto_total) desc nulls last, categoria limit 5)"""
    o["R07_signed_flow"] = "select mes, total_inflows as inflow, -total_outflows as outflow from rpt_cash_flow"
    o["R08_payment_mix"] = _union([
        f"select strftime(fecha, '%Y-%m') as mes_str, '{label}' as medio_pago, sum({c}) as pedidos "
        f"from fct_ventas_diarias group by 1"
        for label, c in [("Efectivo", "pagos_efectivo"), ("MercadoPago", "pagos_mercadopago"),
                         ("Transferencia", "pagos_transferencia")]])
    wd = ("(select *, " + D("kg_totales / nullif(pedidos_totales, 0)", 16)
          + " as kg_por_pedido from fct_ventas_diarias where temperatura_promedio is not null)")

    def mean(c: str) -> str:
        if c in ("kg_totales", "venta_total_usd"):
            return f"round({AVG(c)}, 1)"
        if c == "kg_por_pedido":
            return "round(cast(avg(kg_por_pedido) as decimal(38,6)), 1)"
        return f"round(avg({c}), 1)"
    o["R11_weather_scatter"] = _union([
        f"select fecha, temperatura_promedio, estacion, '{m}' as metrica, cast({m} as decimal(38,4)) as valor from {wd}"
        for m in SCATTER_METRICS])
    o["R09_weather_by_temperature"] = (
        "select categoria_temperatura, count(fecha) as dias, "
        + ", ".join(f"{mean(c)} as {c}_prom" for c in TEMP_MEANS)
        + f" from {wd} group by categoria_temperatura")
    o["R09_weather_by_rain"] = (
        "select categoria_precipitacion, count(fecha) as dias, "
        + ", ".join(f"{mean(c)} as {c}_prom" for c in RAIN_MEANS)
        + f" from {wd} group by categoria_precipitacion")
    o["R10_rfm_table"] = f"select {', '.join(RFM_TABLE_COLS)} from rpt_rfm"
    o["R11_flavour_scatter"] = """select sabor_id, sabor, categoria, kg_vendidos, margen_estimado_por_kg_usd, veces_pedido
from rpt_sabores order by kg_vendidos desc nulls last, sabor_id limit 50"""
    o["R11_rfm_scatter"] = """select frecuencia_score as x, monetario_score as y, cliente_id_mail_phone, nombre, total_pedidos,
kg_total, segmento_cliente from rpt_rfm"""
    o["W13_expense_ids"] = "select egreso_id, fecha, descripcion, categoria, monto from egresos_numerados"
    start, end = SELECTED_PERIOD
    o["W16_selected_period"] = f"""select mes, {', '.join(RUNNING)},
{', '.join(f'sum({c}) over (order by mes) as {n}' for c, n in RUNNING.items())}
from rpt_cash_flow where mes between date '{start}' and date '{end}'"""
    o["A17_segment_counts"] = """select segmento_cliente, count(*) as clientes from dim_clientes
where segmento_cliente is not null group by segmento_cliente"""
    sums = ", ".join(f"sum({c}) as {c}" for c in SALES_SUMS)
    o["A18_sales_daily"] = f"select fecha as periodo, {sums} from fct_ventas_diarias group by 1"
    o["A18_sales_weekly"] = (f"select cast(date_trunc('week', fecha) as date) as periodo, {sums} "
                             f"from fct_ventas_diarias group by 1")
    o["A18_sales_monthly"] = (f"select cast(date_trunc('month', fecha) as date) as periodo, {sums} "
                              f"from fct_ventas_diarias group by 1")
    o["A19_category_margin_mean"] = f"""select categoria, round({AVG('margen_pct')}, 2) as margen_pct_prom,
sum(kg_vendidos) as kg_vendidos, sum(ingreso_estimado) as ingreso_estimado
from rpt_productos_vendidos group by categoria"""
    o["A20_sales_kpis"] = """select count(*) as dias, sum(pedidos_totales) as pedidos, sum(kg_totales) as kg,
sum(venta_total) as venta, sum(venta_total_usd) as venta_usd, max(clientes_unicos) as clientes_dia_max
from fct_ventas_diarias"""
    o["A21_expenses_by_category"] = ("select categoria, sum(monto_total) as monto_total "
                                     "from rpt_egresos group by categoria")
    o["A23_barrio_choices"] = "select distinct barrio from dim_clientes where barrio is not null"
    o["P22_order_facets"] = """select pedido_id, tipo_retiro, tipo_pago, estado_nombre, total from fct_pedidos
where tipo_retiro in ('delivery', 'local') and tipo_pago is not null and estado_nombre is not null"""
    o["P23_customer_search"] = """select cliente_id_mail_phone, nombre, segmento_cliente, total_gastado
from dim_clientes where segmento_cliente is not null and coalesce(regexp_matches(nombre, '#0+1', 'i'), false)"""
    o["P23_customer_search_indexed"] = f"""select cliente_id_mail_phone, nombre, segmento_cliente, total_gastado
from dim_clientes where coalesce(regexp_matches(nombre, '{INDEXED_PATTERN}', 'i'), false)"""
    o["P24_sales_date_window"] = """select fecha, pedidos_totales, venta_total from fct_ventas_diarias
where fecha >= date '1996-01-01' and fecha <= date '1997-12-31'"""
    o["P25_sugar_free_flavours"] = ("select sabor_id, sabor, veces_pedido, kg_vendidos from rpt_sabores "
                                    "where is_sin_azucar = 1")
    o["P25_sugared_flavours"] = ("select sabor_id, sabor, veces_pedido, kg_vendidos from rpt_sabores "
                                 "where is_sin_azucar = 0")
    o["P28_margins_by_payment"] = ("select mes, dimension_valor, pedidos, venta_total, margen_pct from rpt_margenes "
                                   "where dimension_tipo = 'tipo_pago'")
    o["T02_top_customers"] = """select cliente_id_mail_phone, nombre, total_pedidos, total_gastado from dim_clientes
order by total_gastado desc nulls last, cliente_id_mail_phone limit 20"""
    o["T04_latest_pnl"] = "select * from rpt_pnl where mes = (select max(mes) from rpt_pnl)"
    o["T05_order_preview"] = "select pedido_id, fecha, total from fct_pedidos order by pedido_id limit 3"
    o["Q01_Q02_key_checks"] = _union([
        f"""select '{t}' as tabla, '{k}' as clave, count(*) as filas,
  (select count(*) from (select {k} from {t} where {k} is not null group by {k} having count(*) > 1)) as claves_duplicadas,
  count(*) - count({k}) as claves_nulas from {t}"""
        for t, k in Q.KEYED_TABLES.items()])
    o["Q04_cost_coverage"] = """select mes, count(*) as pedidos, sum(total_lineas_sabor) as lineas_sabor,
sum(sabores_con_costo) as sabores_con_costo, sum(sabores_con_promedio) as sabores_con_promedio,
count(*) filter (where sabores_con_promedio > 0) as pedidos_con_promedio
from int_costos_pedido group by mes"""
    o["S03_load_audit"] = _union([f"select '{n}' as tabla, count(*) as filas from raw_{n}"
                                  for n in raw_sql("duckdb")])
    o["S01_raw_scan"] = f"select {', '.join(ZONE_TYPES)} from raw_zonas"
    o["S02_quarantine"] = """select count(*) filter (not mala) as filas, sum(total) filter (not mala) as total,
count(*) filter (mala) as errores, (select string_agg(linea, chr(10) order by codigo) from (
  select codigo, if(codigo % 97 = 0, concat_ws(',', codigo, 'x'), concat_ws(',', codigo, 'many', total)) as linea
  from raw_pedidos where codigo % 97 = 0 or codigo % 101 = 0 order by codigo limit 3)) as primeros
from (select total, codigo % 97 = 0 or codigo % 101 = 0 as mala from raw_pedidos)"""
    o["S04_euro_csv"] = "select fecha, valor_blue from raw_dolar_blue"
    o["S05_seed_scan"] = "select * from raw_clima_buenos_aires"
    o["S06_mart_window"] = """select fecha, pedidos_totales, venta_total from fct_ventas_diarias
where fecha between date '1996-01-01' and date '1996-12-31'"""
    o["S07_mart_export"] = _union([_digest_sql(n) for n in Shop.EXPORTED])
    o["S08_dated_export"] = _union([_digest_sql(n) for n in [*Shop.EXPORTED, *Shop.INTERNAL]])
    o["S10_csv_sink"] = """select strftime(fecha, '%Y-%m-%d') as fecha, cast(cast(valor_blue as decimal(38,2)) as varchar) as valor_blue
from stg_dolar_blue"""

    def money(c: str, prefix: str) -> str:
        return f"""case when coalesce({c}, 0) = 0 then '{prefix}0'
  when abs({c}) >= 1000000 then '{prefix}' || format('{{:,.1f}}', {c}::double / 1000000) || 'M'
  when abs({c}) >= 1000 then '{prefix}' || format('{{:,.1f}}', {c}::double / 1000) || 'K'
  else '{prefix}' || format('{{:,.0f}}', {c}::double) end"""
    o["F18_money_text"] = f"""select mes, {money('resultado_operativo', '$')} as ars, {money('resultado_operativo_usd', 'U$D ')} as usd,
coalesce(format('{{:.1f}}', margen_bruto_pct::double) || '%', '—') as pct from rpt_pnl"""
    o["F19_retention_labels"] = _union([
        f"select mes, '{RETENTION_LABELS[c]}' as horizonte, cast({c} as decimal(10,1)) as retencion_pct from rpt_clientes_nuevos"
        for c in RETENTION_COLS])
    o["Q03_profile_order_fact"] = _profile_sql()
    o["U02_union_distinct"] = """select telefono, is_activo from dim_mails where tipo_identidad = 'email'
union select telefono, is_activo from dim_mails where tipo_identidad <> 'email'"""
    o["U02_unresolved_customers"] = """select cliente_id, nombre from stg_clientes where cliente_id not in (
select cliente_id from dim_mails where tipo_identidad in ('email', 'phone_bridge', 'phone_only'))"""
    o["W08_points_balance"] = """select punto_id, fecha, puntos, sum(puntos) over w as saldo,
last_value(case when tipo_movimiento = 'canje' then punto_id end ignore nulls) over w as ultimo_canje, lag(puntos) over (order by fecha, punto_id) as puntos_previos
from stg_puntos window w as (order by fecha, punto_id rows between unbounded preceding and current row)"""
    o["W05_order_deciles"] = "select pedido_id, total, ntile(10) over (order by total nulls last, pedido_id) as decil from fct_pedidos"
    o["A07_identity_id_chunks"] = """select cliente_id_mail_phone, chunk, cast(sum(n_ids) over w - n_ids as bigint) as position, first_id, n_ids, ids
from (select cliente_id_mail_phone, cast(floor(c.cliente_id / 100000) as bigint) as chunk, min(c.cliente_id) as first_id,
        count(*) as n_ids, string_agg(cast(c.cliente_id as varchar), ', ' order by c.cliente_id) as ids
      from dim_mails join stg_clientes c using (cliente_id) where cliente_id_mail_phone is not null group by 1, 2)
window w as (partition by cliente_id_mail_phone order by chunk)"""
    for level in ("day", "week", "month"):
        o[f"A03_customers_{dict(day='daily', week='weekly', month='monthly')[level]}"] = f"""select cast(date_trunc('{level}', fecha) as date) as periodo,
count(distinct cliente_id) as clientes_unicos from fct_pedidos where estado_id = {DELIVERED} and cliente_id is not null group by 1"""
    return o


def _digest_sql(table: str) -> str:
    """``quality.column_digests`` of one table."""
    return f"""select '{table}' as tabla, columna, count(*) as filas, count(valor) as valores,
  cast(coalesce(sum(cast('0x' || substr(md5(valor), 1, 8) as bigint)), 0) as bigint) as suma
from (select case when regexp_matches(typeof(columns(*)), 'INT|DECIMAL|DOUBLE|FLOAT')
        then try_cast(columns(*)::varchar as decimal(38,6))::varchar else columns(*)::varchar end from {table})
unpivot include nulls (valor for columna in (columns(*))) group by columna"""


#: The order fact's columns in order, with their kinds.
FACT_COLUMNS = {
    "entero": ["pedido_id", "cliente_id", "cliente_id_mail_phone", "direccion_id", "anio", "mes_num", "dia_semana", "hora", "estado_id",
               "is_pagado", "is_activo", "demora_minutos", "cantidad_productos", "cantidad_sabores"],
    "numero": ["costo_envio_zona", "subtotal", "descuento", "descuento_ajuste", "costo_envio", "redondeo", "total", "mp_monto_transaccion",
               "mp_monto_neto_recibido", "mp_comision", "distancia_km", "kg_total", "costo_ingredientes", "costo_potes", "costo_bolsa",
               "costo_total", "contribucion_mg", "margen_pct", "total_usd", "costo_total_usd", "contribucion_mg_usd"],
    "fecha": ["created_at", "fecha", "semana", "mes"],
    "logico": ["is_primer_pedido"],
    "texto": ["cliente_nombre", "cliente_email", "cliente_telefono", "barrio", "direccion", "estacion", "temporada", "horario", "tipo_retiro",
              "tipo_pago", "mercadopago_id", "mercadopago_status", "estado_nombre", "repartidor", "comentario", "motivo_cancelacion"],
}


def _profile_sql() -> str:
    parts, width = [], sum(map(len, FACT_COLUMNS.values()))
    for kind, names in FACT_COLUMNS.items():
        for c in names:
            low, high = (f"min({c})::double", f"max({c})::double") if kind in ("entero", "numero") else ("null::double",) * 2
            since, until = (f"min({c})::timestamp", f"max({c})::timestamp") if kind == "fecha" else ("null::timestamp",) * 2
            values = f"if(count(distinct {c}) between 1 and 10, array_to_string(list_sort(list(distinct {c})), ', '), null)" if kind == "texto" else "null"
            parts.append(f"""select '{c}' as columna, '{kind}' as tipo, count(*) as filas, {width} as columnas,
  count(*) - count({c}) as nulos, count(distinct {c}) as distintos, {low} as minimo, {high} as maximo, {since} as desde, {until} as hasta, {values}::varchar as valores
from fct_pedidos""")
    return _union(parts)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: _on_shop(fn) for k, fn in ON_SHOP.items()}


def oracle_sql() -> dict[str, str]:
    return _oracle()
