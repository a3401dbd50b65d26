"""Query registry: inventory ID -> Spark job and DuckDB oracle SQL.

Every job reads the driver's test tables under ``sf_dir`` (through the
bindings in ``sources.testdata``) and runs over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conewise.plans.warehouse import Shop

# inventory ID -> (Shop model attribute, oracle CTE name)
MODELS: dict[str, tuple[str, str]] = {
    "D01_identity_resolution": ("dim_mails", "dim_mails"),
    "D02_customer_profile": ("int_clientes", "int_clientes"),
    "D03_flavour_cost_lookup": ("stg_costos_sabores", "stg_costos_sabores"),
    "D04_order_cost": ("int_costos_pedido", "int_costos_pedido"),
    "D05_first_order": ("int_primer_pedido", "int_primer_pedido"),
    "D06_order_fact": ("fct_pedidos", "fct_pedidos"),
    "D07_order_wide": ("int_pedidos", "int_pedidos"),
    "D08_daily_sales_base": ("int_ventas_diarias", "int_ventas_diarias"),
    "D09_daily_sales_fact": ("fct_ventas_diarias", "fct_ventas_diarias"),
    "D10_weather_classes": ("int_clima", "int_clima"),
    "D11_fx_daily": ("stg_dolar_blue", "stg_dolar_blue"),
    "D12_fx_monthly": ("fx_monthly", "fx_m"),
    "D13_customer_dimension": ("dim_clientes", "dim_clientes"),
    "D14_rfm_report": ("rpt_rfm", "rpt_rfm"),
    "D15_cohort_retention": ("rpt_clientes_nuevos", "rpt_clientes_nuevos"),
    "D16_pnl_monthly": ("rpt_pnl", "rpt_pnl"),
    "D17_cash_flow_monthly": ("rpt_cash_flow", "rpt_cash_flow"),
    "D18_expenses_yoy": ("rpt_egresos", "rpt_egresos"),
    "D19_margin_breakdown": ("rpt_margenes", "rpt_margenes"),
    "D20_product_ranking": ("rpt_productos_vendidos", "rpt_productos_vendidos"),
    "D21_flavour_ranking": ("rpt_sabores", "rpt_sabores"),
    "D22_flavour_popularity": ("rpt_sabores_populares", "rpt_sabores_populares"),
    "D23_loyalty_points": ("rpt_puntos", "rpt_puntos"),
    "D24_zone_delivery": ("rpt_zonas", "rpt_zonas"),
    "D25_products_weight": ("stg_productos", "stg_productos"),
    "D26_register_daily": ("stg_registro_diario", "stg_registro_diario"),
}


def normalize(df: DataFrame) -> DataFrame:
    """Report exact decimals as DOUBLE and every integer as BIGINT (same as the oracle)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _model_query(attr: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return normalize(Shop.from_test_tables(spark, sf_dir).model(attr))
    run.__name__ = f"q_{attr}"
    return run


def _normalized(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return normalize(fn(spark, sf_dir))
    run.__name__ = getattr(fn, "__name__", "q")
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {k: _model_query(attr) for k, (attr, _) in MODELS.items()}
    from conewise import catalog
    for k, fn in catalog.queries().items():
        out[k] = _normalized(fn)
    return out


def oracle_sql() -> dict[str, str]:
    from conewise import catalog
    from conewise.oracle import finalize
    from conewise.oracle.models_sql import prefix
    pre = prefix()
    out = {k: finalize(f"{pre}\nselect * from {cte}") for k, (_, cte) in MODELS.items()}
    for k, sql in catalog.oracle_sql().items():
        out[k] = finalize(f"{pre}\n{sql}")
    return out
