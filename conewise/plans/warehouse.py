"""The model graph wired together: one lazily built DataFrame per model.

``Shop`` takes the raw tables and seeds (any source: the test bindings,
``sources.readers.read_raw`` over a dump, or CSV seeds) and exposes every staging,
intermediate and mart model as an attribute.  Each model is built once per
``Shop`` and shared by its consumers, so one Spark plan reuses the same
sub-plan (and its exchanges) instead of re-deriving it per consumer.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from conewise.operators import trigrams
from conewise.plans import cost, customers, facts, finance, identity, ranking, staging
from conewise.sources.sinks import input_root, materialise_once, remove_folder, table_root


def table(fn):
    """A model materialised as a table (Parquet in the shared folder) when the
    warehouse is built with ``tables=True``; otherwise a lazy view."""
    name = fn.__name__

    def build(self):
        if not self.tables:
            return fn(self)
        return materialise_once(lambda: fn(self), self.spark, f"{self.root}/{name}")

    build.__name__ = name
    build.__doc__ = fn.__doc__
    return cached_property(build)


class Shop:
    """``tables=True`` writes the shared intermediates and the facts once
    (identity, line flavours, first order, cost, order fact, customer dimension,
    daily fact), so each consumer starts from files instead of re-deriving them.
    Staging models stay views: they are projections of a scan.

    ``root`` is the folder of the tables.  Shops over the same input in one
    session share it and build each table once; ``close()`` removes it."""

    def __init__(self, raw: Mapping[str, DataFrame], as_of: str, points_as_of: str | None = None,
                 tables: bool = True, root: str | None = None, spark: SparkSession | None = None):
        self.raw = raw
        self.as_of = as_of
        self.points_as_of = points_as_of or as_of
        self.tables = tables
        self._spark, self._root = spark, root

    @property
    def spark(self) -> SparkSession:
        return self._spark or next(iter(self.raw.values())).sparkSession

    @property
    def root(self) -> str:
        if self._root is None:
            self._root = table_root(self.spark)
        return self._root

    def close(self) -> None:
        """Remove the tables; the shop builds them anew if asked again."""
        remove_folder(self.spark, self.root)
        for name in [n for n, v in vars(type(self)).items() if isinstance(v, cached_property)]:
            self.__dict__.pop(name, None)

    @classmethod
    def from_test_tables(cls, spark: SparkSession, sf_dir: str, as_of: str = "2001-09-01",
                         points_as_of: str = "2024-02-01", tables: bool = True, fresh: bool = False) -> Shop:
        from conewise.sources.testdata import raw_tables
        root = table_root(spark) if fresh else input_root(spark, sf_dir, "shop", as_of, points_as_of)
        return cls(raw_tables(spark, sf_dir), as_of, points_as_of, tables, root, spark)

    # ------------------------------------------------------------ staging
    @cached_property
    def stg_pedidos(self): return staging.stg_pedidos(self.raw["pedidos"])  # noqa: E704

    @cached_property
    def stg_pedidos_productos(self): return staging.stg_pedidos_productos(self.raw["pedidos_productos"])  # noqa: E704

    @cached_property
    def stg_pedidos_productos_sabores(self):  # noqa: E704
        return staging.stg_pedidos_productos_sabores(self.raw["pedidos_productos_sabores"])

    @cached_property
    def stg_clientes(self): return staging.stg_clientes(self.raw["clientes"])  # noqa: E704

    @cached_property
    def stg_clientes_direcciones(self):  # noqa: E704
        return staging.stg_clientes_direcciones(self.raw["clientes_direcciones"])

    @cached_property
    def stg_productos(self): return staging.stg_productos(self.raw["productos"])  # noqa: E704

    @cached_property
    def stg_productos_categorias(self): return staging.stg_categorias(self.raw["productos_categorias"])  # noqa: E704

    @cached_property
    def stg_sabores(self): return staging.stg_sabores(self.raw["sabores"])  # noqa: E704

    @cached_property
    def stg_sabores_categorias(self): return staging.stg_categorias(self.raw["sabores_categorias"])  # noqa: E704

    @cached_property
    def stg_zonas(self): return staging.stg_zonas(self.raw["zonas"])  # noqa: E704

    @cached_property
    def stg_delivery(self): return staging.stg_delivery(self.raw["delivery"])  # noqa: E704

    @cached_property
    def stg_clima(self): return staging.stg_clima(self.raw["clima_buenos_aires"])  # noqa: E704

    @cached_property
    def stg_costos_sabores(self):  # noqa: E704
        return staging.stg_costos_sabores(self.raw["costos_sabores"], self.stg_sabores)

    @cached_property
    def stg_dolar_blue(self): return staging.stg_dolar_blue(self.raw["dolar_blue"])  # noqa: E704

    @cached_property
    def stg_egresos(self): return staging.stg_egresos(self.raw["egresos"])  # noqa: E704

    @cached_property
    def stg_puntos(self):  # noqa: E704
        return staging.stg_puntos(self.raw["puntos"], self.raw["points_clientes"], self.points_as_of)

    @cached_property
    def stg_registro_diario(self): return staging.stg_registro_diario(self.raw["registro_diario_ventas"])  # noqa: E704

    # ------------------------------------------------------------ intermediate
    @table
    def dim_mails(self): return identity.resolve_identity(self.stg_clientes, self.stg_pedidos)  # noqa: E704

    @cached_property
    def int_clima(self): return facts.weather_classes(self.stg_clima)  # noqa: E704

    @table
    def int_primer_pedido(self): return facts.first_order(self.stg_pedidos, self.dim_mails)  # noqa: E704

    @table
    def line_flavours(self):  # noqa: E704
        return cost.line_flavours(self.stg_pedidos_productos, self.stg_pedidos_productos_sabores, self.stg_productos)

    @table
    def int_costos_pedido(self):  # noqa: E704
        return cost.order_cost(self.stg_pedidos, self.stg_pedidos_productos, self.line_flavours,
                               self.stg_productos, self.stg_costos_sabores)

    @table
    def identidad_ids(self): return customers.identity_ids(self.stg_clientes, self.dim_mails)  # noqa: E704

    @table
    def int_clientes(self):  # noqa: E704
        return customers.customer_profile(self.stg_clientes, self.dim_mails, self.stg_clientes_direcciones,
                                          self.stg_zonas, self.identidad_ids)

    @cached_property
    def fx_monthly(self): return facts.fx_monthly(self.stg_dolar_blue)  # noqa: E704

    # ------------------------------------------------------------ marts
    @table
    def fct_pedidos(self):  # noqa: E704
        return facts.order_fact(self.stg_pedidos, self.stg_clientes, self.stg_clientes_direcciones, self.stg_zonas,
                                self.stg_pedidos_productos, self.line_flavours, self.stg_productos,
                                self.int_costos_pedido, self.stg_dolar_blue, self.int_primer_pedido, self.dim_mails)

    @cached_property
    def int_ventas_diarias(self):  # noqa: E704
        return facts.daily_sales_base(self.fct_pedidos, self.stg_registro_diario)

    @table
    def fct_ventas_diarias(self):  # noqa: E704
        return facts.daily_sales_fact(self.int_ventas_diarias, self.int_clima, self.stg_dolar_blue, self.fct_pedidos)

    @table
    def dim_clientes(self):  # noqa: E704
        return customers.customer_dimension(self.stg_clientes, self.dim_mails, self.stg_clientes_direcciones,
                                            self.fct_pedidos, self.as_of, self.identidad_ids)

    @cached_property
    def int_pedidos(self):  # noqa: E704
        return facts.order_wide(self.fct_pedidos, self.int_clima, self.int_clientes, self.dim_mails,
                                self.dim_clientes, self.stg_clientes_direcciones, self.stg_zonas)

    @table
    def clientes_por_dia(self): return facts.customers_by_day(self.fct_pedidos)  # noqa: E704

    @table
    def nombres_trigramas(self): return trigrams.postings(self.dim_clientes, "cliente_id_mail_phone", "nombre")  # noqa: E704

    @table
    def egresos_por_mes(self): return finance.expenses_by_month(self.stg_egresos)  # noqa: E704

    @cached_property
    def rpt_rfm(self): return customers.rfm_report(self.dim_clientes)  # noqa: E704

    @cached_property
    def rpt_clientes_nuevos(self):  # noqa: E704
        return customers.cohort_retention(self.int_primer_pedido, self.fct_pedidos)

    @cached_property
    def rpt_pnl(self):  # noqa: E704
        return finance.pnl_monthly(self.fct_ventas_diarias, self.egresos_por_mes, self.fx_monthly)

    @cached_property
    def rpt_cash_flow(self):  # noqa: E704
        return finance.cash_flow_monthly(self.fct_ventas_diarias, self.egresos_por_mes, self.fx_monthly)

    @cached_property
    def rpt_egresos(self): return finance.expenses_yoy(self.egresos_por_mes, self.fx_monthly)  # noqa: E704

    @cached_property
    def rpt_margenes(self): return finance.margin_breakdown(self.fct_pedidos, self.fx_monthly)  # noqa: E704

    @cached_property
    def rpt_productos_vendidos(self):  # noqa: E704
        return ranking.product_ranking(self.stg_pedidos_productos, self.stg_pedidos, self.stg_productos,
                                       self.stg_productos_categorias, self.stg_costos_sabores, self.stg_dolar_blue)

    @cached_property
    def rpt_sabores(self):  # noqa: E704
        return ranking.flavour_ranking(self.line_flavours, self.stg_pedidos, self.stg_costos_sabores,
                                       self.stg_sabores, self.stg_sabores_categorias, self.stg_dolar_blue)

    @cached_property
    def rpt_sabores_populares(self):  # noqa: E704
        return ranking.flavour_popularity(self.line_flavours, self.stg_pedidos, self.stg_sabores,
                                          self.stg_sabores_categorias)

    @cached_property
    def rpt_puntos(self):  # noqa: E704
        return customers.loyalty_points(self.stg_puntos, self.dim_mails, self.dim_clientes, self.points_as_of)

    @cached_property
    def rpt_zonas(self):  # noqa: E704
        return ranking.zone_delivery(self.fct_pedidos, self.stg_clientes_direcciones, self.stg_zonas)

    @cached_property
    def egresos_numerados(self): return staging.with_expense_ids(self.stg_egresos)  # noqa: E704

    # The marts exported for reports.
    EXPORTED = ["fct_ventas_diarias", "fct_pedidos", "dim_clientes", "rpt_productos_vendidos", "rpt_sabores",
                "rpt_pnl", "rpt_cash_flow", "rpt_egresos", "rpt_rfm", "rpt_margenes", "rpt_puntos", "rpt_zonas",
                "rpt_clientes_nuevos"]
    #: Relations of the dated export besides the marts: all that are not staging.
    INTERNAL = ["dim_mails", "int_clientes", "int_clima", "int_costos_pedido", "int_pedidos", "int_primer_pedido",
                "int_ventas_diarias", "rpt_sabores_populares"]

    def model(self, name: str) -> DataFrame:
        return getattr(self, name)
