"""Invariants of the marts on the sf0.001 warehouse."""
from pyspark.sql import functions as F


def test_identity_partitions_customers(shop):
    ids = shop.dim_mails
    assert ids.count() == shop.stg_clientes.count()
    assert ids.select("cliente_id").distinct().count() == ids.count()
    kinds = {r.tipo_identidad for r in ids.select("tipo_identidad").distinct().collect()}
    assert kinds <= {"email", "phone_bridge", "phone_only", "sin_identidad"}
    bad = ids.filter(((F.col("tipo_identidad") == "sin_identidad") != F.col("cliente_id_mail_phone").isNull()))
    assert bad.count() == 0


def test_fx_spine_continuous(shop):
    fx = shop.stg_dolar_blue
    r = fx.agg(F.min("fecha").alias("lo"), F.max("fecha").alias("hi"), F.count(F.lit(1)).alias("n"),
               F.count_if(F.col("valor_blue").isNull()).alias("nulls")).collect()[0]
    assert (r.hi - r.lo).days + 1 == r.n and r.nulls == 0


def test_shares_sum_to_100(shop):
    s = shop.rpt_productos_vendidos.agg(F.sum("porcentaje_del_total")).collect()[0][0]
    assert abs(float(s) - 100.0) < 0.5


def test_cash_running_total(shop):
    cf = shop.rpt_cash_flow.orderBy("mes").collect()
    run = 0
    for r in cf:
        run += r.flujo_neto
        assert r.flujo_neto_acumulado == run


def test_breakdown_parts_equal_overall(shop):
    m = shop.rpt_margenes
    overall = {r.mes: r.pedidos for r in m.filter("dimension_tipo = 'overall'").collect()}
    for dim in ("tipo_retiro", "tipo_pago"):
        parts = {r.mes: r.p for r in m.filter(F.col("dimension_tipo") == dim).groupBy("mes")
                 .agg(F.sum("pedidos").alias("p")).collect()}
        assert parts == overall


def test_pnl_identity(shop):
    for r in shop.rpt_pnl.collect():
        assert r.resultado_operativo == (r.ingresos_totales - r.gasto_insumos - r.total_gastos_operativos
                                         - r.total_comisiones - r.costo_delivery)


def test_identities_grow_with_customers_and_have_one_hot_key(shop):
    sizes = shop.dim_mails.filter("cliente_id_mail_phone is not null").groupBy("cliente_id_mail_phone").count()
    customers = shop.stg_clientes.count()
    assert sizes.count() >= customers / 10


def test_scans_of_raw_tables_are_pruned(shop):
    plan = shop.stg_productos.filter("is_activo = 1").select("producto_id")._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryTableScan" not in plan and "ReadSchema: struct<codigo:bigint,activo:int>" in plan and "EqualTo(activo,1)" in plan


def test_tables_are_shared_by_input_and_removed_on_close(spark, shop):
    from conewise.plans.warehouse import Shop
    from conewise.sources.sinks import _path
    other = Shop.from_test_tables(spark, "/root/testdata/sf0.001")
    assert other.root == shop.root
    own = Shop.from_test_tables(spark, "/root/testdata/sf0.001", fresh=True)
    own.line_flavours.count()
    fs, folder = _path(spark, own.root)
    assert own.root != shop.root and fs.exists(folder)
    own.close()
    assert not fs.exists(folder)
