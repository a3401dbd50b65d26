"""Shape of the plans behind the order and daily facts: what a shuffle carries and what is done once."""

from pyspark.sql import functions as F

from conewise.operators.bitmaps import id_bitmaps
from conewise.operators.dealing import deal
from conewise.plans import cost, facts, ranking
from conewise.sources.testdata import RawTables


def optimised(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_order_fact_aggregates_its_lines_once(shop):
    df = facts.order_fact(shop.stg_pedidos, shop.stg_clientes, shop.stg_clientes_direcciones, shop.stg_zonas,
                          shop.stg_pedidos_productos, shop.line_flavours, shop.stg_productos, shop.int_costos_pedido,
                          shop.stg_dolar_blue, shop.int_primer_pedido, shop.dim_mails)
    assert optimised(df).count("count(distinct sabor_id") == 1
    assert df.count() == shop.stg_pedidos.count()


def test_order_wide_joins_its_customers_once(shop):
    df = facts.order_wide(shop.fct_pedidos, shop.int_clima, shop.int_clientes, shop.dim_mails, shop.dim_clientes,
                          shop.stg_clientes_direcciones, shop.stg_zonas)
    assert optimised(df).count("FullOuter") == 2  # the customers of hot keys and the others
    assert df.count() == shop.fct_pedidos.count()


def test_daily_sums_are_not_carried_per_customer(shop):
    df = facts.daily_sales_fact(shop.int_ventas_diarias, shop.int_clima, shop.stg_dolar_blue, shop.fct_pedidos)
    assert "count(distinct cliente_id" not in optimised(df)
    want = {r["fecha"]: r["n"] for r in shop.fct_pedidos.filter("estado_id = 3").groupBy("fecha")
            .agg(F.countDistinct("cliente_id").alias("n")).collect()}
    assert {r["fecha"]: r["clientes_unicos"] for r in df.collect() if r["clientes_unicos"]} == want


LINES = "pedido_producto_id long, pedido_id long, producto_id long"
FLAVOURS = "pedido_producto_id long, sabor_id long"


def test_line_flavours_deal_their_rows_once(spark):
    lines = spark.createDataFrame([(1, 10, 5), (2, 10, 6), (2, 10, 6), (3, 11, None), (None, 12, 5), (4, None, 5)], LINES)
    flavours = spark.createDataFrame([(1, 7), (1, 8), (1, 8), (2, 7), (2, None), (3, 9), (None, 7), (4, 7), (5, 7)], FLAVOURS)
    products = spark.createDataFrame([(5, "1.00"), (6, "0.25")], "producto_id long, peso string").selectExpr(
        "producto_id", "cast(peso as decimal(4,2)) as peso_kg")
    df = cost.line_flavours(lines, flavours, products)
    assert "Aggregate" not in optimised(df)  # the count per line needs no shuffle beside the join's
    assert df.columns == ["pedido_id", "pedido_producto_id", "sabor_id", "peso_kg", "sabores_en_producto"]
    got = sorted(((r[0], r[1], r[2], None if r[3] is None else float(r[3]), r[4]) for r in df.collect()), key=str)
    twice = [(10, 2, 7, 0.25, 2), (10, 2, None, 0.25, 2)]
    assert got == sorted([(10, 1, 7, 1.0, 3), (10, 1, 8, 1.0, 3), (10, 1, 8, 1.0, 3), *twice, *twice,
                          (11, 3, 9, None, 1), (None, 4, 7, 1.0, 1)], key=str)


def test_flavour_ranking_counts_orders_where_they_lie(spark, shop):
    kg = "cast(peso as decimal(4,2)) as peso_kg"
    lf = spark.createDataFrame([(1, 1, 7, "1.00", 3), (1, 2, 7, "0.25", 2), (1, 2, 7, "0.25", 2), (2, 3, 7, "0.50", 1), (3, 4, 7, "1.00", 1),
                                (2, 3, 8, "0.50", 0), (None, 5, 8, "1.00", 1), (2, 6, None, "1.00", 1), (4, 7, 8, None, 1), (4, 7, 8, "0.00", 1)],
                               "pedido_id long, pedido_producto_id long, sabor_id long, peso string, sabores_en_producto long"
                               ).selectExpr("pedido_id", "pedido_producto_id", "sabor_id", kg, "sabores_en_producto")
    orders = spark.createDataFrame([(1, 3, "2000-01-05"), (1, 3, "2000-07-05"), (2, 3, None), (3, 2, "2000-01-05"), (4, 3, "2000-01-05")],
                                   "pedido_id long, estado_id int, dia string").selectExpr("pedido_id", "estado_id", "cast(dia as timestamp) as created_at")
    df = ranking.flavour_ranking(lf, orders, shop.stg_costos_sabores, shop.stg_sabores, shop.stg_sabores_categorias, shop.stg_dolar_blue)
    got = {r["sabor_id"]: (r["veces_pedido"], r["pedidos_distintos"], None if r["kg_vendidos"] is None else float(r["kg_vendidos"]),
                           float(r["pct_verano"]), float(r["pct_invierno"])) for r in df.collect()}
    # order 1 is there twice, in summer and winter: 3 rows each; order 2 has no date
    assert got == {7: (7, 2, 1.67, 42.9, 42.9), 8: (1, 1, None, 0.0, 0.0)}


def test_a_flavour_ranking_has_no_distinct_count_among_its_sums(shop, monkeypatch):
    seen = []
    monkeypatch.setattr(ranking, "global_row_number", lambda df, *a: seen.append(optimised(df)) or df.withColumn("ranking", F.lit(1)))
    ranking.flavour_ranking(shop.line_flavours, shop.stg_pedidos, shop.stg_costos_sabores, shop.stg_sabores,
                            shop.stg_sabores_categorias, shop.stg_dolar_blue)
    assert "distinct pedido_id" not in seen[0]


def test_parts_follow_the_rows(spark):
    df = deal(spark.range(1000), ["id"], 1000, 10)
    assert df.rdd.getNumPartitions() == max(100, spark.sparkContext.defaultParallelism) and df.count() == 1000
    assert deal(spark.range(0), ["id"], 0).count() == 0


def test_order_lines_are_grouped_where_they_were_dealt(spark, tmp_path):
    rows = [(1, 1, 9, "1995-01-03"), (1, 1, 4, "1995-01-02"), (1, 2, 5, "1995-01-01"), (None, 1, 6, "1995-01-01"), (None, 1, 7, None)]
    (spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, dia string")
     .selectExpr("l_orderkey", "l_linenumber", "l_partkey", "cast(dia as timestamp) as l_shipdate").write.parquet(f"{tmp_path}/lineitem.parquet"))
    got = RawTables(spark, str(tmp_path))["pedidos_productos"].select("codigo", "id_pedido", "id_producto", "fecha_sys").collect()
    day = 86400
    assert sorted(map(tuple, got), key=str) == sorted([(9, 1, 4, 9132 * day), (10, 1, 5, 9131 * day), (None, None, 6, 9131 * day)], key=str)


def test_no_bitmap_is_dealt_before_it_is_whole(spark):
    df = spark.createDataFrame([(1, 5), (1, 5), (1, 40000), (2, 5), (2, None), (None, 5)], "fecha int, id long")
    daily = id_bitmaps(df, [F.col("fecha")], "id")
    plan = planned(daily)
    whole, partial = plan.index("bitmap_construct_agg("), plan.index("partial_bitmap_construct_agg(")
    assert whole < partial and "Exchange" not in plan[whole:partial]
    assert sorted((r[0] or 0, r[1]) for r in daily.select("fecha", "bucket").collect()) == [(0, 1), (1, 1), (1, 2), (2, 1)]


def test_daily_customers_move_no_bitmap(spark, shop):
    df = facts.distinct_customers(shop.clientes_por_dia, "day")
    assert "bitmap_or_agg" not in optimised(df)
    want = {r["fecha"]: r["n"] for r in shop.fct_pedidos.filter("estado_id = 3").groupBy("fecha")
            .agg(F.countDistinct("cliente_id").alias("n")).collect() if r["n"]}
    assert {r["periodo"]: r["clientes_unicos"] for r in df.collect()} == want
