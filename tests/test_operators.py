"""Operator tests on hand-made frames: each branch of the rule, expected rows worked out by hand."""
import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conewise.functions import columns as C
from conewise.operators import aggregates as A
from conewise.operators import rank, windows
from conewise.plans import reports as R


def test_global_row_number_and_ntile_match_window(spark):
    rnd = random.Random(7)
    rows = [(i, rnd.randint(0, 50), f"k{rnd.randint(0, 999):03d}") for i in range(997)]
    df = spark.createDataFrame(rows, "id long, v int, k string")
    order = [F.col("v").desc(), F.col("k"), F.col("id")]
    got = rank.global_row_number(df, order, "rn", partitions=7).select("id", "rn")
    exp = df.select("id", F.row_number().over(Window.orderBy(*order)).alias("rn"))
    assert sorted(got.collect()) == sorted(exp.collect())
    for n in (3, 5, 10):
        got = rank.global_ntile(df, order, n, "t", partitions=5).select("id", "t")
        exp = df.select("id", F.ntile(n).over(Window.orderBy(*order)).cast("bigint").alias("t"))
        assert sorted(got.collect()) == sorted(exp.collect())


def test_mode_per_key_ties_to_smallest(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, "a"), (2, "z"), (2, "y"), (2, "z")],
                               "k int, v string")
    got = dict(A.mode_per_key(df, "k", "v").collect())
    assert got == {1: "a", 2: "z"}


def test_latest_per_and_newest_two(spark):
    df = spark.createDataFrame([(1, 10, "x", 1), (1, 30, "y", 2), (1, 30, "z", 3), (2, 5, "w", 4)],
                               "k int, ts int, p string, id int")
    got = {r.k: r.p for r in windows.latest_per(df, ["k"], ["ts", "id"], ["p"]).collect()}
    assert got == {1: "z", 2: "w"}
    newest, previous = windows.newest_two(df, "k", ["ts", "id"], ["p"])
    assert {r.k: r.p for r in newest.collect()} == {1: "z", 2: "w"}
    assert {r.k: r.p for r in previous.collect()} == {1: "y"}


@pytest.mark.parametrize("total", ["1000000000000", "10000000000000000", "9999999999999999999999"])
def test_ratios_of_large_totals(spark, total):
    t = Decimal(total)
    df = spark.createDataFrame([(t / 4 if t < 10**20 else t / 100, t)], "x decimal(38,2), y decimal(38,2)")
    r = df.select(C.pct("x", "y", 1).alias("pct"), C.ddiv("x", "y").alias("d"),
                  C.to_usd(F.col("x"), F.col("y")).alias("usd"), C.to_usd(F.col("x"), F.lit(Decimal("1000.00"))).alias("k")).first()
    part = Decimal("0.25") if t < 10**20 else Decimal("0.01")
    assert r.pct == part * 100 and round(r.d, 6) == part and r.usd == part
    assert r.k == round(df.first().x / 1000, 2)


def test_share_of_large_totals(spark):
    df = spark.createDataFrame([(i, Decimal("10000000000000000.00")) for i in range(4)], "k int, v decimal(30,2)")
    assert {r.s for r in windows.share_of_total(df, "v", "s").collect()} == {Decimal("25.00")}


def test_first_event(spark):
    df = spark.createDataFrame([(1, 5, 100), (1, 3, 101), (1, 3, 99), (2, 7, 200)], "k int, ts int, id int")
    got = {r.id: (r.is_first, r.first_ts) for r in windows.first_event(df, "k", "ts", "id").collect()}
    assert got == {100: (False, 3), 101: (False, 3), 99: (True, 3), 200: (True, 7)}


def test_forward_fill_and_running_sum(spark):
    df = spark.createDataFrame([(1, 10), (2, None), (3, None), (4, 7), (5, None)], "d int, v int")
    got = [r.v for r in windows.forward_fill(df, "d", "v").orderBy("d").collect()]
    assert got == [10, 10, 10, 7, 7]
    got = [r.s for r in windows.running_sum(df.fillna(0), "d", "v", "s").orderBy("d").collect()]
    assert got == [10, 10, 10, 17, 17]


def test_lag_change(spark):
    df = spark.createDataFrame([(1, Decimal("100.00")), (2, Decimal("150.00")), (3, Decimal("0.00")),
                                (4, Decimal("10.00"))], "m int, v decimal(10,2)")
    got = [r.c for r in windows.lag_change(df, "m", "v", "p", "c").orderBy("m").collect()]
    assert got[0] is None and float(got[1]) == 50.0 and float(got[2]) == -100.0 and got[3] is None


def test_share_of_total(spark):
    df = spark.createDataFrame([("a", Decimal("1.00")), ("b", Decimal("2.00")), ("c", Decimal("1.00"))],
                               "k string, v decimal(10,2)")
    got = {r.k: float(r.s) for r in windows.share_of_total(df, "v", "s").collect()}
    assert got == {"a": 25.0, "b": 50.0, "c": 25.0}


def test_grouping_sets_breakdown(spark):
    df = spark.createDataFrame([("m1", "x", "p", 1), ("m1", "y", "p", 2), ("m1", None, "q", 4)],
                               "mes string, a string, b string, v int")
    got = {(r.dimension_tipo, r.dimension_valor): r.s
           for r in A.grouping_sets(df, ["mes"], ["a", "b"], {"s": "sum(v)"}).collect()}
    assert got == {("overall", "total"): 7, ("a", "x"): 1, ("a", "y"): 2, ("a", None): 4,
                   ("b", "p"): 3, ("b", "q"): 4}


def test_join_ids_ordered(spark):
    df = spark.createDataFrame([(1, 30), (1, 4), (1, 100), (2, 7)], "k int, id int")
    got = dict(A.join_ids(df, "k", "id", "ids").collect())
    assert got == {1: "4, 30, 100", 2: "7"}
    # a hot key spread over many id ranges still comes out in id order
    rnd = random.Random(3)
    ids = rnd.sample(range(-500, 5000), 400)
    hot = spark.createDataFrame([(1, i) for i in ids], "k int, id int")
    got = A.join_ids(hot, "k", "id", "ids", bucket=37).collect()[0].ids
    assert got == ", ".join(str(i) for i in sorted(ids))


def test_id_chunks_hold_a_hot_key_in_parts(spark):
    rnd = random.Random(5)
    ids = rnd.sample(range(-700, 20_000), 3000)
    rows = [(1, i) for i in ids] + [(2, 5), (None, 9), (None, -9), (3, None)]
    got = A.id_chunks(spark.createDataFrame(rows, "k int, id int"), "k", "id", size=100).collect()
    chunks = sorted((r for r in got if r.k == 1), key=lambda r: r.chunk)
    assert len(chunks) > 100 and max(r.n_ids for r in chunks) <= 100
    whole = sorted(ids)
    for r in chunks:
        assert r.ids == whole[r.position : r.position + r.n_ids] and r.first_id == r.ids[0]
    assert sum(r.n_ids for r in chunks) == len(whole)
    assert sorted((repr(r.k), r.position, r.ids) for r in got if r.k != 1) == [
        ("2", 0, [5]), ("None", 0, [-9]), ("None", 1, [9])]


def test_rule_columns(spark):
    df = spark.createDataFrame([(m, h) for m, h in [(1, 12), (4, 15), (7, 19), (10, 23), (12, 3)]],
                               "m int, h int")
    got = df.select(C.season("m").alias("s"), C.daypart("h").alias("d")).collect()
    assert [r.s for r in got] == ["Verano", "Otoño", "Invierno", "Primavera", "Verano"]
    assert [r.d for r in got] == ["Mediodia", "Tarde", "Noche", "Trasnoche", "Otro"]


def test_preferred_of_three_tie_priority(spark):
    df = spark.createDataFrame([(0, 0, 0), (1, 2, 2), (3, 3, 1), (0, 0, 5)], "a int, b int, c int")
    got = [r.p for r in df.select(C.preferred_of_three("a", "b", "c", ("A", "B", "C")).alias("p")).collect()]
    assert got == ["A", "B", "A", "C"]


def test_money_and_pct_text(spark):
    df = spark.createDataFrame([(None,), (0.0,), (950.4,), (12345.0,), (2500000.0,), (-3400.0,)], "v double")
    got = [r.t for r in df.select(C.money_text("v").alias("t")).collect()]
    assert got == ["$0", "$0", "$950", "$12.3K", "$2.5M", "$-3.4K"]
    got = [r.t for r in df.select(C.pct_text("v").alias("t")).collect()]
    assert got[0] == "—" and got[2] == "950.4%"


def test_reshape_statement_and_waterfall(spark):
    df = spark.createDataFrame([("2024-01-01", Decimal("10.00"), Decimal("4.00")),
                                ("2024-02-01", Decimal("20.00"), Decimal("5.00"))],
                               "mes string, ing decimal(10,2), gas decimal(10,2)").withColumn("mes", F.to_date("mes"))
    st = R.statement(R.statement_rows(df, [("Ingresos", "ing"), ("Gastos", "gas")], "mes"), "mes")
    got = {r.concepto: (float(r["01-24"]), float(r["02-24"])) for r in st.collect()}
    assert got == {"Ingresos": (10.0, 20.0), "Gastos": (4.0, 5.0)}
    wf = R.waterfall(df.withColumn("res", F.col("ing") - F.col("gas")), "mes",
                     [("Ingresos", "ing", 1), ("Gastos", "gas", -1)], ("Resultado", "res"))
    got = [(r.paso, float(r.valor), r.medida) for r in wf.orderBy("orden").collect()]
    assert got == [("Ingresos", 20.0, "relative"), ("Gastos", -5.0, "relative"), ("Resultado", 15.0, "total")]


def test_filters_and_topk(spark):
    df = spark.createDataFrame([(1, "Ana", "a", 1), (2, "ANAHI", "b", 0), (3, None, "a", 1), (4, "Luis", None, 0)],
                               "id int, nombre string, seg string, f int")
    assert sorted(r.id for r in R.facet_filter(df, {"seg": None}).collect()) == [1, 2, 3]
    assert sorted(r.id for r in R.text_search(df, "nombre", "ana").collect()) == [1, 2]
    assert sorted(r.id for r in R.tristate(df, "f", "without").collect()) == [2, 4]
    assert [r.id for r in R.top_n(df, "f", 2, tie=["id"]).collect()] == [1, 3]
    tops = R.filter_to_top(spark.createDataFrame([("x", 5), ("x", 5), ("y", 7), ("z", 1)], "k string, v int"),
                           "k", "v", 1)
    assert sorted(r.k for r in tops.collect()) == ["x", "x"]


def test_latest_period_row(spark):
    df = spark.createDataFrame([(1, "a"), (3, "c"), (2, "b")], "m int, v string")
    assert [tuple(r) for r in R.latest_period_row(df, "m").collect()] == [(3, "c")]


def test_global_rank_splits_a_hot_sort_value(spark):
    # a third of the rows share one sort value; the unique tie id lets the
    # range partitioner split them, so no partition holds the hot value whole
    rows = [(i, 0 if i % 3 == 0 else i) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, v long")
    order = [F.col("v").asc(), F.col("id").asc()]
    fixed = rank._sorted_checkpoint(df, order, 6)
    sizes = [r["count"] for r in fixed.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert max(sizes) < 1000 and sum(sizes) == 3000
    got = rank.global_row_number(df, order, "rn", partitions=6).select("id", "rn")
    exp = df.select("id", F.row_number().over(Window.orderBy(*order)).alias("rn"))
    assert sorted(got.collect()) == sorted(exp.collect())


def test_statement_months_come_in_date_order(spark):
    import datetime as dt
    rows = [(dt.date(y, m, 1), y * 100 + m) for y, m in ((2001, 2), (1999, 12), (2000, 1), (2001, 1))]
    long = R.statement_rows(spark.createDataFrame(rows, "mes date, v int"), [("Ventas", "v"), ("Otra", "v")], "mes")
    wide = R.statement(long, "mes")
    assert wide.columns == ["orden", "concepto", "12-99", "01-00", "01-01", "02-01"]
    assert [r.concepto for r in wide.collect()] == ["Ventas", "Otra"]


def test_period_running_starts_at_the_selected_period(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.date(2000, m, 1), m) for m in range(1, 7)], "mes date, v int")
    got = R.period_running(df, "mes", "2000-03-01", "2000-05-01", {"v": "acumulado"}).orderBy("mes").collect()
    assert [(r.v, r.acumulado) for r in got] == [(3, 3), (4, 7), (5, 12)]


def test_rows_come_in_order(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 1), ("c", 2), (None, 9)], "k string, v int")
    assert [(r.k, r.n) for r in A.value_counts(df, "k").collect()] == [("c", 2), ("a", 1), ("b", 1)]
    assert [r.k for r in A.distinct_values(df, "k").collect()] == ["a", "b", "c"]
    ordered = R.order_by_labels(df.filter("k is not null"), "k", ["c", "a"], F.col("v"))
    assert [(r.k, r.v) for r in ordered.collect()] == [("c", 1), ("c", 2), ("a", 1), ("b", 1)]
    assert [r.v for r in R.project_existing(df, ["v", "gone"], [F.col("v").desc(), F.col("k")]).collect()] == [9, 2, 1, 1, 1]


def test_rows_without_a_key_skip_the_join(spark):
    from conewise.plans.facts import _left_where_known
    df = spark.createDataFrame([(i, None if i % 3 else i) for i in range(90)], "id long, k long")
    side = spark.createDataFrame([(0, "zero"), (3, "three")], "k long, name string")
    got = {r.id: r.name for r in _left_where_known(df, side, "k").collect()}
    assert len(got) == 90 and {i: n for i, n in got.items() if n} == {0: "zero", 3: "three"}
