"""Ordered scans, n-tiles by cuts, set operators, bitmaps and input folders: equal to plain SQL, and planned as meant."""
import os
import random
from decimal import Decimal

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conewise.operators.bitmaps import distinct_from_bitmaps, id_bitmaps
from conewise.operators.ntile_cuts import last_ranks, ntile_by_cuts
from conewise.operators.ordered_scan import ordered_scan
from conewise.operators.sets import not_in, union_distinct
from conewise.sources import sinks


def rows_of(frame):
    return sorted(map(repr, map(tuple, frame.collect())))


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("part_rows", [3, 40, 10_000])
def test_ordered_scan_equals_windows(spark, part_rows):
    rng = random.Random(part_rows)
    rows = [(i, rng.choice([None, 1, 5, 5, 9]), rng.choice([None, None, i, -i])) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, day int, v long").repartition(5)
    got = ordered_scan(df, ["day", "id"], {"s": F.col("v")}, {"f": F.col("v"), "g": F.when(F.col("v") > 100, F.col("v"))}, {"p": F.col("v")}, part_rows)
    w = Window.partitionBy(F.lit(1)).orderBy("day", "id")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("*", F.sum("v").over(upto).alias("s"), F.last("v", True).over(upto).alias("f"),
                     F.last(F.when(F.col("v") > 100, F.col("v")), True).over(upto).alias("g"), F.lag("v").over(w).alias("p"))
    assert rows_of(got) == rows_of(want)
    none = df.filter("id < 0")
    assert ordered_scan(none, ["day", "id"], {"s": F.col("v")}).count() == 0


def test_running_balance_has_no_window_without_partition(shop):
    from conewise import catalog
    text = plan(catalog.ON_SHOP["W08_points_balance"](shop))
    assert "Window" in text and "SinglePartition" not in text.split("Window")[0]
    for line in text.splitlines():
        if "Window [" in line:
            assert "_part" in line or "[1]" in line, line


@pytest.mark.parametrize(("n", "rows"), [
    (5, [(i, None if i % 7 == 0 else Decimal(i % 11)) for i in range(203)]),
    (5, [(i, Decimal(0) if i < 150 else Decimal(i)) for i in range(200)]),
    (4, [(i, None) for i in range(10)]),
    (10, [(i, Decimal(i)) for i in range(7)]),
    (3, [(1, Decimal(5))]),
    (5, []),
    (5, [(i, Decimal(10) ** 20 + Decimal(i % 60) / 100) for i in range(300)]),  # equal as doubles
])
def test_ntile_by_cuts_equals_the_window(spark, n, rows):
    df = spark.createDataFrame(rows, "id long, v decimal(30,2)").repartition(4)
    want = df.withColumn("t", F.ntile(n).over(Window.partitionBy(F.lit(1)).orderBy(F.col("v").asc_nulls_last(), "id")).cast("bigint"))
    for bins, few in ((3, 1), (1024, 10_000)):
        assert rows_of(ntile_by_cuts(df, "v", "id", n, "t", bins, few)) == rows_of(want)


def test_last_ranks():
    assert last_ranks(10, 3) == [4, 7] and last_ranks(2, 5) == [1] and last_ranks(0, 5) == []


def test_customer_scores_need_no_sort_of_whole_rows(shop):
    text = plan(shop.rpt_rfm) + plan(ntile_by_cuts(shop.fct_pedidos, "total", "pedido_id", 10, "d"))
    assert "rangepartitioning" not in text


def test_union_and_not_in_treat_nulls_as_sql_does(spark, duck):
    a = [(1, "x"), (None, "x"), (None, None), (2, None), (1, "x")]
    b = [(None, None), (2, None), (3, "z"), (None, "x")]
    make = lambda rows: spark.createDataFrame(rows, "k long, s string").repartition(3)
    got = union_distinct(make(a), make(b))
    assert rows_of(got) == sorted(map(repr, set(a) | set(b)))
    assert plan(union_distinct(make(a), make(b))).count("Exchange hashpartitioning") == 1
    sql = lambda rows: ", ".join(f"({'null' if k is None else k})" for k in rows)
    for among in ([2, 3], [2, None], [None]):
        keys = spark.createDataFrame([(k,) for k in among], "k long")
        want = duck.execute(f"select k from (values {sql([1, None, 2, 1])}) t(k) where k not in (select * from (values {sql(among)}))").fetchall()
        left = not_in(spark.createDataFrame([(1,), (None,), (2,), (1,)], "k long"), "k", keys)
        assert rows_of(left) == sorted(map(repr, want))
    empty = spark.createDataFrame([], "k long")
    assert rows_of(not_in(make(a), "k", empty)) == sorted(map(repr, a)) and not_in(empty, "k", empty).count() == 0


def test_bitmaps_roll_up(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(30), rng.choice([None, rng.randrange(100_000), 7])) for _ in range(2000)] + [(1, -5), (2, -5), (31, None)]
    df = spark.createDataFrame(rows, "day int, id long").repartition(4)
    daily = id_bitmaps(df, [F.col("day")], "id")
    for size in (1, 7, 100):
        key = F.floor(F.col("day") / size).alias("k")
        want = df.filter("id is not null").groupBy(key).agg(F.countDistinct("id").alias("n"))
        assert rows_of(distinct_from_bitmaps(daily, [key], "n")) == rows_of(want)
    assert id_bitmaps(df.filter("day < 0"), [F.col("day")], "id").count() == 0


def test_tables_follow_their_input_and_go_with_the_process(spark, tmp_path):
    file = tmp_path / "t.parquet"
    pq.write_table(pa.table({"a": [1, 2]}), file)
    before = sinks.input_root(spark, str(tmp_path), "test")
    assert before == sinks.input_root(spark, str(tmp_path), "test")
    first = sinks.materialise_once(lambda: spark.read.parquet(str(file)), spark, f"{before}/t")
    size = os.path.getsize(file)
    pq.write_table(pa.table({"a": [3, 4]}), file)
    os.utime(file, (1, 1))
    assert os.path.getsize(file) == size
    after = sinks.input_root(spark, str(tmp_path), "test")
    second = sinks.materialise_once(lambda: spark.read.parquet(str(file)), spark, f"{after}/t")
    assert after != before and rows_of(first) == ["(1,)", "(2,)"] and rows_of(second) == ["(3,)", "(4,)"]
    assert {before, after} <= set(sinks._REMOVED_AT_EXIT)
    for path in (before, after):
        sinks.remove_folder(spark, path)
        sinks._REMOVED_AT_EXIT.pop(path)
    assert not os.path.exists(before.removeprefix("file:"))


def test_orders_without_an_address_are_met(shop):
    missing = shop.fct_pedidos.filter("direccion_id is null")
    assert missing.count() > 0 and missing.filter("barrio is not null").count() == 0
    assert shop.int_pedidos.filter("direccion_id is null").count() == missing.count()
