"""Joins with hot keys equal plain joins and broadcast only the hot keys' rows."""
import pytest
from pyspark.sql import functions as F

from conewise.operators import hot_keys


@pytest.fixture(scope="module")
def sides(spark):
    rows = [("hot", i, 1) for i in range(400)] + [(None, i, 2) for i in range(300)] + [("gone", i, 3) for i in range(200)]
    rows += [(f"k{i % 50}", i, 4) for i in range(100)] + [("k1", 1, 4)] * 2
    left = spark.createDataFrame(rows, "k string, v long, _hidden long").repartition(7)
    right = spark.createDataFrame([(f"k{i}", i, f"d{i}") for i in range(40)] + [("hot", -1, "dh"), (None, -2, "dn")], "k string, w long, name string")
    return left, right


def as_rows(frame):
    return sorted(map(repr, map(tuple, frame.collect())))


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("share", [0.1, 2.0])  # with hot keys and with none
def test_equal_to_a_plain_join(sides, how, share):
    left, right = sides
    hot = hot_keys.hot_keys(left, ["k"], share)
    assert sorted(r.k for r in hot.collect()) == (["gone", "hot"] if share < 1 else [])
    got = hot_keys.join_hot(left, right, ["k"], hot, how)
    assert as_rows(got) == as_rows(left.join(right, "k", how).select(got.columns))


def test_several_right_rows_and_two_keys(spark):
    left = spark.createDataFrame([(1, 2, i) for i in range(100)] + [(1, None, 0), (3, 4, 5)], "a long, b long, v long")
    right = spark.createDataFrame([(1, 2, "x"), (1, 2, "y"), (3, 4, "z")], "a long, b long, w string")
    hot = hot_keys.hot_keys(left, ["a", "b"], 0.5)
    for how in ("inner", "left"):
        got = hot_keys.join_hot(left, right, ["a", "b"], hot, how)
        assert as_rows(got) == as_rows(left.join(right, ["a", "b"], how).select(got.columns))


def test_no_rows_and_wrong_kind(sides):
    left, right = sides
    none = left.filter("v < 0")
    assert hot_keys.join_hot(none, right, ["k"], hot_keys.hot_keys(none, ["k"])).count() == 0
    with pytest.raises(ValueError):
        hot_keys.join_hot(left, right, ["k"], none.select("k"), "full")


def test_no_task_gets_a_hot_key(spark, sides):
    """Rows of hot and null keys are spread over the shuffle's partitions."""
    left, right = sides
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = hot_keys.join_hot(left, right, ["k"], hot_keys.hot_keys(left, ["k"], 0.1), "left")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(sizes) == 8 and max(sizes) < 3 * sorted(sizes)[4]
