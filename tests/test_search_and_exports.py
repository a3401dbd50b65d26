"""Trigram search, date-clustered exports, profiles and column digests: equal to the plain way, and planned as meant."""
import datetime
import glob
import hashlib
import random
from decimal import Decimal

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conewise import quality as Q
from conewise.operators import digests, trigrams
from conewise.plans.reports import text_search
from conewise.sources import readers, sinks

NAMES = ["Ana Maria", "ana maria lopez", None, "", "ab", "Customer#000000017", "Customer#000000170", "JOSÉ Pérez", "aaa", "aaaa a", "x+y (z)",
         "Kelvin", "Ma ria", "123456", "12 345"]


@pytest.mark.parametrize(("pattern", "runs"), [
    ("customer#0+1", ["customer#0"]), ("a?bcd", ["bcd"]), ("abc|def", []), ("(abc)", []), ("ab+cde", ["cde"]), ("ab{0,2}cde", ["cde"]),
    ("abc.def$", ["abc", "def"]), ("x[abc]yzw", ["yzw"]), (r"abc\d", []), ("ab", []), ("abc+", ["abc"]), ("abc*", []),
])
def test_required_runs(pattern, runs):
    assert trigrams.required_runs(pattern) == runs


def test_search_equals_the_scan(spark):
    rng = random.Random(3)
    letters = "abAB01# "
    names = [*NAMES, *("".join(rng.choices(letters, k=rng.randint(0, 12))) for _ in range(120))]
    df = spark.createDataFrame(list(enumerate(names)), "id long, name string").cache()
    index = trigrams.postings(df, "id", "name").cache()
    bits = ["a", "b", "ab", "0", "01", "#0", " ", "a+", "b?", "0*", "[ab]", ".", "ana", "mar", "b{1,2}", "A", "^", "$", "aba", "a|b"]
    patterns = ["ana maria", "customer#0+17", "^aaa", "é", "josé", *("".join(rng.choices(bits, k=rng.randint(1, 4))) for _ in range(200))]
    patterns = [p for p in dict.fromkeys(patterns) if "^+" not in p and "^*" not in p and "^?" not in p]

    def found(search):
        parts = [search(p).select(F.lit(p).alias("p"), "id") for p in patterns]
        got = []
        for i in range(0, len(parts), 25):  # plans of bounded size
            part = parts[i]
            for more in parts[i + 1:i + 25]:
                part = part.unionByName(more)
            got += map(tuple, part.collect())
        return sorted(got)

    want = found(lambda p: text_search(df, "name", p))
    assert found(lambda p: trigrams.search(df, index, "id", "name", p)) == want
    assert sum(bool(trigrams.pattern_grams(p)) for p in patterns) > 30
    assert trigrams.search(df, index, "id", "name", None).count() == len(names)


def test_window_reads_few_files(spark, tmp_path):
    day = datetime.date(2020, 1, 1)
    rows = [(day + datetime.timedelta(days=i * 37 % 1460), i) for i in range(4000)]
    df = spark.createDataFrame(rows, "fecha date, v long").repartition(16)
    path = str(tmp_path / "clustered")
    sinks.write_clustered(df, path, "fecha", 16)
    low, high = datetime.date(2021, 1, 1), datetime.date(2021, 12, 31)
    hit = total = 0
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.read_metadata(f)
        for g in range(meta.num_row_groups):
            column = meta.row_group(g).column(0).statistics
            total += 1
            hit += column.min <= high and column.max >= low
    assert total >= 12 and hit <= total // 4 + 2
    window = readers.load_table(spark, path, "fecha", str(low), str(high))
    assert "GreaterThanOrEqual(fecha" in window._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, window.collect())) == sorted(r for r in rows if low <= r[0] <= high)


def test_clustered_write_of_one_date_and_of_none(spark, tmp_path):
    df = spark.createDataFrame([(datetime.date(2020, 1, 1), i) for i in range(2000)], "fecha date, v long")
    sinks.write_clustered(df, str(tmp_path / "one"), "fecha", 4)
    assert len(glob.glob(f"{tmp_path}/one/*.parquet")) > 1  # a hot date is split
    sinks.write_clustered(df.filter("v < 0"), str(tmp_path / "none"), "fecha")
    assert spark.read.parquet(str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("few", [10, 10_000])
def test_profile_counts_alike_both_ways(spark, few):
    rng = random.Random(1)
    rows = [(i, rng.choice([None, "a", "b"]), rng.randint(0, 300), rng.choice([None, 1.5, 2.5])) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, kind string, n int, x double")
    got = {r.columna: r for r in Q.profile(df, few=few).collect()}
    for at, name in enumerate(df.columns):
        values = [r[at] for r in rows if r[at] is not None]
        assert (got[name].distintos, got[name].nulos, got[name].filas) == (len(set(values)), len(rows) - len(values), len(rows))
    assert got["kind"].valores == "a, b" and got["x"].valores is None
    none = {r.columna: r for r in Q.profile(df.filter("id < 0"), few=few).collect()}
    assert [none[c].distintos for c in df.columns] == [0] * 4


def test_profile_has_no_row_per_cell(shop):
    text = Q.profile(shop.fct_pedidos)._jdf.queryExecution().optimizedPlan().toString()
    for line in text.splitlines():
        assert "Expand" not in line
    assert text.count("Relation") > 2  # columns with many values are read alone


def test_digests_see_a_changed_value(spark):
    rows = [(i, f"t{i}", None if i % 3 else i / 4) for i in range(50)]
    types = "id long, t string, x double"
    one = Q.column_digests({"m": spark.createDataFrame(rows, types)}).collect()
    assert Q.column_digests({"m": spark.createDataFrame(rows[::-1], types)}).collect() == one
    changed = Q.column_digests({"m": spark.createDataFrame([*rows[:-1], (49, "t48", rows[-1][2])], types)}).collect()
    assert [a.columna for a, b in zip(one, changed, strict=True) if a != b] == ["t"]


def _digests_cell_by_cell(df):
    """What ``column_digests`` means: Spark's MD5 of the text of each value."""
    numeric = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        text = (c.cast("decimal(38,6)") if isinstance(f.dataType, numeric) else c).cast("string")
        r = df.select(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long").alias("d")).agg(F.count("*"), F.count("d"), F.sum("d")).first()
        out.append((f.name, r[0], r[1], r[2] or 0))
    return out


def test_md5_of_arrays_equals_hashlib():
    rng = random.Random(5)
    texts = ["", "a", "é" * 27, "x" * 55, "x" * 56, "x" * 300, "nul\0in", *("".join(rng.choices("ab1.é ", k=rng.randint(0, 80))) for _ in range(20_000))]
    want = [int(hashlib.md5(t.encode()).hexdigest()[:8], 16) for t in texts]
    assert digests.md5_32(pa.array(texts)).tolist() == want
    short = pa.array([t[:20] for t in texts])[7:]  # a slice, and texts of one block alone
    assert digests.md5_32(short).tolist() == [int(hashlib.md5(t[:20].encode()).hexdigest()[:8], 16) for t in texts[7:]]
    assert digests.md5_32(pa.array([], pa.string())).tolist() == []


def test_digests_equal_those_of_each_cell(spark):
    rng = random.Random(6)
    doubles = [0.0, -0.0, 0.1 + 0.2, 5e-7, 4.9e-7, 1.5e-6, 2.5e-6, -2.5e-6, 1e-7, 1234567.1234565, 99999999.999999, 1e8, 1e8 + 0.1, 123456789012.123456,
               1e20, -1e22, 2.0**-44, 1 / 3, 12.5, 100.0]
    start, day = datetime.datetime(1999, 12, 31, 23, 59, 59), datetime.date(2000, 2, 29)
    rows = []
    for i in range(3000):
        x = rng.choice([*doubles, rng.uniform(-1e9, 1e9), rng.randint(-10**9, 10**9) / 10**rng.randint(0, 7)])
        micros = rng.choice([0, 1, 500_000, 123_456])
        row = (i - 1500, i % 7 - 3, rng.choice([-2**63, 2**63 - 1, 0]), x, rng.choice([0.1, 1e-7, 3.5, 1e9]), Decimal(rng.randint(-10**11, 10**11)).scaleb(-2),
               Decimal(rng.randint(-9, 9)), Decimal(rng.randint(-10**30, 10**30)).scaleb(-6), Decimal(rng.randint(-10**16, 10**16)).scaleb(-10),
               Decimal(rng.randint(-3, 3)).scaleb(-6), rng.choice(["", " ", "ñandú", "x" * 70, f"t{i}"]), start + datetime.timedelta(hours=i, microseconds=micros),
               start + datetime.timedelta(days=i % 5, microseconds=micros), day + datetime.timedelta(days=i % 400), i % 2 == 0, f"b{i}".encode(), [i % 3, None], None)
        rows.append(tuple(None if rng.random() < 0.1 else v for v in row))
    types = ("a int, b tinyint, c long, d double, `e.f` float, g decimal(14,2), h decimal(5,0), i decimal(38,6), j decimal(30,10), k decimal(6,6), l string, "
             "m timestamp, n timestamp_ntz, o date, p boolean, q binary, r array<int>, s string")
    df = spark.createDataFrame(rows, types)
    for part in (df, df.repartition(7), df.filter("a < -1490"), df.filter("a is null and a is not null")):
        got = Q.column_digests({"m": part}).collect()
        assert {r.tabla for r in got} == {"m"}
        assert [(r.columna, r.filas, r.valores, r.suma) for r in got] == _digests_cell_by_cell(part)


def test_digests_in_batches(spark, monkeypatch):
    """A task takes its rows batch by batch; columns of many values are hashed as they are after the first."""
    rows = [(i, i % 3) for i in range(1000)]
    monkeypatch.setattr(digests, "BATCH_BYTES", 1000)
    batches = [pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in rows[at:at + 90]]) for at in range(0, 1000, 90)]
    (got,) = digests.digest_task(["whole", "whole"])(iter(batches))
    want = [sum(int(hashlib.md5(f"{r[k]}.000000".encode()).hexdigest()[:8], 16) for r in rows) for k in (0, 1)]
    assert got.to_pylist() == [{"filas": 1000, "n": [1000, 1000], "s": want}]


def test_digests_are_not_hashed_by_spark(spark):
    """cell by cell, S08 spent most of its time on MD5 and its text."""
    df = spark.createDataFrame([(1, "a")], "i long, t string")
    text = Q.column_digests({"m": df})._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in text and "md5(" not in text and "conv(" not in text
