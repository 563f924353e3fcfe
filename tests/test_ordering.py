"""Range-wise order operators against the plain window on random rows."""

import random

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from vejrkraft.operators.ordering import ffill, nulls_last, row_index, running_total

SCHEMA = "k string, t int, id long, v double, w string"


def random_rows(n, seed, hot=False):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        k = rnd.choice([None, "a", "b", "c"])
        if hot and rnd.random() < 0.7:
            k = "a"
        t = rnd.choice([None, 1, 1, 1, 2, 3, 4, 9])
        v = rnd.choice([None, None, None, None, None, round(rnd.random(), 3)])
        w = rnd.choice([None, None, None, "x", "y"])
        out.append((k, t, i, v, w))
    rnd.shuffle(out)
    return out


def plain(df, order, by, fn):
    w = Window.partitionBy(*by).orderBy(*nulls_last(order))
    w = w.rowsBetween(Window.unboundedPreceding, 0)
    return fn(w)


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("by", [[], ["k"]])
@pytest.mark.parametrize("buckets", [2, 7, 64])
def test_ffill_equals_plain_window(spark, hot, by, buckets):
    df = spark.createDataFrame(random_rows(600, buckets, hot), SCHEMA)
    got = ffill(df, ["t", "id"], by=by, cols=["v", "w"], buckets=buckets)
    w = Window.partitionBy(*by).orderBy(*nulls_last(["t", "id"]))
    w = w.rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumns({c: F.last(c, True).over(w) for c in ("v", "w")})
    assert rows(got) == rows(want)


def test_global_ffill_fills_the_order_columns_too(spark):
    df = spark.createDataFrame(random_rows(300, 5), SCHEMA)
    got = ffill(df, ["t", "k", "id"], buckets=9)
    w = Window.orderBy(*nulls_last(["t", "k", "id"]))
    w = w.rowsBetween(Window.unboundedPreceding, 0)
    want = df.select(*[F.last(c, True).over(w).alias(c) for c in df.columns])
    assert rows(got) == rows(want)


def test_ffill_of_nothing_and_of_one_row(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert ffill(df, ["t", "id"]).collect() == []
    df = spark.createDataFrame([("a", 1, 1, None, "x")], SCHEMA)
    assert rows(ffill(df, ["t", "id"])) == [("a", 1, 1, None, "x")]


@pytest.mark.parametrize("by", [[], ["k"]])
def test_row_index_and_running_total(spark, by):
    df = spark.createDataFrame(random_rows(500, 11, True), SCHEMA)
    w = Window.partitionBy(*by).orderBy(*nulls_last(["t", "id"]))
    got = row_index(df, ["t", "id"], by=by)
    assert rows(got) == rows(df.withColumn("position", F.row_number().over(w).cast("long")))
    ints = df.withColumn("n", (F.col("id") % 7).cast("long"))
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    got = running_total(ints, "n", ["t", "id"], by=by)
    assert rows(got) == rows(ints.withColumn("running", F.sum("n").over(run)))


def test_ranges_split_a_hot_key(spark):
    from vejrkraft.operators.ordering import with_ranges

    df = spark.range(20000).select(F.lit("a").alias("k"), F.lit(1).alias("t"), "id")
    sizes = [r["count"] for r in with_ranges(df, ["k", "t", "id"], 8).groupBy("_bucket").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 20000 / 4
