"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from vejrkraft.operators.align import outer_align, outer_align_series
from vejrkraft.operators.nearest import nearest_point
from vejrkraft.operators.ordering import ffill, row_index
from vejrkraft.operators.profiles import wind_profile
from vejrkraft.operators.stats import corr_matrix
from vejrkraft.plans.panel import consumption_hourly
from vejrkraft.registry import checks
from vejrkraft.sinks.series import write_series

FOLDER = "/root/testdata/sf0.001"


def plan(df, mode="simple"):
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)
    return text.split("== Physical Plan ==")[-1]


def row_shuffles(text):
    """Shuffles that are not fed by a partial aggregate."""
    lines = text.splitlines()
    fed = [below for line, below in zip(lines, lines[1:]) if "Exchange hashpartitioning" in line]
    return sum("Aggregate(" not in below for below in fed)


@pytest.mark.parametrize("name", [n for n in checks() if not n.startswith("stream_")])
def test_no_python_and_no_cross_join(spark, name):
    text = plan(checks()[name][0](spark, FOLDER))
    # Only the nearest-point search compares Arrow batches in Python.
    python = r"BatchEvalPython|MapInPandas|CartesianProduct" + ("" if name in ("nearest_point", "clean_sunlight", "clean_wind") else "|ArrowEvalPython")
    assert not re.search(python, text)
    assert "BroadcastNestedLoopJoin" not in text


def test_windows_without_a_key_only_see_one_row_per_range(spark):
    df = spark.range(10_000).select(F.lit("hot").alias("k"), "id", F.when(F.col("id") % 7 == 0, 1.0).alias("v"))
    for by in ([], ["k"]):
        text = plan(ffill(df, ["id"], by=by, cols=["v"]))
        # The row-level window is partitioned by range; those over ranges sit above an aggregate.
        windows = [w for w in text.splitlines() if "Window [" in w and "_row" in w]
        assert windows and all("windowspecdefinition(_bucket" in w for w in windows)
        for below in text.split("Exchange SinglePartition")[1:]:
            assert "HashAggregate" in below.split("FileScan")[0]
        assert row_shuffles(text) == 1
    # Numbering needs no shuffle of the sorted rows at all.
    assert row_shuffles(plan(row_index(df, ["id"]))) == 0


def test_alignment_shuffles_each_input_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frames = [spark.range(1000).select("id", F.lit(i).alias(f"v{i}")) for i in range(4)]
        text = plan(outer_align(frames, ["id"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The keys and four inputs; the growing result is never shuffled again.
    assert text.count("Exchange hashpartitioning") == 5
    assert text.count("SortMergeJoin") == 4


def test_bucketed_series_are_not_shuffled(spark, folder):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    names = [f"plan_series_{i}" for i in range(3)]
    try:
        for i, name in enumerate(names):
            write_series(spark.range(1000).select("id", F.lit(i).alias(f"v{i}")), name, ["id"], f"{folder}/{name}", buckets=4, overwrite=True)
        text = plan(outer_align_series(spark, names, ["id"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in names:
            spark.sql(f"drop table if exists {name}")
    # The one shuffle deals the staged keys to the buckets; a bucketed scan stands under no other.
    assert text.count("Exchange hashpartitioning") == 1 and text.count("SortMergeJoin") == 3
    under = text[text.index("Exchange hashpartitioning") :].splitlines()[1]
    assert "v0" not in under and text.count("Bucketed: true") == 3


def test_nearest_searches_distinct_coordinates_without_a_join_to_the_points(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0, 0)], "code int, latitude double, longitude double, ord int")
    df = spark.range(100).select((F.col("id") % 5).cast("double").alias("latitude"), F.lit(1.0).alias("longitude"))
    text = plan(nearest_point(df, points))
    assert text.count("Join") == 1 and "BatchEvalPython" not in text
    search = text[text.index("ArrowEvalPython") :]
    assert "HashAggregate(keys=[q_lat" in search and "Join" not in search


def test_profile_hash_aggregates_timestamps(spark):
    obs = spark.createDataFrame(
        [], "station_id string, parameter string, observed_from string, value double, latitude double, longitude double, arrival long"
    )
    text = plan(wind_profile(obs))
    assert "HashAggregate" in text and "SortAggregate" not in text and text.count("Exchange") == 1


def test_consumption_is_added_up_before_the_shuffle(spark):
    df = spark.createDataFrame([], "datetime timestamp, municipality_code int, ConsumptionkWh double, area string, ord long")
    text = plan(consumption_hourly(df, labels=["area"]))
    scan_side = text[text.rindex("Exchange") :]
    assert "partial_sum(ConsumptionkWh" in scan_side and "HashAggregate" in scan_side


def test_correlation_reads_once_and_moves_only_sums(spark):
    text = plan(corr_matrix(spark.read.parquet(f"{FOLDER}/lineitem.parquet"), ["l_quantity", "l_tax"]))
    assert text.count("FileScan") == 1 and "ReadSchema: struct<l_quantity:double,l_tax:double>" in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(checks()["month_window"][0](spark, FOLDER))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text
    text = plan(checks()["union_all"][0](spark, FOLDER))
    assert "s_nationkey" not in text and "c_mktsegment" not in text
