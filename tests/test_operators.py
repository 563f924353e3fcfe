"""Edge cases of functions, cleaning, profiles, reports, places and statistics."""

import math
import random
import statistics
from fractions import Fraction

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from vejrkraft.functions import texts, times
from vejrkraft.functions.areas import price_area
from vejrkraft.functions.numbers import round_even, to_number
from vejrkraft.operators import cleaning, grids, locations, profiles, stats, summaries


def one(spark, value, kind="string"):
    return spark.createDataFrame([(v,) for v in value], f"c {kind}")


def values(df):
    return [r[0] for r in df.collect()]


def test_area_rules(spark):
    area = lambda kind, *v: values(one(spark, v).select(price_area("c", kind)))
    assert area("area", "BZN|DK1", "BZN|DK", None) == ["1", None, None]
    assert area("municipality", "400", "401", "x", None) == ["2", "1", None, None]
    assert area("longitude", "10.999", "11.0", None, "x", "NaN") == ["1", "2", None, None, None]
    with pytest.raises(ValueError):
        price_area("c", "postcode")


def test_numbers(spark):
    assert values(one(spark, ["1.5", "x", "NaN", "", None]).select(to_number("c"))) == [1.5, None, None, None, None]
    assert values(one(spark, [0.125, 0.375, 2.5], "double").select(round_even("c"))) == [0.12, 0.38, 2.5]


def test_times(spark):
    df = one(spark, ["2024-05-01T10:00:00Z", "bad", None])
    got = times.normalize_datetime(df, "c").select(times.iso_text("datetime"))
    assert values(got) == ["2024-05-01T10:00:00Z", None, None]
    with pytest.raises(Exception, match="(?i)cast|parse"):
        times.normalize_datetime(df, "c", on_error="raise").collect()
    edges = one(spark, ["a - b", "a", None]).select(times.interval_edge("c"), times.interval_edge("c", "start"))
    assert rows(edges) == [("b", "a"), (None, None), (None, None)]
    december = one(spark, ["2024-12-31"]).select(times.next_month(F.col("c").cast("date")).cast("string"))
    assert values(december) == ["2025-01-01"]


def test_month_window_in_danish_time(spark):
    df = one(spark, ["2024-06-30 21:59:59", "2024-06-30 22:00:00", "2024-07-31 21:59:59", "2024-07-31 22:00:00"])
    df = df.select(F.col("c").cast("timestamp").alias("t"))
    got = times.month_window(df, "t", "2024-07-15", zone="Europe/Copenhagen")
    assert values(got.select(F.date_format("t", "dd HH:mm:ss"))) == ["30 22:00:00", "31 21:59:59"]
    assert times.month_window(df, "t", "2024-06-01", "2024-07-01").count() == 4


def test_calendar(spark):
    months = grids.month_calendar(spark)
    assert months.count() == 40
    last = months.orderBy("window_start").tail(1)[0]
    assert (last["year"], last["month"], last["window_end"]) == (2025, 12, "2026-01-01T00:00:00Z")
    df = one(spark, ["2022-09-05", "2022-09-06", "2023-01-01"]).select(F.col("c").cast("timestamp").alias("t"))
    assert rows(grids.month_coverage(df, F.col("t"), months)) == [(40, 2, 3, 600 / (1 << 20))]


def test_texts(spark):
    df = spark.createDataFrame([(1234567, 3.14159, "north STATION")], "n long, x double, t string")
    got = df.select(texts.thousands(F.col("n")), texts.fixed(F.col("x"), 2), texts.title_case(F.col("t")))
    assert rows(got) == [("1,234,567", "3.14", "North Station")]


def test_column_discovery():
    find = cleaning.find_station_columns
    assert find(["ID", "Lat", "Lng", "Station_Name"]) == {"latitude": "Lat", "longitude": "Lng", "name": "Station_Name"}
    # The first fitting column wins, and a second latitude may still serve as the name.
    assert find(["plate", "lat_name", "longitude"]) == {"latitude": "plate", "longitude": "longitude", "name": "lat_name"}
    assert find(["x", "y"]) == {"latitude": None, "longitude": None, "name": None}


def test_cleaning(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (None, None)], "x double, s string")
    assert rows(cleaning.nan_to_null(df)) == [(1.0, "a"), (None, "b"), (None, None)]
    assert rows(cleaning.null_rows_removed(cleaning.nan_to_null(df), ["x"])) == [(3, 1, 2)]
    assert rows(cleaning.fill_with_zero(cleaning.nan_to_null(df), ["x"]).select("x")) == [(0.0,), (0.0,), (1.0,)]
    good, bad = cleaning.split_rejects(df, {"no text": F.col("s").isNotNull(), "not a": F.col("s") == "a"})
    assert good.count() == 1 and rows(bad.select("reason")) == [("no text",), ("not a",)]


OBS = "station_id string, parameter string, observed_from string, value double, latitude double, longitude double, arrival long"
DETAILS = "station_id string, name string, country string, status string, valid_from string, valid_to string, arrival long"


def test_sunlight_profile(spark):
    obs = spark.createDataFrame(
        [
            ("a", "mean_radiation", "2024-01-01T00:00:00+01:00", 1.0, 1.0, 1.0, 0),
            ("a", "bright_sunshine", "2024-01-02T00:00:00+01:00", None, 2.0, 2.0, 0),
            ("a", "bright_sunshine", "2024-01-01T00:00:00+02:00", 4.0, 3.0, 3.0, 7),
            ("b", "mean_radiation", None, 1.0, 4.0, 4.0, 1),
            ("b", "mean_radiation", "2024-03-01", 1.0, 5.0, 5.0, 2),
        ],
        OBS,
    )
    details = spark.createDataFrame([("a", None, "DNK", None, "v", None, 0)], DETAILS)
    got = profiles.sunlight_profile(obs, details, as_timestamp=False)
    keep = ["station_id", "name", "country", "status", "latitude", "sunshine_observations", "radiation_observations",
            "first_sunshine_date", "measurement_types"]
    assert rows(got.select(keep)) == [
        ("a", "Unknown", "DNK", "Unknown", 3.0, 2, 1, "2024-01-01T00:00:00+02:00", "bright_sunshine, mean_radiation"),
        ("b", None, "Unknown", "Unknown", 4.0, 0, 2, None, "mean_radiation"),
    ]
    overlap = summaries.flag_overlap(got, "measures_sunshine", "measures_radiation")
    assert rows(overlap) == [(0, 1, 1, 2)]


def test_precipitation_mean_counts_valueless_rows(spark):
    data = [("a", 1.0), ("a", None), ("a", 2.35), ("b", 0.0), ("b", 0.0), ("c", None)]
    obs = spark.createDataFrame(
        [(s, "acc_precip", "2024-01-01", v, None, None, i) for i, (s, v) in enumerate(data)], OBS
    )
    got = profiles.precipitation_profile(obs).select(
        "station_id", "precipitation_observations", "min_precipitation_mm", "avg_precipitation_mm", "total_precipitation_sample_mm"
    )
    assert rows(got) == [("a", 3, 1.0, 1.12, 3.35), ("b", 2, 0.0, None, None), ("c", 1, None, None, None)]


def test_wind_text_times_compare_as_text_only_if_asked(spark):
    obs = spark.createDataFrame(
        [
            ("a", "mean_wind_speed", "2024-01-01T00:30:00+02:00", 5.0, None, None, 0),
            ("a", "mean_wind_dir", "2024-01-01T00:00:00+00:00", 300.0, 1.0, 2.0, 0),
        ],
        OBS,
    )
    got = profiles.wind_profile(obs, as_timestamp=False).first()
    assert got["first_wind_date"] == "2024-01-01T00:00:00+00:00" and got["max_wind_speed_recorded_ms"] == 5.0
    assert (got["latitude"], got["longitude"]) == (1.0, 2.0)
    timed = profiles.wind_profile(obs).select(times.iso_text("first_wind_date"))
    assert values(timed) == ["2023-12-31T22:30:00Z"]


def test_extremes_need_a_value_and_prefer_the_first(spark):
    df = spark.createDataFrame([("a", 3.0, None), ("b", 3.0, None), ("c", None, None)], "id string, hi double, lo double")
    assert rows(summaries.extreme_rows(df, "hi", "lo", ["id"], "id")) == [("highest", 3.0, "a")]


def test_page_accounting_over_many_pages(spark):
    rnd = random.Random(3)
    data = [("p", rnd.randrange(2500), str(rnd.randrange(400))) for _ in range(4000)]
    got = summaries.page_accounting(spark.createDataFrame(data, "parameter string, page long, station_id string"))
    seen, want = set(), []
    for page in sorted({p for _, p, _ in data}):
        here = [s for _, p, s in data if p == page]
        new = set(here) - seen
        seen |= new
        want.append(("p", page, len(here), len(set(here)), len(new), len(seen)))
    assert sorted(tuple(r) for r in got.collect()) == want


def test_reconcile(spark):
    df = one(spark, ["a", "b", "b"]).withColumnRenamed("c", "station_id")
    verdict = lambda n: summaries.reconcile(df, n).first()["verdict"]
    assert [verdict(1), verdict(2), verdict(3)] == ["more", "equal", "fewer"]


def test_locations(spark):
    df = spark.createDataFrame(
        [
            (55.00000012, 9.0, "A", "wind", None, 0),
            (55.00000049, 9.0, "B", "sunlight", "Active", 2),
            (55.0, 9.0, "A", "wind", "Active", 1),
            (56.0, 10.0, "C", "precipitation", "Inactive", 3),
        ],
        "latitude double, longitude double, name string, station_type string, status string, ord long",
    )
    places = locations.location_rollup(df)
    keep = ["name", "latitude", "distinct_names", "stations", "types", "statuses", "place_class", "colour", "icon", "label"]
    assert rows(places.select(keep)) == [
        ("A", 55.00000012, 2, 3, ["wind", "sunlight"], [None, "Active"], "multi", "purple", "star", "A (wind, sunlight)"),
        ("C", 56.0, 1, 1, ["precipitation"], ["Inactive"], "precipitation", "blue", "tint", "C (precipitation)"),
    ]
    assert rows(locations.location_counts(places)) == [(2, 1, 1)]


def test_correlation_with_gaps_and_constants(spark):
    data = [(1.0, 2.0, 7.0, "x"), (2.0, None, 7.0, "x"), (3.0, 5.0, 7.0, "x"), (4.0, 9.0, None, "x"), (None, 1.0, 7.0, "x")]
    df = spark.createDataFrame(data, "a double, b double, k double, s string")
    got = {(r["col_a"], r["col_b"]): r["r"] for r in stats.corr_matrix(df).collect()}
    assert len(got) == 9 and got["a", "k"] is None and got["k", "k"] is None and got["a", "a"] == 1.0
    want = statistics.correlation([1.0, 3.0, 4.0], [2.0, 5.0, 9.0])
    assert got["a", "b"] == pytest.approx(want) == got["b", "a"]


def test_stored_sketches_keep_their_error(spark):
    """Twelve months of overlapping stations; unions of stored sketches against exact sets."""
    months = spark.range(12).selectExpr("cast(id as string) page", "id m")
    obs = months.selectExpr("page", "m", "explode(sequence(m * 9000, m * 9000 + 29999)) s").selectExpr(
        "case when s % 3 = 0 then 'wind' else 'sun' end parameter", "page", "m", "if(s % 1000 = 7, null, cast(s as string)) station_id"
    )
    stored = summaries.station_sketches(obs)
    error = summaries.sketch_error()
    assert 0.016 < error < 0.0163
    for last in (0, 4, 11):
        part = obs.where(f"m <= {last}")
        want = {r["parameter"]: r["stations"] for r in summaries.distinct_stations(part).collect()}
        got = {r["parameter"]: r["stations"] for r in summaries.sketched_stations(stored.where(f"int(page) <= {last}")).collect()}
        assert set(got) == set(want) == {"wind", "sun", None}
        assert all(abs(got[p] - n) <= 4 * error * n for p, n in want.items())
    small = summaries.station_sketches(obs, bits=6)
    mixed = stored.where("page = '0'").unionByName(small.where("page = '1'"))
    assert summaries.sketched_stations(mixed).count() == 3
    assert rows(summaries.merge_sketches(stored, ["parameter"]).select("parameter", "rows")) == [("sun", 240000), ("wind", 120000)]


@pytest.mark.parametrize("parts", [1, 7])
def test_correlation_of_large_means_and_odd_values(spark, parts):
    rnd = random.Random(parts)
    x = [rnd.gauss(0, 1e-3) for _ in range(400)]
    data = [(1e9 + v, 2e9 - v, 3.3, float("nan") if i == 7 else v, None) for i, v in enumerate(x)]
    df = spark.createDataFrame(data, "a double, b double, `k.0` double, o double, empty double").repartition(parts)
    got = {(r["col_a"], r["col_b"]): r["r"] for r in stats.corr_matrix(df).collect()}
    a, b = ([Fraction(d[i]) for d in data] for i in (0, 1))
    da, db = ([v - sum(c) / len(c) for v in c] for c in (a, b))
    dot = lambda p, q: float(sum(v * w for v, w in zip(p, q)))
    assert got["a", "b"] == pytest.approx(dot(da, db) / math.sqrt(dot(da, da) * dot(db, db)), abs=1e-7)
    assert got["k.0", "k.0"] is None and got["a", "k.0"] is None and got["empty", "a"] is None
    assert math.isnan(got["a", "o"]) and math.isnan(got["o", "o"]) and got["b", "b"] == 1.0


def test_gram_blocks_cut_columns(spark, monkeypatch):
    monkeypatch.setattr(stats, "BLOCK", 2)
    rnd = random.Random(3)
    values = np.array([[rnd.gauss(5, 2) for _ in range(50)] for _ in range(5)])
    sums = stats.GramBlocks(5)
    for part in np.split(values, 5, axis=1):
        sums.add(part, np.ones(part.shape, bool))
    for row in sums.pairs().to_pylist():
        x, y = values[row["a"]], values[row["b"]]
        assert row["xy"] == pytest.approx(((x - x.mean()) * (y - y.mean())).sum())
        assert (row["n"], row["mean_x"]) == (50, pytest.approx(x.mean()))


@pytest.mark.parametrize("sketch, most", [(10_000, 1 << 20), (40, 1 << 20), (40, 5), (20, 1)])
def test_box_stats_against_plain_quantiles(spark, monkeypatch, sketch, most):
    """Without brackets, with brackets of 4 / 40 of the values, and with brackets narrowed by further scans."""
    monkeypatch.setattr(stats, "SKETCH", sketch)
    rnd = random.Random(8)
    data = [(rnd.choice([None, rnd.gauss(0, 1), 0.0, 50.0]), rnd.randrange(10)) for _ in range(997)]
    df = spark.createDataFrame(data, "x double, n int").repartition(3)
    got = {r["column"]: r for r in stats.box_stats(df, most=most).collect()}
    for i, name in enumerate(["x", "n"]):
        known = sorted(float(r[i]) for r in data if r[i] is not None)
        q1, median, q3 = statistics.quantiles(known, n=4, method="inclusive")
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = [v for v in known if low <= v <= high]
        row = got[name]
        assert [row["q1"], row["median"], row["q3"]] == pytest.approx([q1, median, q3])
        assert (row["n"], row["whisker_low"], row["whisker_high"]) == (len(known), inside[0], inside[-1])
        assert row["outliers"] == len(known) - len(inside)


def test_box_stats_of_odd_values(spark):
    rnd = random.Random(1)
    inf, nan = float("inf"), float("nan")
    data = [(rnd.choice([-inf, inf, nan, 1.0]), rnd.gauss(0, 1) if i % 50 else nan, None) for i in range(500)]
    got = {r["column"]: r for r in stats.box_stats(spark.createDataFrame(data, "a double, b double, c double")).collect()}
    assert set(got) == {"a", "b"} and got["a"]["n"] == got["b"]["n"] == 500 and got["b"]["outliers"] >= 10
    assert stats.box_stats(spark.createDataFrame([], "a double")).count() == 0


def test_box_stats_of_four_values(spark):
    row = stats.box_stats(one(spark, [1.0, 2.0, 4.0, 9.0], "double")).first()
    assert (row["q1"], row["median"], row["q3"]) == (1.75, 3.0, 5.25)
