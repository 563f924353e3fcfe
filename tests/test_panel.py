"""The panel on hand-made series, both fill modes, and the clean-up of its four inputs."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from vejrkraft.plans import panel

POINTS = [(101, 55.68, 12.57, 0), (400, 55.1, 14.9, 1), (751, 56.15, 10.2, 2), (752, 56.15, 10.2, 3)]


@pytest.fixture(scope="module")
def points(spark):
    return spark.createDataFrame(POINTS, "code int, latitude double, longitude double, ord int")


def stamp(df, *cols):
    return df.withColumns({c: F.date_format(c, "HH:mm") for c in cols})


def test_clean_prices(spark):
    schema = "`MTU (UTC)` string, Area string, `Intraday Period (UTC)` string, `Intraday Price (EUR/MWh)` string, price_eur_mwh double"
    one = spark.createDataFrame([("01/01/2024 00:00:00 - 01/01/2024 01:00:00", "BZN|DK1", None, None, 10.0)], schema)
    two = spark.createDataFrame([("01/01/2024 00:00:00", "BZN|DK", None, None, 20.0)], schema)
    got = panel.clean_prices([one, two])
    assert got.columns == ["price_eur_mwh", "datetime", "area"]
    assert rows(stamp(got, "datetime")) == [(10.0, "01:00", "1"), (20.0, None, None)]
    assert rows(stamp(panel.clean_prices([one], stamp="start"), "datetime")) == [(10.0, "00:00", "1")]
    bad = spark.createDataFrame([("x - 2024-01-01", "BZN|DK1", None, None, 1.0)], schema)
    with pytest.raises(Exception, match="(?i)parse"):
        panel.clean_prices([bad]).collect()


def test_clean_weather(spark, points):
    schema = "date string, to_time string, station_id string, latitude double, longitude double, parameter string, value double"
    df = spark.createDataFrame(
        [
            ("2024-01-01", "01:00", "06001", 55.7, 12.5, "mean_wind_speed", 3.0),
            ("2024-01-01", "01:00", "06002", 56.2, 10.999, "mean_wind_speed", 4.0),
            ("2024-01-01", "02:00", "06003", None, 11.0, "mean_wind_speed", 5.0),
            ("2024-01-01", "01:00", "06001", 55.7, 12.5, "mean_wind_dir", 270.0),
        ],
        schema,
    )
    got = stamp(panel.clean_wind(df, points), "datetime")
    keep = ["datetime", "area", "municipality_code", "wind_station_id", "wind_latitude", "value"]
    assert rows(got.select(keep)) == [
        ("01:00", "1", 751, "06002", 56.2, 4.0),
        ("01:00", "2", 101, "06001", 55.7, 3.0),
        ("02:00", "2", None, "06003", None, 5.0),
    ]
    sun = panel.clean_sunlight(df.drop("parameter"), points)
    assert {"sun_station_id", "sun_latitude", "sun_longitude"} < set(sun.columns)
    with pytest.raises(Exception, match="(?i)parse"):
        panel.clean_wind(df.withColumn("to_time", F.lit("24:00")), points).collect()


def test_clean_and_sum_consumption(spark):
    df = spark.createDataFrame(
        [
            ("2024-01-01T00:00:00", "a", 101, None, "R", 1.5, 1),
            ("2024-01-01T00:00:00", "b", 101, "Kbh", "R", 2.0, 2),
            ("2024-01-01T00:00:00", "c", 101, "Other", "R", None, 3),
            ("2024-01-01T01:00:00", "d", 400, "Bornholm", "R", None, 4),
            ("2024-01-01T01:00:00", "e", None, "?", "R", 9.0, 5),
        ],
        "TimeUTC string, TimeDK string, MunicipalityCode int, Municipality string, RegionName string, ConsumptionkWh double, ord long",
    )
    got = panel.consumption_hourly(panel.clean_consumption(df))
    assert rows(stamp(got, "datetime")) == [
        ("00:00", 101, 3.5, "a", "Kbh", "R", "2"),
        ("01:00", 400, 0.0, "d", "Bornholm", "R", "2"),
    ]
    regions = spark.createDataFrame([("R", "2")], "RegionName string, area string")
    by_area = panel.consumption_by_area(panel.clean_consumption(df), regions)
    assert rows(stamp(by_area, "datetime")) == [("00:00", "2", 3.5), ("01:00", "2", 9.0)]


@pytest.fixture(scope="module")
def series(spark):
    def hours(data, schema):
        df = spark.createDataFrame(data, "h int, " + schema)
        return df.withColumn("datetime", F.make_timestamp(F.lit(2024), F.lit(1), F.lit(1), "h", F.lit(0), F.lit(0))).drop("h")

    prices = hours([(1, "1", 10.0), (1, "2", 20.0), (2, "1", 11.0)], "area string, price double")
    usage = hours([(1, "2", 101, 5.0), (2, "1", 751, 7.0)], "area string, municipality_code int, kwh double")
    sun = hours([(1, "2", 101, "s1", 30.0)], "area string, municipality_code int, sun string, sunshine_minutes double")
    wind = hours(
        [(1, "2", 101, "w1", 3.0), (1, "2", 101, "w2", 4.0), (2, "1", 751, "w3", 6.0), (2, "2", None, "w4", 8.0)],
        "area string, municipality_code int, wind string, value double",
    )
    return prices, usage, sun, wind


def test_global_fill_leaks_as_specified(series):
    got = panel.energy_panel(*series, fill="global", ties=["sun", "wind"])
    keep = ["datetime", "area", "municipality_code", "price", "kwh", "sunshine_minutes", "wind", "value"]
    assert rows(stamp(got.select(keep), "datetime")) == [
        # The price row of area 1 comes first, has no wind yet and drops out; its price flows on.
        ("01:00", "2", 101, 10.0, 5.0, 30.0, "w1", 3.0),
        ("01:00", "2", 101, 10.0, 5.0, 30.0, "w2", 4.0),
        ("01:00", "2", 101, 20.0, 5.0, 30.0, "w2", 4.0),
        ("02:00", "1", 751, 11.0, 7.0, 30.0, "w3", 6.0),
        ("02:00", "1", 751, 20.0, 7.0, 30.0, "w3", 6.0),
        ("02:00", "2", 751, 11.0, 7.0, 30.0, "w4", 8.0),
    ]


def test_keyed_fill_stays_within_the_area(series):
    got = panel.energy_panel(*series, fill="keyed", ties=["sun", "wind"])
    keep = ["datetime", "area", "municipality_code", "price", "kwh", "sunshine_minutes", "wind", "value"]
    assert rows(stamp(got.select(keep), "datetime")) == [
        ("01:00", "2", 101, 20.0, 5.0, 30.0, "w1", 3.0),
        ("01:00", "2", 101, 20.0, 5.0, 30.0, "w2", 4.0),
        ("02:00", "1", 751, 11.0, 7.0, 0.0, "w3", 6.0),
        ("02:00", "2", None, 20.0, 5.0, 0.0, "w4", 8.0),
    ]
    with pytest.raises(ValueError):
        panel.energy_panel(*series, fill="none")


def test_sorted_panel(series):
    got = panel.sorted_panel(panel.energy_panel(*series, ties=["sun", "wind"]), ["sun", "wind"]).collect()
    assert [r["wind"] for r in got] == ["w1", "w2", "w2", "w3", "w3", "w4"]
