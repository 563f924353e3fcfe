"""The hourly panel: day-ahead prices, municipal consumption, sunshine and wind side by side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vejrkraft import fixed_values as fv
from vejrkraft.functions.areas import price_area
from vejrkraft.functions.times import date_and_time, interval_edge, market_time, normalize_datetime
from vejrkraft.operators.align import outer_align
from vejrkraft.operators.cleaning import (
    drop_null_rows,
    fill_with_zero,
    union_all,
    with_missing_columns,
)
from vejrkraft.operators.nearest import nearest_point
from vejrkraft.operators.ordering import ffill, nulls_last

KEYS = ["datetime", "area", "municipality_code"]
CONSUMPTION_LABELS = ["TimeDK", "Municipality", "RegionName", "area"]


def clean_prices(frames: Sequence[DataFrame], stamp: str = "end") -> DataFrame:
    """Day-ahead price tables of several areas as one, stamped with an edge of the interval."""
    prices = union_all(frames).drop("Intraday Period (UTC)", "Intraday Price (EUR/MWh)")
    stamped = prices.withColumn("datetime", market_time(interval_edge(F.col("`MTU (UTC)`"), stamp)))
    # Column names ignore case, so the label gives way to the area digit taken from it.
    return (
        stamped.withColumn("price_area", price_area("Area", "area"))
        .drop("MTU (UTC)", "Area")
        .withColumnRenamed("price_area", "area")
    )


def clean_consumption(df: DataFrame) -> DataFrame:
    """Consumption rows with a UTC ``datetime`` and the price area of the municipality."""
    timed = normalize_datetime(df, "TimeUTC", fv.ISO_TIME, on_error="raise")
    return timed.withColumnRenamed("MunicipalityCode", "municipality_code").withColumn(
        "area", price_area("municipality_code", "municipality")
    )


def _clean_weather(df: DataFrame, points: DataFrame, prefix: str) -> DataFrame:
    located = (
        df.withColumn("datetime", date_and_time("date", "to_time"))
        .withColumn("area", price_area("longitude", "longitude"))
        .transform(nearest_point, points, out="municipality_code")
    )
    return located.withColumnsRenamed(
        {c: f"{prefix}_{c}" for c in ("latitude", "longitude", "station_id", "ord")}
    )


def clean_sunlight(df: DataFrame, points: DataFrame) -> DataFrame:
    """Hourly sunshine with ``datetime``, area by longitude and the nearest municipality."""
    return _clean_weather(df, points, "sun")


def clean_wind(df: DataFrame, points: DataFrame, parameter: str = fv.MEAN_WIND_SPEED) -> DataFrame:
    """Hourly mean wind speed with ``datetime``, area by longitude and the nearest municipality."""
    return _clean_weather(df.where(F.col("parameter") == parameter), points, "wind")


def consumption_hourly(
    df: DataFrame,
    keys: Sequence[str] = ("datetime", "municipality_code"),
    value: str = "ConsumptionkWh",
    labels: Sequence[str] = tuple(CONSUMPTION_LABELS),
    order: str = "ord",
) -> DataFrame:
    """Sum of ``value`` and first known value of each label per key.

    Rows without a key are dropped, and a sum of nothing is 0. Rows are first added up per key *and*
    labels: that step hash-aggregates before the shuffle, so a key with very many rows leaves a row per combination. The
    combinations of a key are then put together and sorted once, after their shuffle.
    """
    keys, labels = list(keys), list(labels)
    combos = (
        drop_null_rows(df, keys)
        .groupBy(*keys, *labels)
        .agg(F.sum(value).alias("_sum"), F.min(order).alias("_at"))
    )
    total = F.coalesce(F.sum("_sum"), F.lit(0.0)).alias(value)
    first = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col("_at"))).alias(c) for c in labels]
    return combos.repartition(*keys).groupBy(*keys).agg(total, *first)


def consumption_by_area(
    df: DataFrame,
    regions: DataFrame,
    time: str = "datetime",
    region: str = "RegionName",
    area: str = "area",
    value: str = "ConsumptionkWh",
) -> DataFrame:
    """Sum of ``value`` per hour and area, the area looked up by region name.

    ``regions`` maps region to area, one row each. Rows of unknown regions have no area and drop out.
    """
    mapped = df.drop(area).join(regions.select(region, area), region, "left")
    keys = [time, area]
    return drop_null_rows(mapped, keys).groupBy(*keys).agg(
        F.coalesce(F.sum(value), F.lit(0.0)).alias(value)
    )


def energy_panel(
    prices: DataFrame,
    consumption: DataFrame,
    sunlight: DataFrame,
    wind: DataFrame,
    fill: str = "global",
    sunshine: str = "sunshine_minutes",
    wind_value: str = "value",
    ties: Sequence[str] = (),
    fill_by: Sequence[str] = ("area",),
    buckets: int | None = None,
) -> DataFrame:
    """Panel of all four series on (hour, area, municipality).

    ``fill="global"``: full outer alignment, then a forward fill of every column, keys included,
    over the whole table in key order (nulls last). Prices have no municipality, so they stand in
    rows of their own and flow into whatever row comes next.

    ``fill="keyed"``: prices are joined on (hour, area), the measures are filled within
    ``fill_by`` only, and missing sunshine is 0. This is the form whose numbers mean something.

    Either way sunshine becomes 0 where still unknown, and rows without wind drop out. ``ties``
    are the columns that order rows with equal keys.
    """
    typed = {"area": "string", "municipality_code": "int"}
    frames = [
        with_missing_columns(f, typed).withColumns({c: F.col(c).cast(t) for c, t in typed.items()})
        for f in (prices, consumption, sunlight, wind)
    ]
    order = [*KEYS, *ties]
    if fill == "global":
        filled = ffill(outer_align(frames, KEYS), order, buckets=buckets)
    elif fill == "keyed":
        aligned = outer_align(frames[1:], KEYS)
        hourly = frames[0].drop("municipality_code")
        clash = [c for c in hourly.columns if c in aligned.columns and c not in KEYS]
        hourly = hourly.withColumnsRenamed({c: f"{c}_price" for c in clash})
        joined = aligned.join(hourly, ["datetime", "area"], "left")
        joined = fill_with_zero(joined, [sunshine])
        measures = [c for c in joined.columns if c not in (*KEYS, *ties)]
        filled = ffill(joined, order, by=fill_by, cols=measures, buckets=buckets)
    else:
        raise ValueError(f"fill must be 'global' or 'keyed', not {fill!r}")
    return drop_null_rows(fill_with_zero(filled, [sunshine]), [wind_value])


def sorted_panel(panel: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    return panel.orderBy(*nulls_last([*KEYS, *ties]))
