"""One row per weather station: what it measures, how much, since when, and where it stands.

Observations come with ``station_id, parameter, observed_from (text or timestamp), value,
latitude, longitude, arrival``; ``arrival`` is the place of the observation within its parameter
(page offset plus position in the page) and decides every first/last choice. Details come with
``station_id, name, country, status, valid_from, valid_to, arrival``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vejrkraft import fixed_values as fv
from vejrkraft.functions.numbers import ratio_if_positive, round_even, zero_as_null
from vejrkraft.functions.texts import join_present

DETAIL_COLUMNS = ["name", "country", "status", "valid_from", "valid_to"]
# Arrival numbers of one parameter stay below this, so (parameter, arrival) packs in one long and
# the first/last choices can be hash-aggregated.
_ARRIVAL_SPAN = 1 << 48


def first_by(value: Column, arrival: Column, where: Column | None = None) -> Column:
    """Value of the earliest row (that meets ``where``)."""
    return F.min_by(value, arrival if where is None else F.when(where, arrival))


def last_by(value: Column, arrival: Column, where: Column | None = None) -> Column:
    """Value of the latest row (that meets ``where``)."""
    return F.max_by(value, arrival if where is None else F.when(where, arrival))


def latest_details(
    details: DataFrame, key: str = "station_id", order: str = "arrival", cols: Sequence[str] = ()
) -> DataFrame:
    """One row per station: the last details row in ``order``, nulls included."""
    cols = list(cols or DETAIL_COLUMNS)
    last = F.max_by(F.struct(*cols), order).alias("last")
    return details.groupBy(key).agg(last).select(key, "last.*")


def enrich(
    profile: DataFrame,
    details: DataFrame,
    key: str = "station_id",
    order: str = "arrival",
    cols: Sequence[str] = (),
    defaults: Sequence[str] = ("name", "country", "status"),
    unmatched: Sequence[str] = (),
) -> DataFrame:
    """Left join of the latest details.

    A matched station gets 'Unknown' for a missing value in ``defaults``; a station without
    details gets it for the columns in ``unmatched`` and null elsewhere.
    """
    cols = list(cols or DETAIL_COLUMNS)
    latest = latest_details(details, key, order, cols).withColumn("_matched", F.lit(True))
    joined = profile.join(latest, key, "left")
    filled = {}
    for c in cols:
        known = F.col(c)
        if c in defaults:
            known = F.when(F.col("_matched"), F.coalesce(c, F.lit(fv.UNKNOWN)))
        if c in unmatched:
            known = F.coalesce(known, F.when(F.col("_matched").isNull(), F.lit(fv.UNKNOWN)))
        filled[c] = known
    return joined.withColumns(filled).drop("_matched")


def known_details(details: DataFrame, stations: DataFrame, key: str = "station_id") -> DataFrame:
    """Details of the given stations only."""
    return details.join(stations.select(key), key, "left_semi")


def _span(prefix: str, time: Column) -> list[Column]:
    return [F.min(time).alias(f"first_{prefix}_date"), F.max(time).alias(f"last_{prefix}_date")]


def _times(obs: DataFrame, as_timestamp: bool) -> DataFrame:
    # Instants are hash-aggregated; text would be compared as text, whatever its offset, and sorted. A text that
    # is no time counts as an observation without a time.
    return obs.withColumn("observed_from", F.col("observed_from").try_cast("timestamp")) if as_timestamp else obs


def sunlight_profile(
    obs: DataFrame, details: DataFrame | None = None, as_timestamp: bool = True
) -> DataFrame:
    """Stations with sunshine or radiation observations.

    Coordinates: those of the last sunshine observation, else of the first radiation one.
    """
    sun = F.col("parameter") == fv.SUNSHINE
    rad = F.col("parameter") == fv.RADIATION
    time, at = F.col("observed_from"), F.col("arrival")
    place = [
        F.coalesce(
            F.when(F.count_if(sun) > 0, last_by(F.col(c), at, sun)),
            F.when(F.count_if(sun) == 0, first_by(F.col(c), at, rad)),
        ).alias(c)
        for c in ("latitude", "longitude")
    ]
    profile = (
        _times(obs, as_timestamp)
        .where(F.col("parameter").isin(fv.SUNSHINE, fv.RADIATION))
        .groupBy("station_id")
        .agg(
            *place,
            F.count_if(sun).alias("sunshine_observations"),
            F.count_if(rad).alias("radiation_observations"),
            *_span("sunshine", F.when(sun, time)),
            *_span("radiation", F.when(rad, time)),
        )
        .withColumn("measures_sunshine", F.col("sunshine_observations") > 0)
        .withColumn("measures_radiation", F.col("radiation_observations") > 0)
    )
    labels = {fv.SUNSHINE: F.col("measures_sunshine"), fv.RADIATION: F.col("measures_radiation")}
    profile = profile.withColumn("measurement_types", join_present(labels))
    return _ordered(
        profile if details is None else enrich(profile, details, unmatched=("country", "status")),
        ["station_id", *DETAIL_COLUMNS[:2], "latitude", "longitude", *DETAIL_COLUMNS[2:]],
    )


def wind_profile(
    obs: DataFrame,
    details: DataFrame | None = None,
    parameters: Sequence[str] = tuple(fv.WIND_PARAMETERS),
    as_timestamp: bool = True,
) -> DataFrame:
    """Stations with wind observations: counts per parameter, time range and speed extremes.

    Coordinates are the first known ones in collection order (parameter by parameter).
    """
    param = F.col("parameter")
    speed = F.when(param.contains(fv.SPEED_MARK), F.col("value"))
    rank = F.coalesce(*[F.when(param == p, F.lit(i)) for i, p in enumerate(parameters)])
    arrival = F.col("arrival")
    too_large = F.raise_error(F.concat(F.lit("arrival out of range: "), arrival.cast("string")))
    arrival = F.when(arrival.between(0, _ARRIVAL_SPAN - 1), arrival).when(arrival.isNotNull(), too_large)
    at = rank.cast("long") * _ARRIVAL_SPAN + arrival
    located = F.col("latitude").isNotNull()
    profile = (
        _times(obs, as_timestamp)
        .where(param.isin(list(parameters)))
        .groupBy("station_id")
        .agg(
            first_by(F.col("latitude"), at, located).alias("latitude"),
            first_by(F.col("longitude"), at, located).alias("longitude"),
            F.count(F.lit(1)).alias("total_wind_observations"),
            *[F.count_if(param == p).alias(f"{p}_observations") for p in parameters],
            *_span("wind", F.col("observed_from")),
            F.max(speed).alias("max_wind_speed_recorded_ms"),
            F.min(speed).alias("min_wind_speed_recorded_ms"),
        )
    )
    has = {p: F.col(f"{p}_observations") > 0 for p in parameters}
    profile = profile.withColumns(
        {
            # The parameters are a fixed list, so their sorted set needs no collecting.
            "wind_parameters_measured": join_present({p: has[p] for p in sorted(parameters)}),
            "parameter_count": sum([f.cast("int") for f in has.values()], F.lit(0)),
            **{f"measures_{p}": f for p, f in has.items()},
        }
    )
    return _ordered(
        profile if details is None else enrich(profile, details),
        [
            "station_id", *DETAIL_COLUMNS[:2], "latitude", "longitude", *DETAIL_COLUMNS[2:],
            "wind_parameters_measured", "parameter_count", *[f"measures_{p}" for p in parameters],
        ],
    )


def precipitation_amounts(value: Column) -> dict[str, Column]:
    """Aggregates of precipitation values: the mean divides by *all* rows, valueless ones included."""
    total = F.coalesce(F.sum(value), F.lit(0.0))
    return {
        "min_precipitation_mm": F.min(value),
        "max_precipitation_mm": F.max(value),
        "avg_precipitation_mm": ratio_if_positive(total, F.count(F.lit(1))),
        "total_precipitation_sample_mm": zero_as_null(total),
    }


def precipitation_profile(
    obs: DataFrame, details: DataFrame | None = None, as_timestamp: bool = True, digits: int = 2
) -> DataFrame:
    """Stations with precipitation observations: counts, time range and amounts."""
    amounts = precipitation_amounts(F.col("value"))
    located = F.col("latitude").isNotNull()
    profile = (
        _times(obs, as_timestamp)
        .where(F.col("parameter") == fv.PRECIPITATION)
        .groupBy("station_id")
        .agg(
            first_by(F.col("latitude"), F.col("arrival"), located).alias("latitude"),
            first_by(F.col("longitude"), F.col("arrival"), located).alias("longitude"),
            F.count(F.lit(1)).alias("precipitation_observations"),
            *_span("precipitation", F.col("observed_from")),
            *[agg.alias(name) for name, agg in amounts.items()],
        )
    )
    rounded = ["avg_precipitation_mm", "total_precipitation_sample_mm"]
    profile = profile.withColumns({c: round_even(c, digits) for c in rounded})
    return _ordered(
        profile if details is None else enrich(profile, details),
        ["station_id", *DETAIL_COLUMNS[:2], "latitude", "longitude", *DETAIL_COLUMNS[2:]],
    )


def _ordered(df: DataFrame, first: Sequence[str]) -> DataFrame:
    first = [c for c in first if c in df.columns]
    return df.select(*first, *[c for c in df.columns if c not in first])
