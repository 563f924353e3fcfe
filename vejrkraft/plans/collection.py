"""From landed pages to collected observations and station profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vejrkraft import fixed_values as fv
from vejrkraft.operators import profiles
from vejrkraft.operators.cleaning import clean_observations
from vejrkraft.operators.grids import month_calendar, month_coverage
from vejrkraft.operators.ordering import nulls_last
from vejrkraft.operators.summaries import observation_summary
from vejrkraft.session import staged
from vejrkraft.sinks.files import write_by_month, write_by_year
from vejrkraft.sources import pages
from vejrkraft.sources.pages import read_record_pages
from vejrkraft.sources.stations import station_dimension


def stations_for(spark: SparkSession, parameter: str) -> DataFrame:
    """The stations a collection of ``parameter`` asks for."""
    lists = {fv.MEAN_WIND_SPEED: fv.WIND_STATIONS, fv.SUNSHINE: fv.SUNSHINE_STATIONS}
    return station_dimension(spark, lists[parameter])


def collect_observations(obs: DataFrame, stations: DataFrame, parameter: str) -> DataFrame:
    """``timeObserved, stationId, stationName, <parameter>`` of the given stations.

    Rows without a value drop out. An observation met in two adjacent windows counts once: the first
    to arrive, if they differ; the same instant with two offsets is one observation.
    """
    known = obs.where(F.col("parameter") == parameter).join(
        stations.select("station_id", F.col("name").alias("stationName")), "station_id"
    )
    instant = F.col("observed_from").try_cast("timestamp")
    # A time that cannot be read is an observation of its own.
    unread = F.when(instant.isNull(), F.col("observed_from"))
    kept = clean_observations(
        known, key=["station_id", instant, unread], order=["arrival", "value", "observed_from"]
    )
    return kept.select(
        F.col("observed_from").try_cast("timestamp").alias("timeObserved"),
        F.col("station_id").alias("stationId"),
        "stationName",
        F.col("value").alias(parameter),
    )


def collect_year(
    obs: DataFrame, parameter: str, folder: str, overwrite: bool = False
) -> DataFrame | None:
    """Write the collected observations by year; their summary, or None if there was nothing."""
    # What is written is what is summarised.
    data = staged(collect_observations(obs, stations_for(obs.sparkSession, parameter), parameter))
    if not write_by_year(data, folder, overwrite=overwrite):
        return None
    return observation_summary(data, "timeObserved", parameter, "stationId")


def collect_consumption(
    spark: SparkSession, page_folder: str, folder: str, overwrite: bool = False, lines: bool = False
) -> DataFrame | None:
    """Write the consumption records by month; their coverage of the calendar, or None."""
    records = read_record_pages(spark, page_folder, lines=lines).drop("ord")
    if not write_by_month(records, folder, overwrite=overwrite):
        return None
    return month_coverage(records, F.col("TimeUTC").cast("timestamp"), month_calendar(spark))


def profile_stations(
    spark: SparkSession, kind: str, page_folder: str, detail_folder: str, reject_folder: str, lines: bool = False
) -> DataFrame:
    """Sorted station profile of one kind ('wind', 'precipitation', 'sunlight') from every landed page.

    Features that were rejected are written, with the reason, to ``observations`` and ``details`` under
    ``reject_folder`` (replaced if there). ``lines``: files hold a page per line.
    """
    landed = pages.last_landings(pages.read_observation_pages(spark, page_folder, lines))
    obs, bad_obs = pages.observations(landed)
    detail_pages = pages.last_landings(pages.read_detail_pages(spark, detail_folder, lines), by=())
    details, bad_details = pages.station_details(detail_pages)
    for name, bad in (("observations", bad_obs), ("details", bad_details)):
        bad.write.mode("overwrite").parquet(f"{reject_folder.rstrip('/')}/{name}")
    if kind == "sunlight":
        return profiles.sunlight_profile(obs, details, as_timestamp=True).orderBy("station_id")
    if kind == "wind":
        order = ["country", -F.col("parameter_count"), "station_id"]
        return profiles.wind_profile(obs, details, as_timestamp=True).orderBy(*nulls_last(order))
    if kind == "precipitation":
        profile = profiles.precipitation_profile(obs, details, as_timestamp=True)
        return profile.orderBy(*nulls_last(["country", "station_id"]))
    raise ValueError(f"unknown kind of station profile: {kind!r}")
