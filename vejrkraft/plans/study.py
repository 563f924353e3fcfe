"""The price study from files: read, clean, align, and look at correlations and outliers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vejrkraft import schemas
from vejrkraft.operators.stats import box_stats, corr_matrix
from vejrkraft.plans import panel
from vejrkraft.session import staged
from vejrkraft.sources.files import read_csv, read_zipped_csv
from vejrkraft.sources.stations import read_points


def load_series(
    spark: SparkSession,
    prices: Sequence[str],
    sunlight: str,
    wind: str,
    points: str,
    consumption_zip: str | None = None,
    consumption: str | None = None,
    stamp: str = "end",
) -> list[DataFrame]:
    """The four cleaned series from day-ahead price CSVs, a consumption CSV (zipped or not), and the hourly
    sunshine and wind CSVs (semicolon). Sunshine and wind keep their place in the file as ``sun_ord`` and ``wind_ord``."""
    if (consumption_zip is None) == (consumption is None):
        raise ValueError("consumption comes from a zipped file or a plain one")
    spots = read_points(spark, points)
    if consumption:
        usage = read_csv(spark, consumption, schemas.CONSUMPTION_TYPES, numbered=True)
    else:
        usage = read_zipped_csv(spark, consumption_zip, schemas.CONSUMPTION_COLUMNS, schemas.CONSUMPTION_TYPES)
        # Several archives: the rows of each one follow those of the one before.
        usage = usage.withColumn("ord", F.struct("archive", "entry", "ord"))
    return [
        panel.clean_prices([read_csv(spark, p, schemas.PRICE_TYPES) for p in prices], stamp),
        panel.consumption_hourly(panel.clean_consumption(usage)),
        panel.clean_sunlight(read_csv(spark, sunlight, schemas.SUNLIGHT_TYPES, sep=";", numbered=True), spots),
        panel.clean_wind(read_csv(spark, wind, schemas.WIND_TYPES, sep=";", numbered=True), spots),
    ]


def price_study(series: Sequence[DataFrame], fill: str = "global") -> dict[str, DataFrame]:
    """Panel, correlation matrix and box statistics of the four series.

    Rows with equal keys are ordered by their stations, then by their places in the files, so no two are equal.
    """
    known = {c for f in series for c in f.columns}
    ties = [c for c in ("sun_station_id", "wind_station_id", "sun_ord", "wind_ord") if c in known]
    joined = staged(panel.energy_panel(*series, fill=fill, ties=ties))
    return {"panel": joined, "correlation": corr_matrix(joined), "boxes": box_stats(joined)}
