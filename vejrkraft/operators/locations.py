"""Stations of several types rolled up to places."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vejrkraft import fixed_values as fv
from vejrkraft.functions.texts import place_label
from vejrkraft.operators.ordering import row_index

PLACE_DIGITS = 6


def location_rollup(df: DataFrame, order: str = "ord") -> DataFrame:
    """One row per place: coordinates equal to 6 digits.

    ``latitude, longitude, name`` are those of the first station in ``order``; ``types`` lists the
    station types by first appearance with the ``statuses`` of their first station. The types are
    the kinds of tables loaded, so the lists are short however many stations share a place: the
    stations are reduced to one row per (place, type) first, in a hash-friendly step.
    """
    lat, lng = F.bround("latitude", PLACE_DIGITS), F.bround("longitude", PLACE_DIGITS)
    rows = df.withColumns({"lat_rounded": lat, "lng_rounded": lng})
    if "status" not in df.columns:
        rows = rows.withColumn("status", F.lit(None).cast("string"))
    place = ["lat_rounded", "lng_rounded"]
    variants = rows.groupBy(*place, "station_type", "status", "name", "latitude", "longitude").agg(
        F.min(order).alias("at"), F.count(F.lit(1)).alias("n")
    )
    per_type = variants.groupBy(*place, "station_type").agg(
        F.min("at").alias("at"),
        F.sum("n").alias("n"),
        F.min_by(F.struct("status", "name", "latitude", "longitude"), "at").alias("first"),
    )
    names = variants.groupBy(*place).agg(F.count_distinct("name").alias("distinct_names"))
    by_type = F.struct("at", "station_type", "first.status")
    places = per_type.groupBy(*place).agg(
        F.min_by("first", "at").alias("first"),
        F.array_sort(F.collect_list(by_type)).alias("seen"),
        F.sum("n").alias("stations"),
    )
    single = F.size("seen") == 1
    types = F.col("seen.station_type")

    def style(table: dict[str, str], multi: str):
        known = F.coalesce(*[F.when(F.get(types, F.lit(0)) == t, F.lit(v)) for t, v in table.items()])
        return F.when(single, known).otherwise(F.lit(multi))

    return places.join(names, place).select(
        *place,
        F.col("first.latitude").alias("latitude"),
        F.col("first.longitude").alias("longitude"),
        F.col("first.name").alias("name"),
        "distinct_names",
        "stations",
        types.alias("types"),
        F.col("seen.status").alias("statuses"),
        F.when(single, F.get(types, F.lit(0))).otherwise(F.lit(fv.MULTI_CLASS)).alias("place_class"),
        style(fv.COLOURS, fv.MULTI_COLOUR).alias("colour"),
        style(fv.ICONS, fv.MULTI_ICON).alias("icon"),
        place_label(F.col("first.name"), types).alias("label"),
    )


def place_names(df: DataFrame, order: str = "ord") -> DataFrame:
    """The distinct names of every place in order of appearance: ``lat_rounded, lng_rounded, position`` (from 1)
    ``, name``.

    A long table, numbered range by range, so a place may have any number of names.
    """
    lat, lng = F.bround("latitude", PLACE_DIGITS), F.bround("longitude", PLACE_DIGITS)
    place = ["lat_rounded", "lng_rounded"]
    rows = df.where(F.col("name").isNotNull()).withColumns({"lat_rounded": lat, "lng_rounded": lng})
    first = rows.groupBy(*place, "name").agg(F.min(order).alias("_at"))
    return row_index(first, ["_at", "name"], by=place).select(*place, "position", "name")


def location_counts(places: DataFrame) -> DataFrame:
    """Places, places with a single type and places with several."""
    multi = F.col("place_class") == fv.MULTI_CLASS
    return places.agg(
        F.count(F.lit(1)).alias("locations"),
        F.count_if(~multi).alias("single_type"),
        F.count_if(multi).alias("multi_type"),
    )


def centroid(df: DataFrame) -> DataFrame:
    """Mean coordinate over stations (not places)."""
    return df.agg(F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude"))
