"""Reports over observations and station profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vejrkraft import fixed_values as fv
from vejrkraft.functions.texts import date_part
from vejrkraft.functions.times import days_before
from vejrkraft.operators.ordering import running_total


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per non-null value, ready to be sorted by (count descending, value)."""
    return df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(
        F.count(F.lit(1)).alias("n")
    )


def activity(details: DataFrame) -> DataFrame:
    """Countries (missing = 'Unknown'), active and all stations of a details table."""
    country = F.coalesce("country", F.lit(fv.UNKNOWN))
    return details.agg(
        F.count_distinct(country).alias("countries"),
        F.count_if(F.col("status") == fv.ACTIVE).alias("active_stations"),
        F.count(F.lit(1)).alias("stations"),
    )


def country_list(details: DataFrame) -> DataFrame:
    """The distinct countries of a details table, one per row."""
    return details.select(F.coalesce("country", F.lit(fv.UNKNOWN)).alias("country")).distinct()


def flag_overlap(profile: DataFrame, a: str, b: str) -> DataFrame:
    """Stations with only ``a``, only ``b``, and both."""
    fa, fb = F.col(a), F.col(b)
    return profile.agg(
        F.count_if(fa & ~fb).alias("only_first"),
        F.count_if(~fa & fb).alias("only_second"),
        F.count_if(fa & fb).alias("both"),
        F.count(F.lit(1)).alias("stations"),
    )


def parameter_coverage(profile: DataFrame, flags: Mapping[str, str]) -> DataFrame:
    """Stations per parameter, and the stations that have all; ``flags``: parameter -> column."""
    every = F.lit(True)
    for c in flags.values():
        every = every & F.col(c)
    sums = profile.agg(
        *[F.count_if(F.col(c)).alias(f"n{i}") for i, c in enumerate(flags.values())],
        F.count_if(every).alias("all_parameters"),
    )
    pairs = F.array(
        *[
            F.struct(F.lit(p).alias("parameter"), F.col(f"n{i}").alias("stations"))
            for i, p in enumerate(flags)
        ]
    )
    return sums.select(F.inline(pairs), F.col("all_parameters").alias("stations_with_all"))


def time_range(profile: DataFrame, first: str, last: str) -> DataFrame:
    """Earliest first and latest last date over all stations, cut to the date."""
    return profile.agg(
        date_part(F.min(first).cast("string")).alias("earliest"),
        date_part(F.max(last).cast("string")).alias("latest"),
    )


def extreme_rows(
    profile: DataFrame, high: str, low: str, cols: Sequence[str], order: str
) -> DataFrame:
    """The rows with the highest ``high`` and the lowest ``low``; the first in ``order`` on ties.

    One row per extreme, none if the column is null throughout.
    """

    def pick(kind: str, value: Column, signed: Column) -> Column:
        row = F.struct(F.lit(kind).alias("extreme"), value.alias("value"), *cols)
        return F.min_by(row, F.when(value.isNotNull(), F.struct(signed, F.col(order))))

    best = profile.agg(
        pick("highest", F.col(high), -F.col(high)).alias("highest"),
        pick("lowest", F.col(low), F.col(low)).alias("lowest"),
    )
    both = best.select(F.explode(F.array("highest", "lowest")).alias("row"))
    return both.where(F.col("row").isNotNull()).select("row.*")


def top_rows(df: DataFrame, by: str, ties: Sequence[str], n: int = 5) -> DataFrame:
    """The ``n`` rows with the largest ``by``."""
    return df.orderBy(F.col(by).desc_nulls_last(), *ties).limit(n)


def distinct_stations(obs: DataFrame, key: str = "station_id") -> DataFrame:
    """Distinct stations per parameter, and over all parameters (parameter null)."""
    pairs = obs.select("parameter", key).distinct()
    per = pairs.groupBy("parameter").agg(F.count(key).alias("stations"))
    union = pairs.agg(
        F.lit(None).cast("string").alias("parameter"), F.count_distinct(key).alias("stations")
    )
    return per.unionByName(union)


SKETCH_BITS = 12


def sketch_error(bits: int = SKETCH_BITS) -> float:
    """Relative standard error of counts from merged sketches of 2^bits registers."""
    return 1.04 / 2 ** (bits / 2)


def station_sketches(
    obs: DataFrame, by: Sequence[str] = ("parameter", "page"), key: str = "station_id", bits: int = SKETCH_BITS
) -> DataFrame:
    """Per ``by``: rows, and a sketch of the distinct keys, to be stored next to the observations.

    A sketch holds 2^bits registers at most, whatever the number of keys; null keys do not count. Counts of any union of sketches
    follow without another look at the observations. An opt-in: ``distinct_stations`` stays exact.
    """
    return obs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), F.hll_sketch_agg(F.col(key), F.lit(bits)).alias("sketch")
    )


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Stored sketches united to ``by``: a coarser table of the same form. Sketches of different sizes unite to the least one's."""
    return sketches.groupBy(*by).agg(
        F.sum("rows").alias("rows"), F.hll_union_agg("sketch", F.lit(True)).alias("sketch")
    )


def sketched_stations(sketches: DataFrame) -> DataFrame:
    """Distinct stations per parameter, and over all parameters (parameter null), estimated from stored sketches with the error
    of ``sketch_error``."""
    per = merge_sketches(sketches, ["parameter"])
    union = merge_sketches(per).withColumn("parameter", F.lit(None).cast("string"))
    return per.unionByName(union).select("parameter", F.hll_sketch_estimate("sketch").alias("stations"))


def station_union(frames: Sequence[DataFrame], key: str = "station_id") -> DataFrame:
    """The set union of the station ids of several tables."""
    first, *rest = [f.select(key) for f in frames]
    for frame in rest:
        first = first.unionByName(frame)
    return first.distinct()


def page_accounting(obs: DataFrame, page: str = "page", key: str = "station_id") -> DataFrame:
    """Per parameter and page: rows, distinct stations, stations not seen on an earlier page, and
    distinct stations so far. ``page`` is a whole number.
    """
    seen = obs.groupBy("parameter", page, key).agg(F.count(F.lit(1)).alias("rows"))
    per_page = seen.groupBy("parameter", page).agg(
        F.sum("rows").alias("rows"), F.count(key).alias("stations")
    )
    fresh = (
        seen.where(F.col(key).isNotNull())
        .groupBy("parameter", key)
        .agg(F.min(page).alias(page))
        .groupBy("parameter", page)
        .agg(F.count(F.lit(1)).alias("new_stations"))
    )
    pages = per_page.join(fresh, ["parameter", page], "left").withColumn(
        "new_stations", F.coalesce("new_stations", F.lit(0).cast("long"))
    )
    # Ranges of pages: no task walks over all pages of a parameter.
    out = running_total(pages, "new_stations", [page], by=["parameter"], out="stations_so_far")
    return out.select("parameter", page, "rows", "stations", "new_stations", "stations_so_far")


def truncated_pages(obs: DataFrame, limit: int, page: str = "page") -> DataFrame:
    """Per parameter and page: rows, and whether the page is full, so more rows may exist."""
    return obs.groupBy("parameter", page).agg(
        F.count(F.lit(1)).alias("rows"), (F.count(F.lit(1)) >= limit).alias("full")
    )


def reconcile(
    obs: DataFrame, expected: int = fv.EXPECTED_SUNLIGHT_STATIONS, key: str = "station_id"
) -> DataFrame:
    """Distinct stations found against the expected number."""
    found = F.col("found")
    verdict = F.when(found > expected, "more").when(found == expected, "equal").otherwise("fewer")
    return (
        obs.agg(F.count_distinct(key).alias("found"))
        .withColumn("expected", F.lit(expected).cast("long"))
        .withColumn("verdict", verdict)
    )


def recent_rows(
    obs: DataFrame, time: str, reference: Column, days: int = fv.RECENT_DAYS
) -> DataFrame:
    """Rows from ``days`` before the date of ``reference`` up to the start of that date."""
    kind = dict(obs.dtypes)[time]
    low = days_before(reference, days).cast(kind)
    high = days_before(reference, 0).cast(kind)
    return obs.where((F.col(time) >= low) & (F.col(time) <= high))


def recent_stations(
    obs: DataFrame, time: str, reference: Column, days: int = fv.RECENT_DAYS, key: str = "station_id"
) -> DataFrame:
    """Distinct stations and observations in the recent window."""
    return recent_rows(obs, time, reference, days).agg(
        F.count_distinct(key).alias("stations"), F.count(F.lit(1)).alias("observations")
    )


def recent_sample(
    obs: DataFrame,
    time: str,
    reference: Column,
    days: int = fv.RECENT_DAYS,
    n: int = fv.SAMPLE_STATIONS,
    key: str = "station_id",
) -> DataFrame:
    """The first ``n`` station ids of the recent window."""
    return recent_rows(obs, time, reference, days).select(key).distinct().orderBy(key).limit(n)


def observation_summary(obs: DataFrame, time: str, value: str, key: str = "station_id") -> DataFrame:
    return obs.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(time).alias("first_time"),
        F.max(time).alias("last_time"),
        F.count_distinct(key).alias("stations"),
        F.avg(value).alias("mean_value"),
        F.max(value).alias("max_value"),
    )


def station_coverage(stations: DataFrame, obs: DataFrame, key: str = "station_id") -> DataFrame:
    """Stations for which any observation came, valueless ones included, out of all stations."""
    counts = obs.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return stations.select(key).join(counts, key, "left").agg(
        F.count_if(F.col("_n") > 0).alias("stations_with_data"),
        F.count(F.lit(1)).alias("stations"),
    )
