"""The reports of the station exports and of the completeness check, as long tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vejrkraft import fixed_values as fv
from vejrkraft.functions.texts import date_part, fixed, thousands
from vejrkraft.operators import summaries
from vejrkraft.operators.cleaning import union_all


def _lines(df: DataFrame, section: str, item: Column | str, value: Column) -> DataFrame:
    label = F.lit(item) if isinstance(item, str) else item
    return df.select(F.lit(section).alias("section"), label.cast("string").alias("item"), value.alias("value"))


def profile_summary(
    profile: DataFrame,
    observations: str,
    first: str,
    last: str,
    flags: Mapping[str, str] | None = None,
    high: str | None = None,
    low: str | None = None,
    top: int = 5,
) -> DataFrame:
    """``section, item, value`` lines over a station profile: totals, status and country counts,
    coverage per parameter, time range, stations with most observations, extremes.

    The profile is read once per section; pass a stored one.
    """
    number = lambda c: thousands(F.col(c))
    totals = profile.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(observations), F.lit(0)).alias("obs"))
    parts = [
        _lines(totals, "total", "stations", number("n")),
        _lines(totals, "total", "observations", number("obs")),
        *[
            _lines(summaries.value_counts(profile, c), c, F.col("value"), number("n"))
            for c in ("status", "country")
        ],
    ]
    if flags:
        coverage = summaries.parameter_coverage(profile, flags)
        parts.append(_lines(coverage, "coverage", F.col("parameter"), number("stations")))
        parts.append(_lines(coverage.limit(1), "coverage", "all parameters", number("stations_with_all")))
    span = profile.agg(F.min(first).alias("a"), F.max(last).alias("b"))
    span = span.where(F.col("a").isNotNull() & F.col("b").isNotNull())
    day = lambda c: date_part(F.col(c).cast("string"))
    parts.append(_lines(span, "range", "dates", F.concat_ws(" to ", day("a"), day("b"))))
    best = summaries.top_rows(profile, observations, ["station_id"], top)
    parts.append(_lines(best, "top", F.col("station_id"), number(observations)))
    if high and low:
        ends = summaries.extreme_rows(profile, high, low, ["station_id", "name"], "station_id")
        at = F.concat(fixed(F.col("value"), 1), F.lit(" at "), F.coalesce("name", "station_id"))
        parts.append(_lines(ends, "extreme", F.col("extreme"), at))
    return union_all(parts)


def station_check(
    obs: DataFrame,
    details: DataFrame,
    time: str,
    reference: Column,
    expected: int = fv.EXPECTED_SUNLIGHT_STATIONS,
    days: int = fv.RECENT_DAYS,
) -> DataFrame:
    """``section, item, value`` lines of the completeness check: stations per parameter and
    together, countries and activity of all stations, recent stations, and the verdict.
    """
    text = lambda c: F.col(c).cast("string")
    found = summaries.distinct_stations(obs)
    activity = summaries.activity(details)
    recent = summaries.recent_stations(obs, time, reference, days)
    verdict = summaries.reconcile(obs, expected)
    return union_all(
        [
            _lines(found, "stations", F.coalesce("parameter", F.lit("together")), text("stations")),
            _lines(summaries.country_list(details), "country", F.col("country"), F.lit("present")),
            _lines(activity, "details", "stations", text("stations")),
            _lines(activity, "details", "active", text("active_stations")),
            _lines(recent, "recent", "stations", text("stations")),
            _lines(recent, "recent", "observations", text("observations")),
            _lines(verdict, "verdict", text("found"), F.col("verdict")),
        ]
    )
