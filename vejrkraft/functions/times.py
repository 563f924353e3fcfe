"""Time parsing, formatting and calendar helpers. The session zone must be UTC."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vejrkraft import fixed_values as fv


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def interval_edge(col: str | Column, edge: str = "end") -> Column:
    """Start or end text of ``"start - end"``; null where the separator is missing."""
    parts = F.split(_col(col), fv.MARKET_INTERVAL_SEPARATOR)
    has_end = F.get(parts, F.lit(1)).isNotNull()
    return F.when(has_end, F.get(parts, F.lit({"start": 0, "end": 1}[edge])))


def market_time(col: str | Column) -> Column:
    """Day-ahead market time. Unreadable text fails the query."""
    return F.to_timestamp(_col(col), fv.MARKET_TIME)


def date_and_time(date: str | Column, time: str | Column) -> Column:
    """Timestamp from a date column and an ``HH:mm`` column. Unreadable text fails the query."""
    return F.to_timestamp(F.concat(_col(date), F.lit(" "), _col(time)), fv.DATE_AND_TIME)


def utc_time(col: str | Column, zone: str = "UTC") -> Column:
    """A wall-clock time of ``zone`` as UTC."""
    return _col(col) if zone == "UTC" else F.to_utc_timestamp(_col(col), zone)


def local_time(col: str | Column, zone: str = fv.DANISH_ZONE) -> Column:
    """UTC time as the wall-clock time of ``zone``."""
    return _col(col) if zone == "UTC" else F.from_utc_timestamp(_col(col), zone)


def iso_text(col: str | Column) -> Column:
    return F.date_format(_col(col), fv.ISO_TIME_UTC)


def iso_time(col: str | Column) -> Column:
    """ISO-8601 text, with or without offset, as a timestamp."""
    return _col(col).cast("timestamp")


def normalize_datetime(
    df: DataFrame, col: str, fmt: str | None = None, on_error: str = "null"
) -> DataFrame:
    """Rename ``col`` to ``datetime`` and make it a timestamp; bad text gives null or fails."""
    renamed = df.withColumnRenamed(col, "datetime")
    text = F.col("datetime")
    if dict(df.dtypes)[col].startswith("timestamp"):
        return renamed.withColumn("datetime", text.cast("timestamp"))
    pattern = [] if fmt is None else [F.lit(fmt)]
    if on_error == "null":
        return renamed.withColumn("datetime", F.try_to_timestamp(text, *pattern))
    if on_error == "raise":
        return renamed.withColumn("datetime", F.to_timestamp(text, *([fmt] if fmt else [])))
    raise ValueError(f"on_error must be 'null' or 'raise', not {on_error!r}")


def month_start(col: str | Column) -> Column:
    return F.trunc(_col(col), "MM")


def next_month(col: str | Column) -> Column:
    return F.add_months(month_start(col), 1)


def days_before(col: str | Column, days: int = fv.RECENT_DAYS) -> Column:
    """Date ``days`` before the date of ``col``."""
    return F.date_sub(_col(col).cast("date"), days)


def month_window(
    df: DataFrame, col: str, first: str, last: str | None = None, zone: str = "UTC"
) -> DataFrame:
    """Rows from the start of month ``first`` to the end of month ``last`` (half-open).

    The months are those of ``zone``; ``col`` is UTC. The zone is applied to the two bounds, so the
    filter on the column itself reaches the scan.
    """
    kind = dict(df.dtypes)[col]
    low = month_start(F.lit(first).cast("date"))
    high = next_month(F.lit(last or first).cast("date"))
    edges = [utc_time(c.cast("timestamp"), zone).cast(kind) for c in (low, high)]
    return df.where((F.col(col) >= edges[0]) & (F.col(col) < edges[1]))
