"""Month calendars and request plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vejrkraft import fixed_values as fv
from vejrkraft.functions.times import iso_text, month_start, next_month


def _months(first: Column, last: Column) -> Column:
    return F.sequence(month_start(first), month_start(last), F.expr("interval 1 month"))


def _windows(df: DataFrame) -> DataFrame:
    begin, end = F.col("month"), next_month("month")
    return df.withColumns(
        {
            "year": F.year("month"),
            "window_start": iso_text(begin.cast("timestamp")),
            "window_end": iso_text(end.cast("timestamp")),
        }
    ).withColumn("month", F.month("month"))


def month_calendar(
    spark: SparkSession,
    first: str = fv.CONSUMPTION_FIRST_MONTH,
    last: str = fv.CONSUMPTION_LAST_MONTH,
) -> DataFrame:
    """One row per month with its half-open UTC window."""
    months = _months(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return _windows(spark.range(1).select(F.explode(months).alias("month")))


def month_grid(stations: DataFrame, first: str, last: str) -> DataFrame:
    """One row per station and month: the request plan of a collection."""
    months = _months(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return _windows(stations.withColumn("month", F.explode(months)))


def month_coverage(df: DataFrame, time: Column, calendar: DataFrame) -> DataFrame:
    """Months processed, months with data, rows, and the estimated size in MB."""
    counts = df.groupBy(F.year(time).alias("year"), F.month(time).alias("month")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    rows = F.coalesce(F.sum("_n"), F.lit(0).cast("long"))
    return (
        calendar.join(counts, ["year", "month"], "left")
        .agg(
            F.count(F.lit(1)).alias("months_processed"),
            F.count_if(F.col("_n") > 0).alias("months_with_data"),
            rows.alias("total_records"),
        )
        .withColumn(
            "estimated_mb", F.col("total_records") * fv.ASSUMED_RECORD_BYTES / F.lit(float(1 << 20))
        )
    )
