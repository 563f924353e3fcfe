"""File outputs: partitioned tables, CSV, JSON arrays and the analytics area."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vejrkraft.functions.documents import json_array_pieces
from vejrkraft.operators.cleaning import sorted_columns
from vejrkraft.operators.ordering import nulls_last
from vejrkraft.sinks.commit import write_parts


def write_csv(df: DataFrame, folder: str, overwrite: bool = False, sep: str = ",") -> bool:
    """CSV with header. Nothing is written for an empty table; returns whether something was."""
    if df.isEmpty():
        return False
    writer = df.write.mode("overwrite" if overwrite else "errorifexists")
    writer.option("header", True).option("sep", sep).csv(folder)
    return True


def _write_parts(
    df: DataFrame, folder: str, parts: Sequence[str], order: Sequence[str], fmt: str, overwrite: bool
) -> bool:
    keys = [*parts, *order]
    # Ranges over partition and order: sorted files, and a hot year spreads over several tasks.
    laid = df.repartitionByRange(*nulls_last(keys)).sortWithinPartitions(*nulls_last(keys))
    writer = laid.write.partitionBy(*parts).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    return write_parts(df.sparkSession, writer, folder, len(parts), overwrite)


def write_by_year(
    df: DataFrame,
    folder: str,
    time: str = "timeObserved",
    order: Sequence[str] = ("stationId", "timeObserved"),
    fmt: str = "parquet",
    overwrite: bool = False,
) -> bool:
    """One partition per year, sorted by station and time, put in place as a whole. A year already there, or in the hands of another
    writer, is refused; with ``overwrite`` the years at hand are replaced. An empty table writes nothing."""
    return _write_parts(df.withColumn("year", F.year(time)), folder, ["year"], order, fmt, overwrite)


def write_by_month(
    df: DataFrame,
    folder: str,
    time: str = "TimeUTC",
    fmt: str = "parquet",
    overwrite: bool = False,
) -> bool:
    """One partition per month, columns in alphabetical order; the folder as a whole is the
    combined table. Months are put in place as years are by ``write_by_year``."""
    stamp = F.col(time).cast("timestamp")
    parted = sorted_columns(df).withColumns({"year": F.year(stamp), "month": F.month(stamp)})
    return _write_parts(parted, folder, ["year", "month"], [time], fmt, overwrite)


def write_json_arrays(
    df: DataFrame, folder: str, order: Sequence[str], keys: Sequence[str] = (), overwrite: bool = False
) -> None:
    """JSON array documents as text, one folder per key: its files in name order, joined, are the
    array."""
    pieces = json_array_pieces(df, order, keys, [c for c in df.columns if c not in keys])
    place = nulls_last([*keys, *order])
    laid = pieces.repartitionByRange(*place).sortWithinPartitions(*place)
    writer = laid.select(*keys, F.col("piece").alias("value")).write
    writer = writer.mode("overwrite" if overwrite else "errorifexists")
    if keys:
        writer = writer.partitionBy(*keys)
    writer.text(folder)


def write_json_document(df: DataFrame, folder: str, order: Sequence[str], overwrite: bool = False) -> DataFrame:
    """One JSON array of all rows in ``order`` (unique, nulls last), as part files and a manifest, which is returned.

    Every task writes one range of the rows as one file. The manifest, also kept under ``_manifest``, has one row per file:
    part, path, offset, bytes. The files joined in that order are the document, and ``offset`` is the place of a file in it, so parts
    can be fetched or put together side by side. An empty table is the document `[]`.
    """
    spark = df.sparkSession
    place = nulls_last(order)
    pieces = json_array_pieces(df, order, (), df.columns)
    laid = pieces.repartitionByRange(*place).sortWithinPartitions(*place).select(F.col("piece").alias("value"))
    if df.isEmpty():
        laid = spark.range(1).select(F.lit("[]").alias("value"))
    laid.write.mode("overwrite" if overwrite else "errorifexists").text(folder)
    # Only names and sizes are read. One row per task of the write.
    files = spark.read.format("binaryFile").load(folder).select("path", F.col("length").alias("bytes"))
    files = files.withColumn("part", F.regexp_extract("path", r"part-(\d+)", 1).cast("long"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    manifest = files.withColumn("offset", F.coalesce(F.sum("bytes").over(before), F.lit(0).cast("long")))
    manifest.select("part", "path", "offset", "bytes").write.mode("overwrite").json(f"{folder.rstrip('/')}/_manifest")
    return document_parts(spark, folder)


def document_parts(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest of a document written by ``write_json_document``."""
    return spark.read.schema("part long, path string, offset long, bytes long").json(f"{folder.rstrip('/')}/_manifest")


def write_analytics(df: DataFrame, base: str, name: str) -> str:
    """Result table for reports, replaced as a whole."""
    path = f"{base.rstrip('/')}/analytics/{name}"
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return path


def publish_batch(messages: DataFrame, servers: Sequence[str]) -> None:
    """Send ``(topic, value)`` rows to Kafka (needs the Kafka connector on the cluster)."""
    rows = messages.select("topic", F.col("value").cast("binary"))
    rows.write.format("kafka").option("kafka.bootstrap.servers", ",".join(servers)).save()
