"""Landed service pages: ``parameter=…/offset=…/*.json`` for observations, ``offset=…`` or one folder else.

A page is one JSON document of a limited number of rows, in a file of its own; with ``lines=True`` files hold a page per line, with its
``offset`` (``parameter=…/*`` for observations), so their number does not grow with that of the pages. Every landed page is read. What a set of pages
lacks or holds twice is told by ``page_ledger``; it never decides which rows are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vejrkraft import fixed_values as fv
from vejrkraft.functions.documents import coordinate
from vejrkraft.functions.numbers import to_number
from vejrkraft.operators.cleaning import split_rejects
from vejrkraft.schemas import CONSUMPTION_RECORD, DETAIL_PAGE, OBSERVATION_PAGE


def _read(spark: SparkSession, folder: str, schema: str, lines: bool) -> DataFrame:
    """Pages with when and from where they were landed, and of a file's ``lines`` their order."""
    pages = spark.read.schema(schema).option("multiLine", not lines).json(folder)
    landing = {
        "landed_at": F.col("_metadata.file_modification_time"),
        "file": F.col("_metadata.file_path"),
    }
    if lines:
        # A block's lines are numbered as they are read.
        landing["line"] = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    return pages.withColumns(landing)


def _landing(pages: DataFrame) -> list[str]:
    return [c for c in ("landed_at", "file", "line") if c in pages.columns]


def read_observation_pages(spark: SparkSession, folder: str, lines: bool = False) -> DataFrame:
    """``parameter, offset, features, landed_at, file``: one row per landing of a page."""
    return _read(spark, folder, OBSERVATION_PAGE, lines)


def read_detail_pages(spark: SparkSession, folder: str, lines: bool = False) -> DataFrame:
    """``offset, features, landed_at, file``; the offset is null in a folder that is not cut by it."""
    return _read(spark, folder, DETAIL_PAGE, lines)


def read_record_documents(
    spark: SparkSession, folder: str, record: str = CONSUMPTION_RECORD, lines: bool = False
) -> DataFrame:
    """``offset, records, landed_at, file`` of ``{"records": [...]}`` pages; record fields as ``name: type, …``."""
    return _read(spark, folder, f"records array<struct<{record}>>, offset bigint", lines)


def last_landings(pages: DataFrame, by: Sequence[str] = ("parameter",)) -> DataFrame:
    """Each page once, by its last landing. Pages without an offset are told apart by their file (and line)."""
    landing = _landing(pages)
    unplaced = F.when(F.col("offset").isNull(), F.struct(*landing[1:]))
    last = Window.partitionBy(*by, "offset", unplaced).orderBy(*[F.desc(c) for c in landing])
    return pages.withColumn("_rank", F.rank().over(last)).where("_rank = 1").drop("_rank")


def page_ledger(
    pages: DataFrame,
    limit: int = fv.OBSERVATION_PAGE_ROWS,
    items: str = "features",
    by: Sequence[str] = ("parameter",),
) -> DataFrame:
    """One row per page: ``offset, landings, rows`` (of the last landing), ``full`` (more rows may follow), ``gap_before``
    (the page before was not landed) and ``last`` (the page after was not landed).

    A page tells its neighbours by two more rows, so no task walks over all pages.
    """
    landing = _landing(pages)
    sizes = pages.select(
        *by, "offset", *landing, F.coalesce(F.size(items), F.lit(0)).alias("rows")
    )
    told = sizes.withColumn(
        "told",
        F.explode(
            F.array(
                F.struct(F.col("offset").alias("place"), F.lit(0).alias("step")),
                F.struct((F.col("offset") + limit).alias("place"), F.lit(1).alias("step")),
                F.struct((F.col("offset") - limit).alias("place"), F.lit(-1).alias("step")),
            )
        ),
    ).select(*by, "told.*", *landing, "rows")
    step = F.col("step")
    here = step == 0
    return (
        told.groupBy(*by, F.col("place").alias("offset"))
        .agg(
            F.count_if(here).alias("landings"),
            F.max_by("rows", F.when(here, F.struct(*landing))).alias("rows"),
            F.count_if(step == 1).alias("_before"),
            F.count_if(step == -1).alias("_after"),
        )
        .where("landings > 0")
        .select(
            *by,
            "offset",
            "landings",
            "rows",
            (F.col("rows") >= limit).alias("full"),
            ((F.col("offset") > 0) & (F.col("_before") == 0)).alias("gap_before"),
            (F.col("_after") == 0).alias("last"),
        )
    )


def _features(pages: DataFrame, *keep: str) -> DataFrame:
    return pages.select(*keep, F.posexplode("features").alias("pos", "feature"))


def _place(which: str) -> Column:
    return coordinate(F.col("feature.geometry.coordinates"), which)


def observations(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Observations of the pages, and the rejected features with the reason.

    A feature without properties or station is rejected, as is one with an unreadable value; a
    missing value or place is kept. ``arrival`` = offset + position in the page.
    """
    rows = _features(pages, "parameter", "offset").select(
        "parameter",
        F.col("offset").alias("page"),
        F.col("feature.properties.stationId").alias("station_id"),
        F.col("feature.properties.from").alias("observed_from"),
        F.col("feature.properties.value").alias("value_text"),
        to_number("feature.properties.value").alias("value"),
        _place("lat").alias("latitude"),
        _place("lon").alias("longitude"),
        (F.col("offset") + F.col("pos")).alias("arrival"),
    )
    rules = {
        "no station": F.col("station_id").isNotNull(),
        "unreadable value": F.col("value_text").isNull() | F.col("value").isNotNull(),
    }
    good, bad = split_rejects(rows, rules)
    return good.drop("value_text"), bad


def station_details(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Station details of the pages, and the features without a station with the reason.

    ``arrival`` orders them over all pages: by offset, then file (and line), then position.
    """
    p = "feature.properties"
    place = ["offset", *_landing(pages)[1:]]
    rows = _features(pages, *place).select(
        F.col(f"{p}.stationId").alias("station_id"),
        F.col(f"{p}.name").alias("name"),
        F.col(f"{p}.country").alias("country"),
        F.col(f"{p}.status").alias("status"),
        F.col(f"{p}.validFrom").alias("valid_from"),
        F.col(f"{p}.validTo").alias("valid_to"),
        F.struct(*place, F.col("pos").cast("long").alias("pos")).alias("arrival"),
    )
    return split_rejects(rows, {"no station": F.col("station_id").isNotNull()})


def page_records(pages: DataFrame) -> DataFrame:
    """The records of all pages, with ``ord`` = offset + position in the page."""
    rows = pages.select("offset", F.posexplode("records").alias("pos", "record"))
    return rows.select("record.*", (F.col("offset") + F.col("pos")).alias("ord"))


def read_record_pages(
    spark: SparkSession, folder: str, record: str = CONSUMPTION_RECORD, lines: bool = False
) -> DataFrame:
    """Records of every page under ``offset=…``, each page once."""
    return page_records(last_landings(read_record_documents(spark, folder, record, lines), by=()))
