"""Station tables and reference points."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vejrkraft.operators.cleaning import standard_stations, union_all
from vejrkraft.schemas import POINT_TYPES, PROFILE_TYPES
from vejrkraft.sources.files import read_csv, with_types

log = logging.getLogger(__name__)


def station_dimension(spark: SparkSession, text: str) -> DataFrame:
    """``station_id, name`` from lines of ``id name`` (see ``fixed_values``)."""
    rows = [tuple(line.split(" ", 1)) for line in text.strip().splitlines()]
    return spark.createDataFrame(rows, "station_id string, name string")


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """Reference points ``code, name, latitude, longitude`` with ``ord`` = file order."""
    return read_csv(spark, path, POINT_TYPES, numbered=True)


def load_stations(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Station tables of several types (type -> path) as one, with ``station_type`` and ``ord``.

    A table that is missing or has no coordinates is skipped with a warning; it is an error if none
    remains. ``ord`` puts the tables in the given order and the stations in file order.
    """
    loaded = []
    for i, (station_type, path) in enumerate(paths.items()):
        try:
            df = read_csv(spark, path, numbered=True)
        except AnalysisException as e:
            log.warning("skipping %s stations: %s", station_type, e)
            continue
        df = standard_stations(df, station_type)
        if df is None:
            log.warning("skipping %s stations: no coordinate columns in %s", station_type, path)
            continue
        df = df.withColumn("ord", F.struct(F.lit(i).alias("table"), F.col("ord").alias("row")))
        loaded.append(with_types(df, PROFILE_TYPES))
    if not loaded:
        raise FileNotFoundError(f"no station table could be loaded from {dict(paths)}")
    return union_all(loaded, ragged=True)
