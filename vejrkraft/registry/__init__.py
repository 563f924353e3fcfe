"""Named queries over the driver's tables, each with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def checks() -> dict[str, tuple[Query, str | None]]:
    from vejrkraft.registry import column_checks, io_checks, panel_checks, station_checks, study_checks

    out: dict[str, tuple[Query, str | None]] = {}
    for module in (panel_checks, station_checks, column_checks, io_checks, study_checks):
        out.update(module.CHECKS)
    return out
