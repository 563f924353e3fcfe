"""Row and column clean-up."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FractionalType, NumericType

from vejrkraft.functions.numbers import to_number
from vejrkraft.functions.texts import title_case


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN means missing: Spark would sort it as the largest number."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, FractionalType)]
    floats = [c for c in floats if not dict(df.dtypes)[c].startswith("decimal")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def with_missing_columns(df: DataFrame, wanted: Mapping[str, str]) -> DataFrame:
    """Add the ``wanted`` (name -> type) columns that are absent, filled with null."""
    absent = {c: F.lit(None).cast(t) for c, t in wanted.items() if c not in df.columns}
    return df.withColumns(absent) if absent else df


def drop_null_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(cols))


def null_rows_removed(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows before, rows kept and rows removed by ``drop_null_rows``."""
    keep = F.lit(True)
    for c in cols:
        keep = keep & F.col(c).isNotNull()
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(keep).alias("rows_kept"),
        (F.count(F.lit(1)) - F.count_if(keep)).alias("rows_removed"),
    )


def fill_with_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols})


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def split_rejects(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Good rows, and rejected rows with the ``reason`` of the first broken rule.

    A rule names the reason and holds when the row is *good*; an unknown (null) outcome rejects.
    """
    reason = F.coalesce(
        *[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]
    )
    judged = df.withColumn("reason", reason)
    return judged.where(F.col("reason").isNull()).drop("reason"), judged.where(
        F.col("reason").isNotNull()
    )


def find_station_columns(columns: Iterable[str]) -> dict[str, str | None]:
    """Which columns hold latitude, longitude and name, judged by their names.

    Each column is tried for latitude, then longitude, then name, and the first that fits wins.
    """
    marks = {"latitude": ("lat",), "longitude": ("lon", "lng"), "name": ("name",)}
    found: dict[str, str | None] = dict.fromkeys(marks)
    for column in columns:
        text = column.lower()
        role = next(
            (r for r, parts in marks.items() if found[r] is None and any(p in text for p in parts)),
            None,
        )
        if role:
            found[role] = column
    return found


def standard_stations(df: DataFrame, station_type: str, id_col: str = "station_id") -> DataFrame | None:
    """Stations with ``latitude``, ``longitude``, ``name`` and ``station_type``.

    Rows without readable coordinates are dropped. None if the table has no coordinate columns.
    """
    found = find_station_columns(df.columns)
    if not found["latitude"] or not found["longitude"]:
        return None
    df = df.withColumnsRenamed({old: new for new, old in found.items() if old})
    df = df.withColumns({c: to_number(c) for c in ("latitude", "longitude")})
    df = drop_null_rows(df, ["latitude", "longitude"])
    if not found["name"]:
        label = F.concat(title_case(F.lit(station_type)), F.lit(" Station "), F.col(id_col))
        df = df.withColumn("name", label)
    return df.withColumn("station_type", F.lit(station_type))


def clean_observations(
    df: DataFrame,
    value: str = "value",
    key: Sequence[str | Column] = (),
    order: Sequence[str | Column] = (),
) -> DataFrame:
    """Observations that carry a value; with ``key``, the first row in ``order`` for each key.

    ``order`` defaults to all columns, so that the row kept does not follow the placing of rows.
    """
    kept = df.where(F.col(value).isNotNull())
    if not key:
        return kept
    first = F.min_by(F.struct(*df.columns), F.struct(*(order or df.columns)))
    keys = [(F.col(k) if isinstance(k, str) else k).alias(f"_k{i}") for i, k in enumerate(key)]
    return kept.groupBy(*keys).agg(first.alias("_first")).select("_first.*")


def sorted_columns(df: DataFrame) -> DataFrame:
    return df.select(*sorted(df.columns))


def union_all(frames: Sequence[DataFrame], ragged: bool = False) -> DataFrame:
    """All rows of all frames by column name; ``ragged`` fills absent columns with null."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=ragged)
    return first
