"""JSON documents and messages."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def field_or_empty(document: Column, name: str) -> Column:
    """Top-level field as text, '' where it is missing."""
    return F.coalesce(F.get_json_object(document, f"$.{name}"), F.lit(""))


def coordinate(coordinates: Column, which: str) -> Column:
    """Latitude or longitude of a [longitude, latitude] array; null where it is too short."""
    return F.get(coordinates, F.lit({"lon": 0, "lat": 1}[which]))


def encode_json(df: DataFrame, cols: Sequence[str] | None = None, out: str = "value") -> DataFrame:
    """One JSON text per row, nulls kept; the message payload is its UTF-8 form."""
    record = F.struct(*(cols or df.columns))
    return df.withColumn(out, F.to_json(record, {"ignoreNullFields": "false"}))


def json_array_pieces(
    df: DataFrame, order: Sequence[str], keys: Sequence[str] = (), cols: Sequence[str] | None = None
) -> DataFrame:
    """Each row's share of one JSON array document per ``keys``.

    The pieces of a key, taken in ``order`` (unique within the key, nulls last), concatenate to the array. Only
    the first and last position per key are aggregated, so a document may be of any size: no task
    holds more than one record.
    """
    # A single number is compared in place; several columns need a struct. A null comes last.
    place = F.col(order[0]) if len(order) == 1 else F.struct(*[F.struct(F.col(c).isNull(), F.col(c)) for c in order])
    ends = df.groupBy(*keys).agg(
        F.min(place).alias("_first"), F.max(place).alias("_last"), F.count_if(place.isNull()).alias("_nulls")
    )
    ends = ends.withColumnsRenamed({k: f"_e_{k}" for k in keys})
    match = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_e_{k}"))
    # Without keys there is exactly one row of ends.
    joined = df.join(ends if keys else F.broadcast(ends), match)
    record = F.to_json(F.struct(*(cols or df.columns)), {"ignoreNullFields": "false"})
    last = F.when(F.col("_nulls") > 0, place.isNull()).otherwise(place == F.col("_last"))
    piece = F.concat(
        F.when(place.eqNullSafe(F.col("_first")), "[").otherwise(""),
        record,
        F.when(last, "]").otherwise(", "),
    )
    return joined.select(*keys, *[c for c in order if c not in keys], piece.alias("piece"))
