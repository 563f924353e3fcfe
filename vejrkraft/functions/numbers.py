"""Numeric column helpers."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_number(col: str | Column) -> Column:
    """Text to double; anything unreadable, and NaN, becomes null."""
    c = F.col(col) if isinstance(col, str) else col
    value = c.try_cast("double")
    return F.when(~F.isnan(value), value)


def round_even(col: str | Column, digits: int = 2) -> Column:
    """Round half to even."""
    return F.bround(col, digits)


def ratio_if_positive(total: Column, count: Column) -> Column:
    """``total / count`` where the total is above zero, else null."""
    return F.when(total > 0, F.try_divide(total, count))


def zero_as_null(col: Column) -> Column:
    return F.when(col != 0, col)


def squared_distance(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Squared Euclidean distance in degrees."""
    dlat, dlon = lat1 - lat2, lon1 - lon2
    return dlat * dlat + dlon * dlon
