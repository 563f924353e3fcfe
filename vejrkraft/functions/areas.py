"""Price area rules."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from vejrkraft.functions.numbers import to_number

# Position of the area digit in an area label, the municipality code up to which
# area 2 reaches, and the longitude where area 2 begins.
AREA_DIGIT_POSITION = 7
LAST_CODE_OF_AREA_2 = 400
FIRST_LONGITUDE_OF_AREA_2 = 11


def price_area(col: str | Column, kind: str) -> Column:
    """Price area ('1' or '2') from an area label, a municipality code or a longitude.

    Unreadable and missing input gives null.
    """
    c = F.col(col) if isinstance(col, str) else col
    if kind == "area":
        return F.nullif(F.substring(c, AREA_DIGIT_POSITION, 1), F.lit(""))
    if kind == "municipality":
        code = c.try_cast("int")
        return F.when(code > LAST_CODE_OF_AREA_2, "1").when(code.isNotNull(), "2")
    if kind == "longitude":
        lon = to_number(c)
        return F.when(lon < FIRST_LONGITUDE_OF_AREA_2, "1").when(lon.isNotNull(), "2")
    raise ValueError(f"unknown kind of area source: {kind!r}")
