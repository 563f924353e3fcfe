"""Text helpers for labels and reports."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_part(col: Column) -> Column:
    """The date at the front of an ISO time text."""
    return F.substring(col, 1, 10)


def join_present(labels: dict[str, Column]) -> Column:
    """The labels whose condition holds, joined by a comma."""
    return F.concat_ws(", ", *[F.when(flag, F.lit(label)) for label, flag in labels.items()])


def place_label(name: Column, types: Column) -> Column:
    return F.concat(name, F.lit(" ("), F.array_join(types, ", "), F.lit(")"))


def mentions(col: Column, *parts: str) -> Column:
    """Whether the text holds one of the parts, ignoring case."""
    found = F.lit(False)
    for part in parts:
        found = found | F.lower(col).contains(part.lower())
    return found


def title_case(col: Column) -> Column:
    return F.initcap(col)


def thousands(col: Column, digits: int = 0) -> Column:
    return F.format_number(col, digits)


def fixed(col: Column, digits: int) -> Column:
    return F.format_string(f"%.{digits}f", col)
