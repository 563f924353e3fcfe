"""Order-dependent operators over a whole table: forward fill, row numbers, running totals.

A window without ``partitionBy`` runs in one task, and a window per key does the same for a key
that holds most rows. Here the total order (keys first, then the order columns) is cut into
ranges of about equal row count by Spark's own range partitioning. Each range is solved on its own,
and one small row per range carries the state over to the next one. The cut looks at all order
columns, so a hot key or a hot hour is cut as well; no row is dropped.

The sorted ranges are staged as a table, with the number of the range and of the row as columns:
later steps compare one number instead of several columns. Cutting ranges reads the input twice, once for a sample of the order, so
an input that is more than a scan is staged first and computed once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vejrkraft.session import is_scan, least_parallelism, staged

_BUCKET = "_bucket"
_ROW = "_row"
# Spark numbers rows as partition * 2^33 + position in the partition.
_ROWS_PER_RANGE = 1 << 33

Order = Sequence[str | Column]


def nulls_last(order: Order) -> list[Column]:
    """Ascending sort columns, nulls last."""
    return [(F.col(c) if isinstance(c, str) else c).asc_nulls_last() for c in order]


def with_ranges(df: DataFrame, order: Order, buckets: int | None = None) -> DataFrame:
    """Staged copy of ``df``, sorted into ranges, with ``_bucket`` (number of the range) and
    ``_row`` (a number that grows along ``order``).

    The number of ranges is that of the shuffle partitions, fewer where adaptive execution finds the
    data small, and at least the cores of a cluster whose setting was left too low.
    """
    keys = nulls_last(order)
    df = df if is_scan(df) else staged(df)
    buckets = buckets or least_parallelism(df.sparkSession)
    ranged = df.repartitionByRange(buckets, *keys) if buckets else df.repartitionByRange(*keys)
    ranged = ranged.sortWithinPartitions(*keys)
    return staged(
        ranged.withColumns({_ROW: F.monotonically_increasing_id(), _BUCKET: F.spark_partition_id()})
    )


def _ranges_of(df: DataFrame, by: Sequence[str], order: Order, buckets: int | None) -> DataFrame:
    """Ranges of ``df``; a table that is already cut is used as it is."""
    return df if _BUCKET in df.columns else with_ranges(df, [*by, *order], buckets)


def _same(by: Sequence[str]) -> Column:
    match = F.lit(True)
    for c in by:
        match = match & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    return match


def _carry(
    ranged: DataFrame, by: Sequence[str], tails: dict[str, Column], merges: dict[str, Column]
) -> DataFrame:
    """State that enters each range, ``_in_<name>`` per name: at most one row per range.

    ``tails`` aggregates the rows of a range, ``merges`` those results over the ranges so far. Only
    the last key of a range can continue in the next one, so only its rows count. Every
    broadcast here holds one row per range, a number fixed by the session and not by the data.
    """
    rows, keys = ranged, [f"_k_{c}" for c in by]
    if by:
        ends = ranged.groupBy(F.col(_BUCKET).alias("_b")).agg(F.max(_ROW).alias("_end"))
        last = ranged.join(F.broadcast(ends), F.col(_ROW) == F.col("_end")).select(
            F.col(_BUCKET).alias("_b"), *[F.col(c).alias(f"_k_{c}") for c in by]
        )
        rows = ranged.join(F.broadcast(last), (F.col(_BUCKET) == F.col("_b")) & _same(by))
    per_range = rows.groupBy(_BUCKET, *keys).agg(*[agg.alias(n) for n, agg in tails.items()])
    so_far = Window.partitionBy(*keys).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, 0)
    following = per_range.select(
        F.lead(_BUCKET).over(Window.orderBy(_BUCKET)).alias("_to"),
        *keys,
        *[agg.over(so_far).alias(f"_in_{n}") for n, agg in merges.items()],
    )
    return following.where(F.col("_to").isNotNull())


def _join_carry(solved: DataFrame, carry: DataFrame, by: Sequence[str]) -> DataFrame:
    match = (F.col(_BUCKET) == F.col("_to")) & _same(by)
    return solved.join(F.broadcast(carry), match, "left")


def _so_far(by: Sequence[str]) -> Window:
    return (
        Window.partitionBy(_BUCKET, *by).orderBy(_ROW).rowsBetween(Window.unboundedPreceding, 0)
    )


def ffill(
    df: DataFrame,
    order: Order,
    by: Sequence[str] = (),
    cols: Sequence[str] | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Replace nulls by the last non-null value before them in ``order`` (nulls last).

    Without ``by`` the fill runs over the whole table, and ``cols=None`` fills every column, order
    columns included. With ``by`` it restarts at each key, and the keys are left as they are.
    ``order`` must be unique (within ``by``).
    """
    by = list(by)
    cols = [c for c in (cols or df.columns) if c not in by]
    ranged = _ranges_of(df, by, order, buckets)
    known_at = lambda c: F.when(F.col(c).isNotNull(), F.col(_ROW))
    carry = _carry(
        ranged,
        by,
        {c: F.max_by(c, known_at(c)) for c in cols},
        {c: F.last(c, ignorenulls=True) for c in cols},
    )
    here = _so_far(by)
    solved = ranged.select(
        *[c for c in ranged.columns if c not in cols],
        *[F.last(c, ignorenulls=True).over(here).alias(c) for c in cols],
    )
    joined = _join_carry(solved, carry, by)
    return joined.select(
        *[F.coalesce(c, f"_in_{c}").alias(c) if c in cols else F.col(c) for c in df.columns]
    )


def running_total(
    df: DataFrame,
    value: str,
    order: Order,
    by: Sequence[str] = (),
    out: str = "running",
    buckets: int | None = None,
) -> DataFrame:
    """Running sum of ``value`` (null counts as 0) in ``order``, per ``by`` if given.

    A table already cut by ``with_ranges`` in this order is used as it is.
    """
    by = list(by)
    amount = F.sum(F.coalesce(F.col(value), F.lit(0)))
    ranged = _ranges_of(df, by, order, buckets)
    carry = _carry(ranged, by, {out: amount}, {out: F.sum(out)})
    solved = ranged.withColumn(out, amount.over(_so_far(by)))
    total = F.col(out) + F.coalesce(F.col(f"_in_{out}"), F.lit(0))
    joined = _join_carry(solved, carry, by)
    return joined.select(*[c for c in df.columns if c != out], total.alias(out))


def row_index(
    df: DataFrame,
    order: Order,
    by: Sequence[str] = (),
    out: str = "position",
    buckets: int | None = None,
) -> DataFrame:
    """Position of each row in ``order``, from 1, per ``by`` if given."""
    if by:
        one = df.withColumn("_one", F.lit(1).cast("long"))
        return running_total(one, "_one", order, by, out, buckets).drop("_one")
    # The rows of a range are numbered already: only the rows before the range are missing.
    ranged = _ranges_of(df, by, order, buckets)
    one = F.count(F.lit(1))
    carry = _carry(ranged, [], {"n": one}, {"n": F.sum("n")})
    place = F.col(_ROW) - F.col(_BUCKET).cast("long") * _ROWS_PER_RANGE + 1
    position = place + F.coalesce(F.col("_in_n"), F.lit(0))
    joined = _join_carry(ranged, carry, [])
    return joined.select(*[c for c in df.columns if c != out], position.alias(out))
