"""Correlation matrix and box-plot statistics of numeric columns.

Both read each row once per scan, in Arrow batches, and send on sums instead of rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vejrkraft.operators.cleaning import numeric_columns

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}
BLOCK = 256
SKETCH = 10_000
GRID = 200
# Values of a bracket that are ranked in one window.
MOST_RANKED = 1 << 20
_PARTS_KEPT = 1 << 20


def _as_double(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The columns as doubles, named by their place: input names may hold dots or repeat."""
    return df.select(*[F.col(f"`{c.replace('`', '``')}`").cast("double").alias(f"c{i}") for i, c in enumerate(cols)])


def _matrix(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Values and the mask of known ones, one row per column of the batch."""
    values = np.zeros((batch.num_columns, batch.num_rows))
    known = np.zeros(values.shape, dtype=bool)
    for i, column in enumerate(batch.columns):
        known[i] = np.asarray(column.is_valid())
        values[i] = column.fill_null(0.0).to_numpy(zero_copy_only=False)
    return values, known


class GramBlocks:
    """Sums over rows for every pair of columns: rows where both are known, and the sums, squares and products of their values
    about a centre near the columns' means. Columns are taken in blocks, so that a product fits the caches."""

    def __init__(self, columns: int) -> None:
        self.centre = np.full(columns, np.nan)
        shape = (columns, columns)
        self.n, self.odd, self.x, self.xx, self.xy = (np.zeros(shape) for _ in range(5))

    def add(self, values: np.ndarray, known: np.ndarray) -> None:
        finite = np.isfinite(values)
        odd = known & ~finite
        good = known & finite
        values = np.where(good, values, 0.0)
        counts = good.sum(axis=1)
        unset = np.isnan(self.centre) & (counts > 0)
        self.centre[unset] = values[unset].sum(axis=1) / counts[unset]
        values = np.where(good, values - np.nan_to_num(self.centre)[:, None], 0.0)
        square, mask, bad = values * values, known.astype(float), odd.astype(float)
        any_odd = odd.any()
        blocks = range(0, len(values), BLOCK)
        for i in (slice(b, b + BLOCK) for b in blocks):
            for j in (slice(b, b + BLOCK) for b in blocks):
                self.n[i, j] += mask[i] @ mask[j].T
                self.x[i, j] += values[i] @ mask[j].T
                self.xx[i, j] += square[i] @ mask[j].T
                self.xy[i, j] += values[i] @ values[j].T
                if any_odd:
                    self.odd[i, j] += bad[i] @ mask[j].T

    def pairs(self) -> pa.RecordBatch:
        """One row per pair of columns that some row knows both of: count, means, and sums about the means."""
        left, right = np.nonzero(np.triu(self.n))
        n = self.n[left, right]
        x, y = self.x[left, right], self.x[right, left]
        centre = np.nan_to_num(self.centre)
        columns = {
            "a": left.astype(np.int32),
            "b": right.astype(np.int32),
            "n": n,
            "odd": self.odd[left, right] + self.odd[right, left],
            "mean_x": centre[left] + x / n,
            "mean_y": centre[right] + y / n,
            "xx": self.xx[left, right] - x * x / n,
            "yy": self.xx[right, left] - y * y / n,
            "xy": self.xy[left, right] - x * y / n,
        }
        return pa.RecordBatch.from_arrays([pa.array(v) for v in columns.values()], names=list(columns))


_PAIRS = "a int, b int, n double, odd double, mean_x double, mean_y double, xx double, yy double, xy double"


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums = None
    for batch in batches:
        sums = sums or GramBlocks(batch.num_columns)
        sums.add(*_matrix(batch))
    if sums:
        yield sums.pairs()


def corr_matrix(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every pair of numeric columns, over the rows where both are known.

    Long form ``(col_a, col_b, r)``, both directions and the diagonal; null where a column does not
    vary, NaN where one of a pair's values is not finite. One scan: a task adds its rows into one square of sums per
    measure and sends a row per pair of columns; the tasks' rows are merged about their common means, so a large mean with a small
    spread loses no digits.
    """
    cols = list(cols or numeric_columns(df))
    parts = _as_double(df, cols).mapInArrow(_grams, _PAIRS)
    # One row per task and pair.
    pair = Window.partitionBy("a", "b")
    total = F.sum("n").over(pair)
    centred = parts.withColumns(
        {f"all_{m}": F.sum(F.col("n") * F.col(m)).over(pair) / total for m in ("mean_x", "mean_y")}
    )
    dx, dy = F.col("mean_x") - F.col("all_mean_x"), F.col("mean_y") - F.col("all_mean_y")
    n = F.col("n")
    merged = centred.groupBy("a", "b").agg(
        F.sum("odd").alias("odd"),
        F.sum(F.col("xx") + n * dx * dx).alias("xx"),
        F.sum(F.col("yy") + n * dy * dy).alias("yy"),
        F.sum(F.col("xy") + n * dx * dy).alias("xy"),
        F.max(F.abs("all_mean_x")).alias("size_x"),
        F.max(F.abs("all_mean_y")).alias("size_y"),
        F.sum("n").alias("n"),
    )
    # What rounding leaves of a column that does not vary is not a spread.
    varies = lambda s, size: F.col(s) > F.col("n") * F.pow(F.col(size) * F.lit(1e-14), F.lit(2))
    r = F.when(varies("xx", "size_x") & varies("yy", "size_y"), F.col("xy") / (F.sqrt("xx") * F.sqrt("yy")))
    r = F.when(r > 1, 1.0).when(r < -1, -1.0).otherwise(r)
    r = F.when((F.col("a") == F.col("b")) & r.isNotNull(), 1.0).otherwise(r)
    found = merged.select("a", "b", F.when(F.col("odd") > 0, F.lit(float("nan"))).otherwise(r).alias("r"))
    k = len(cols)
    name = F.array(*map(F.lit, cols))
    cells = df.sparkSession.range(k * k).select(F.expr(f"int(id div {k})").alias("i"), F.expr(f"int(id % {k})").alias("j"))
    cells = cells.select(
        F.get(name, F.col("i")).alias("col_a"),
        F.get(name, F.col("j")).alias("col_b"),
        F.least("i", "j").alias("a"),
        F.greatest("i", "j").alias("b"),
    )
    # One row per pair of columns.
    return cells.join(F.broadcast(found), ["a", "b"], "left").select("col_a", "col_b", "r")


class _Column:
    """What is known of one column: how many values it has, and per rank in question the bracket that holds it."""

    def __init__(self, n: int, low: float, high: float) -> None:
        self.n, self.low, self.high = n, low, high
        # Both whole ranks around a share, from 0, as the exact interpolation wants them.
        self.ranks = [(int(np.floor((n - 1) * s)), int(np.ceil((n - 1) * s))) for s in QUARTILES.values()]
        self.brackets = [(low, high) for _ in self.ranks]

    def fence_zones(self, whisker: float) -> list[tuple[float, float]]:
        """Where the fences may lie, given the brackets of the outer quartiles."""
        (a, b), (c, d) = self.brackets[0], self.brackets[-1]
        with np.errstate(invalid="ignore"):
            least, most = whisker * max(0.0, c - b), whisker * (d - a)
            zones = [(a - most, b - least), (c + least, d + most)]
        # Infinite ends have no distance: then the fence may be anywhere.
        return [z if not np.isnan(z).any() else (-np.inf, np.inf) for z in zones]


def _first_brackets(df: DataFrame, names: list[str]) -> dict[str, _Column]:
    """Counts and a first bracket per rank, from one mergeable quantile sketch per column: its ranks are wrong by 1 / SKETCH of the
    values at most."""
    margin = 2.0 / SKETCH
    shares = [min(1.0, max(0.0, s + d)) for s in QUARTILES.values() for d in (-margin, margin)]
    aggs = []
    for c in names:
        # NaN counts as the largest value.
        value = F.nanvl(c, F.lit(float("inf")))
        asked = F.array(*map(F.lit, shares))
        aggs += [F.count(c), F.min(value), F.max(value), F.percentile_approx(value, asked, F.lit(SKETCH))]
    row = df.agg(*aggs).first()
    found = {}
    for i, c in enumerate(names):
        n, low, high, cuts = row[4 * i : 4 * i + 4]
        if not n:
            continue
        column = found[c] = _Column(n, low, high)
        if n > 4 * SKETCH:  # below, whole ranks and the margin may cross
            column.brackets = [(cuts[2 * q], cuts[2 * q + 1]) for q in range(len(QUARTILES))]
    return found


def _narrowed(df: DataFrame, columns: dict[str, _Column], most: int) -> None:
    """Brackets with at most ``most`` values each (or of one value), by sketches of the brackets' own values."""
    open_ = {(c, q) for c, col in columns.items() for q in range(len(QUARTILES)) if 4 * col.n > most * SKETCH}
    grid = [k / GRID for k in range(GRID + 1)]
    while open_:
        todo = sorted(open_)
        aggs = []
        for c, q in todo:
            low, high = columns[c].brackets[q]
            value = F.nanvl(c, F.lit(float("inf")))
            inside = F.when(value.between(F.lit(low), F.lit(high)), value)
            asked = F.array(*map(F.lit, grid))
            aggs += [F.count(F.when(value < low, 1)), F.count(inside), F.percentile_approx(inside, asked, F.lit(SKETCH))]
        row = df.agg(*aggs).first()
        for i, (c, q) in enumerate(todo):
            column = columns[c]
            below, n, cuts = row[3 * i : 3 * i + 3]
            first, last = column.ranks[q]
            if not below <= first <= last < below + n:
                column.brackets[q] = (column.low, column.high)
            elif n <= most or cuts[0] == cuts[-1]:
                open_.discard((c, q))
            else:
                slack = n / SKETCH + 2
                place = lambda rank: (rank - below) / n * GRID
                low = max(0, int(np.floor(place(first - slack))) - 1)
                high = min(GRID, int(np.ceil(place(last + slack))) + 1)
                if (cuts[low], cuts[high]) == column.brackets[q]:
                    open_.discard((c, q))  # one value holds the rank and most of the bracket
                column.brackets[q] = (cuts[low], cuts[high])


_ZONES = "column int, zone int, value double, n long, low double, high double"


class _Zones:
    """Values of one task, per column: counted by zone, and by value in the zones that keep their values."""

    def __init__(self, cuts: list[np.ndarray], kept: list[np.ndarray]) -> None:
        self.cuts, self.kept = cuts, kept
        self.parts: list[dict[int, list]] = [{} for _ in cuts]
        self.values: list[list[np.ndarray]] = [[] for _ in cuts]
        self.held = 0

    def add(self, batch: pa.RecordBatch) -> None:
        for i, column in enumerate(batch.columns):
            value = column.drop_null().to_numpy(zero_copy_only=False)
            if not len(value):
                continue
            # Zone 2k + 1 is the cut k itself, zone 2k what lies between two cuts; NaN is above all.
            zone = np.searchsorted(self.cuts[i], value, "left") + np.searchsorted(self.cuts[i], value, "right")
            keep = self.kept[i][zone]
            self.values[i].append(value[keep])
            self.held += int(keep.sum())
            value, zone = value[~keep], zone[~keep]
            for z in np.unique(zone).tolist():
                own = value[zone == z]
                old = self.parts[i].setdefault(z, [0, np.inf, -np.inf])
                old[0] += len(own)
                old[1], old[2] = min(old[1], own.min()), max(old[2], own.max())

    def rows(self) -> Iterator[pa.RecordBatch]:
        kind = pa.schema(
            [("column", pa.int32()), ("zone", pa.int32()), ("value", pa.float64()), ("n", pa.int64())]
            + [(c, pa.float64()) for c in ("low", "high")]
        )
        for i, cuts in enumerate(self.cuts):
            value, n = np.unique(np.concatenate([*self.values[i], np.zeros(0)]), return_counts=True)
            zone = np.searchsorted(cuts, value, "left") + np.searchsorted(cuts, value, "right")
            part = sorted((z, *p) for z, p in self.parts[i].items())
            count = len(value) + len(part)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(count, i, np.int32)),
                    pa.array(np.concatenate([zone, [p[0] for p in part]]).astype(np.int32)),
                    pa.array([*value.tolist(), *[None] * len(part)], pa.float64()),
                    pa.array(np.concatenate([n, [p[1] for p in part]]).astype(np.int64)),
                    pa.array(np.concatenate([value, [p[2] for p in part]])),
                    pa.array(np.concatenate([value, [p[3] for p in part]])),
                ],
                schema=kind,
            )


def _zoned(batches: Iterator[pa.RecordBatch], cuts: list[np.ndarray], kept: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    zones = _Zones(cuts, kept)
    for batch in batches:
        zones.add(batch)
        if zones.held > _PARTS_KEPT:
            yield from zones.rows()
            zones = _Zones(cuts, kept)
    yield from zones.rows()


def box_stats(
    df: DataFrame, cols: Sequence[str] | None = None, whisker: float = 1.5, most: int = MOST_RANKED
) -> DataFrame:
    """Per numeric column: count, exact quartiles, whisker ends and number of outliers.

    Quartiles interpolate linearly. Whiskers are the most extreme values within ``whisker``
    inter-quartile ranges of the box; a column without values has no row, NaN counts as the largest value.

    Two scans of ``df``, the first when this is called. The first makes one mergeable quantile sketch per column, which brackets
    each quartile within 4 / 10,000 of the values. The second counts: values inside a bracket, or where a fence may lie, one by one, all
    others by the zone they are in, so each task sends a few rows. Brackets that may hold more than ``most`` values (from
    2.6 billion values on) are narrowed by further sketches before the second scan, each a scan of its own that leaves about a hundredth.
    """
    cols = list(cols or numeric_columns(df))
    data = _as_double(df, cols)
    columns = _first_brackets(data, data.columns)
    _narrowed(data, columns, most)
    cuts, kept = [], []
    for c in data.columns:
        spans = [*columns[c].brackets, *columns[c].fence_zones(whisker)] if c in columns else []
        at = np.unique(np.array([v for s in spans for v in s], dtype=float))
        cuts.append(at)
        keep = np.zeros(2 * len(at) + 1, dtype=bool)
        for low, high in spans:
            keep[2 * np.searchsorted(at, low) + 1 : 2 * np.searchsorted(at, high) + 2] = True
        keep[1::2] = True
        kept.append(keep)
    parts = data.mapInArrow(lambda batches: _zoned(batches, cuts, kept), _ZONES)
    counts = parts.groupBy("column", "zone", "value").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")
    )
    # Per column: zones, and the values of its brackets, of which there are few.
    ordered = Window.partitionBy("column").orderBy("zone", "value")
    ranked = counts.withColumn("upto", F.sum("n").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    whole = Window.partitionBy("column")
    total = F.sum("n").over(whole)

    def at_rank(rank: Column) -> Column:
        holds = (F.col("upto") - F.col("n") <= rank) & (rank < F.col("upto"))
        return F.max(F.when(holds, F.col("low"))).over(whole)

    placed = ranked.withColumn("total", total)
    for name, share in QUARTILES.items():
        rank = (F.col("total") - 1) * F.lit(share)
        low, high = F.col(f"{name}_low"), F.col(f"{name}_high")
        placed = placed.withColumns({f"{name}_low": at_rank(F.floor(rank)), f"{name}_high": at_rank(F.ceil(rank))})
        placed = placed.withColumn(name, low + (high - low) * (rank - F.floor(rank)))
    reach = F.lit(whisker) * (F.col("q3") - F.col("q1"))
    inside = F.col("low").between(F.col("q1") - reach, F.col("q3") + reach)
    named = F.element_at(F.array(*map(F.lit, cols)), F.col("column") + 1).alias("column")
    return (
        placed.groupBy(named, "total", *QUARTILES)
        .agg(
            F.min(F.when(inside, F.col("low"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("high"))).alias("whisker_high"),
            F.sum(F.when(inside, 0).otherwise(F.col("n"))).alias("outliers"),
        )
        .withColumnRenamed("total", "n")
    )
