"""Mixing sources to target weights by Sainte-Lague apportionment.

Every source has a target, every shard of a source its share of it; the words of the mix go to the shards with the
highest quotients share / (2k - 1), which gives each shard an integer quota of words, however small its share. The words of
the corpus are cut into blocks of equal length. A shard fills its quota with whole passes over its documents and, for the
rest, with blocks of words picked in seeded order.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vejrkraft.operators.ordering import row_index
from vejrkraft.session import staged

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST_PASSES = 3
BLOCKS = 1 << 20
DOCS_PER_SHARD = 10_000


def source_targets(sources: DataFrame, weights: tuple[int, ...], passes: int) -> DataFrame:
    """Adds ``place`` (of the source in code point order, null last), ``weight`` and ``target``.

    All sizes are shared by weight; a target stops at ``passes`` times its source's size, and the excess is
    shared by weight among the others. The table holds one row per source: it is the list of sources, not
    of rows, and its running sums are one task.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.withColumn("place", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.get(F.array(*map(F.lit, weights)), F.pmod("place", F.lit(len(weights))))
    )
    most = passes * F.col("source_size")
    # Sources stop in order of most / weight: those before a source have stopped when it is its turn.
    by_ratio = Window.orderBy(most / F.col("weight"), "place")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = lambda total, gone: total - F.coalesce(gone, F.lit(0))
    level = left(F.sum("source_size").over(all_rows), F.sum(most).over(before)) / left(
        F.sum("weight").over(all_rows), F.sum("weight").over(before)
    )
    stops = ranked.withColumn("stops", most <= level * F.col("weight"))
    gone = lambda c: F.sum(F.when(F.col("stops"), c).otherwise(0)).over(all_rows)
    level = left(F.sum("source_size").over(all_rows), gone(most)) / F.nullif(
        left(F.sum("weight").over(all_rows), gone(F.col("weight"))), F.lit(0)
    )
    target = F.when(F.col("stops"), most.cast("double")).otherwise(level * F.col("weight"))
    return stops.withColumn("target", target).drop("stops")


def apportion(units: DataFrame, keys: list[str], share: str, seats: int) -> DataFrame:
    """Sainte-Lague: ``quota`` per row of ``units``, ``seats`` in all, by highest share / (2k - 1).

    Two divisors bracket the right one: at the larger one too few seats are given, at the smaller one too many, and
    they differ by two seats per unit at most. The quotients in between are ranked exactly; ties go by ``keys``.
    """
    total, n = units.agg(F.sum(share), F.count(F.lit(1))).first()
    if not total or seats <= 0:
        return units.withColumn("quota", F.lit(0).cast("long"))
    given = lambda d: F.floor(F.col(share) * (d / total) + 0.5)
    low, high = max(seats - n / 2 - 1, 0.0), seats + n / 2 + 1
    cut = staged(
        units.withColumns({"low": given(low) if low else F.lit(0).cast("long"), "high": given(high)})
    )
    missing = seats - cut.agg(F.sum("low")).first()[0]
    open_seats = cut.where("high > low").select(
        *keys, share, F.explode(F.sequence(F.col("low") + 1, F.col("high"))).alias("_seat")
    )
    order = [-F.col(share) / (2 * F.col("_seat") - 1), *keys, "_seat"]
    won = row_index(open_seats, order, out="_rank").where(F.col("_rank") <= missing)
    more = won.groupBy(*keys).agg(F.count(F.lit(1)).alias("more"))
    quota = F.col("low") + F.coalesce("more", F.lit(0))
    return cut.join(more, keys, "left").withColumn("quota", quota).drop("low", "high", "more")


def _hash(seed: int, *cols: str | Column) -> Column:
    return F.xxhash64(F.lit(seed), *cols)


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    passes: int = MOST_PASSES,
    blocks: int = BLOCKS,
    docs_per_shard: int = DOCS_PER_SHARD,
    seed: int = 17,
) -> DataFrame:
    """Per row of ``docs``: doc_id, source, size, source_size, target, shard, passes, taken.

    ``size`` counts words (null text: 0), ``target`` is the source's, ``taken`` the words the mix takes
    from the document, repeats counted: whole passes plus the words of its picked blocks, so the first or last
    document of a block may give a part. No document gives more than ``passes`` times its size, and a source's taken words
    differ from its target by the rounding of its shards' quotas to whole words. Null sources are one
    source. Repeated rows are documents of their own; null ids are allowed; empty texts take 0; an empty table gives
    no rows. ``blocks`` sets the block length (all words / blocks, 1 at least), so the number of blocks
    stays while documents grow. The result depends on rows, parameters and ``seed`` only.
    """
    sized = staged(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        )
    )
    sources = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")
    )
    sources = source_targets(sources, weights, passes).withColumn(
        "shards", F.ceil(F.col("n_docs") / docs_per_shard)
    )
    sources = staged(sources.withColumnRenamed("source", "_source"))
    placed = sized.join(sources, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        "place",
        F.pmod(_hash(seed, "doc_id", "size"), F.col("shards")).alias("shard"),
    )
    unit = ["place", "shard"]
    units = staged(
        placed.groupBy(*unit).agg(
            F.sum("size").alias("unit_size"),
            F.any_value(F.try_divide("target", "source_size")).alias("rate"),
        )
    ).where("unit_size > 0")
    units = units.withColumn("share", F.col("rate") * F.col("unit_size"))
    words, n_units = units.agg(F.coalesce(F.sum("unit_size"), F.lit(0)), F.count(F.lit(1))).first()
    length = max(1, math.ceil(words / max(blocks, 64 * n_units)))
    # Seats are words: a source may be smaller than half a block.
    quotas = apportion(units, unit, "share", words)

    budget = F.least(F.col("quota"), passes * F.col("unit_size"))
    filled = staged(
        quotas.select(
            *unit,
            "unit_size",
            budget.alias("budget"),
        ).selectExpr(
            *unit,
            "unit_size",
            "budget div unit_size as passes",
            "budget % unit_size as rest",
        )
    )
    # The rest of a unit's quota: its blocks in seeded order, the last one as far as needed.
    parts = filled.where("rest > 0").select(
        *unit,
        "rest",
        "unit_size",
        F.explode(F.expr(f"sequence(0L, (unit_size - 1) div {length})")).alias("block"),
    )
    parts = parts.withColumn(
        "block_size", F.least(F.lit(length), F.col("unit_size") - F.col("block") * length)
    )
    seeded = Window.partitionBy(*unit).orderBy(_hash(seed + 1, *unit, "block"), "block")
    gone = F.sum("block_size").over(seeded.rowsBetween(Window.unboundedPreceding, 0))
    picked = (
        parts.withColumn("gone", gone - F.col("block_size"))
        .where("gone < rest")
        .select(*unit, "block", F.least("block_size", F.col("rest") - F.col("gone")).alias("picked"))
    )

    in_shard = Window.partitionBy(*unit).orderBy(_hash(seed + 2, "doc_id", "size"), "doc_id", "size")
    end = F.sum("size").over(in_shard.rowsBetween(Window.unboundedPreceding, 0))
    lined = placed.withColumn("end", end).join(filled, unit, "left")
    touched = F.when(
        (F.col("size") > 0) & (F.col("rest") > 0),
        F.expr(f"sequence((end - size) div {length}, (end - 1) div {length})"),
    )
    cut = lined.withColumn("block", F.explode_outer(touched)).join(picked, [*unit, "block"], "left")
    begin = F.col("block") * length
    shared = F.least(F.col("end"), begin + F.col("picked")) - F.greatest(
        F.col("end") - F.col("size"), begin
    )
    # Rows that agree in all of these columns are repeats of one empty document, taken 0 times.
    row = ["doc_id", "source", "size", "source_size", "target", "place", "shard", "end", "passes"]
    summed = cut.groupBy(*row).agg(
        # least() and greatest() pass over nulls, so a block that was not picked is told apart first.
        F.sum(F.when(F.col("picked").isNotNull(), F.greatest(shared, F.lit(0))).otherwise(0)).alias("part"),
        F.count(F.lit(1)).alias("copies"),
    )
    # An empty document has no block: its repeats are counted, not merged.
    repeats = F.when(F.col("size") == 0, F.col("copies")).otherwise(1).cast("int")
    return summed.withColumn("copy", F.explode(F.sequence(F.lit(1), repeats))).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        F.coalesce("target", F.lit(0.0)).alias("target"),
        "shard",
        F.coalesce("passes", F.lit(0)).alias("passes"),
        F.when(F.col("size") > 0, F.col("size") * F.coalesce("passes", F.lit(0)) + F.col("part"))
        .otherwise(0)
        .cast("long")
        .alias("taken"),
    )
