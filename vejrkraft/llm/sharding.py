"""Sharding by bytes: a minimax contiguous partition of ordered groups that stay whole.

Groups are equal texts. They are put in one order, and their running sizes are the places where a shard may end. The smallest
capacity with which the shards can hold all groups is found by binary search: a capacity is checked greedily, each
shard taking all it can hold. The first shard is cut there, and the search goes on with the groups and shards that are left,
so that one large group does not leave the shards behind it empty.

A greedy check only asks for the last end at or below a number. The driver answers from a table of ends of bounded length: the
largest end of each of ``BINS`` equal stretches, and where an answer could depend on ends it does not hold, it first fetches
those stretches from the executors. So the cuts are exact, whatever the number of groups.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vejrkraft.llm.steps import Steps
from vejrkraft.operators.ordering import row_index, running_total

SHARDS = 8
BINS = 1 << 15
# Groups of more than 1/1024 of a shard come first, the largest at the head: there are fewer than shards * 1024 of them.
LARGE = 1024
_AROUND = 2


class Ends:
    """Known ends of groups; ``whole[i]`` tells that no unknown end lies between end i - 1 and end i."""

    def __init__(self, total: int, fetch) -> None:
        self.at = np.array([0, total], dtype=np.int64)
        self.whole = np.array([True, False])
        self.fetch = fetch
        self.learn({1})

    def learn(self, gaps: set[int]) -> None:
        """Fetch ends inside the gaps before the given ends: all of them, or the last of each of many stretches."""
        spans = [(int(self.at[i - 1]), int(self.at[i])) for i in sorted(gaps)]
        more = self.fetch(spans)
        for i in gaps:
            self.whole[i] = True
        at = np.concatenate([self.at, [v for v, _ in more]]).astype(np.int64)
        whole = np.concatenate([self.whole, np.array([n == 1 for _, n in more], dtype=bool)])
        order = np.argsort(at, kind="stable")
        self.at, self.whole = at[order], whole[order]

    def last(self, x: int) -> tuple[int, int, int | None]:
        """The last end at or below ``x`` is in this range; the gap that decides, if the range is not one number."""
        i = int(np.searchsorted(self.at, x, side="right")) - 1
        low = int(self.at[i])
        if i + 1 == len(self.at) or self.whole[i + 1] or low == x:
            return low, low, None
        return low, min(x, int(self.at[i + 1]) - 1), i + 1

    def around(self, gaps: set[int]) -> set[int]:
        """The gaps and their neighbours that are not known whole."""
        near = {j for i in gaps for j in range(i - _AROUND, i + _AROUND + 1)}
        return {j for j in near if 0 < j < len(self.at) and not self.whole[j]}


def _fits(ends: Ends, begin: int, capacity: int, shards: int) -> bool | set[int]:
    """Whether ``shards`` of a capacity hold all groups after ``begin``; the gaps to look into where that is not known."""
    total, sure, hoped, gaps = int(ends.at[-1]), begin, begin, set()
    for _ in range(shards):
        low, _, gap = ends.last(min(total, sure + capacity))
        _, high, other = ends.last(min(total, hoped + capacity))
        gaps |= {gap, other} - {None}
        sure, hoped = low, high
    return True if sure == total else False if hoped < total else gaps


def smallest_capacity(ends: Ends, begin: int, shards: int) -> int:
    """The least capacity with which ``shards`` hold all groups after ``begin``, in order."""
    rest = int(ends.at[-1]) - begin
    low, high = -(-rest // shards), rest
    while low < high:
        middle = (low + high) // 2
        fits = _fits(ends, begin, middle, shards)
        if isinstance(fits, set):
            ends.learn(ends.around(fits))
        elif fits:
            high = middle
        else:
            low = middle + 1
    return low


def minimax_cuts(ends: Ends, shards: int) -> list[int]:
    """Where each shard ends: the first as far as the smallest capacity for all reaches, the others likewise with the rest."""
    cuts, begin = [], 0
    for left in range(shards, 0, -1):
        reach = begin + (smallest_capacity(ends, begin, left) if begin < ends.at[-1] else 0)
        while (gap := ends.last(reach)[2]) is not None:
            ends.learn(ends.around({gap}))
        begin = ends.last(reach)[0]
        cuts.append(begin)
    return cuts


def _fetched(groups: DataFrame, spans: list[tuple[int, int]], bins: int) -> list[tuple[int, int]]:
    """Of the groups that end strictly inside a span: the last end of each stretch, and how many ends the stretch has."""
    inside = [(F.col("upto") > a) & (F.col("upto") < b) for a, b in spans]
    each = max(1, bins // len(spans))
    # Stretches of at least one byte; double precision only shifts where a stretch begins.
    stretch: Column = F.lit(None).cast("long")
    for i, (here, (a, b)) in enumerate(zip(inside, spans)):
        part = F.floor((F.col("upto") - a - 1) * min(1.0, each / max(1, b - a - 1)))
        stretch = F.when(here, F.lit(i * (each + 2)) + part).otherwise(stretch)
    found = groups.where(reduce(Column.__or__, inside)).groupBy(stretch.alias("stretch"))
    return [(r["last"], r["n"]) for r in found.agg(F.max("upto").alias("last"), F.count(F.lit(1)).alias("n")).collect()]


def shard_documents(
    docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", bins: int = BINS
) -> DataFrame:
    """Per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    ``size`` is the UTF-8 bytes of the text plus 1, so that empty texts count; the law is `bytes`: shards are numbered from 0 and
    as even in size as the order of the groups of equal texts allows, which stay whole. Large groups come first, by size, the
    others by the hash of their text. ``slot`` counts the rows of a shard without gaps, by doc_id (nulls last), then text.
    ``grown_shard`` is null: another shard moves all cuts. A null text is an empty one (size 1, crc 0) and in its group; repeated
    rows are rows of their own and get neighbouring slots; fewer groups than shards leave the last shards empty; other columns are
    not read; an empty table gives no rows. The same rows give the same result in any order.

    Equal texts are told by SHA-256. No row is joined to its group: a group's place follows from its hash and at most 7 bounds,
    and the large groups, fewer than ``shards`` * 1024, are broadcast.
    """
    steps = Steps(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = steps.write(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text) + F.lit(1).cast("long")).alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.unhex(F.sha2(text, 256)).alias("digest"),
            F.monotonically_increasing_id().alias("copy"),
        )
    )
    total = rows.agg(F.sum("size")).first()[0] or 0
    groups = rows.groupBy("digest").agg(F.sum("size").alias("bytes"))
    large = F.col("bytes") * (shards * LARGE) > total
    groups = groups.withColumn("head", F.when(large, -F.col("bytes")).otherwise(0))
    groups = steps.write(running_total(groups, "bytes", ["head", "digest"], out="upto"))
    ends = Ends(total, lambda spans: _fetched(groups, spans, bins))
    cuts = minimax_cuts(ends, shards) if total else []
    inner = sorted({c for c in cuts if 0 < c < total})
    bounds = {r["upto"]: r for r in groups.where(F.col("upto").isin(inner)).collect()} if inner else {}

    def count(tests: list[Column]) -> Column:
        return reduce(Column.__add__, [t.cast("int") for t in tests], F.lit(0))

    heads = groups.where("head < 0").select(
        "digest", count([F.col("upto") > c for c in cuts[:-1]]).alias("_of_large")
    )
    # Other groups lie behind all large ones, by hash.
    behind = [
        F.lit(True) if c == 0 or bounds[c]["head"] < 0 else F.col("digest") > F.lit(bytes(bounds[c]["digest"]))
        for c in cuts[:-1]
        if c < total
    ]
    placed = rows.join(F.broadcast(heads), "digest", "left")
    placed = placed.withColumn("shard", F.coalesce("_of_large", count(behind))).drop("_of_large")
    numbered = row_index(placed, ["shard", "doc_id", "text_crc32", "digest", "copy"], out="at")
    numbered = steps.write(numbered)
    sizes = {r["shard"]: r["count"] for r in numbered.groupBy("shard").count().collect()}
    before = F.lit(0).cast("long")
    for shard in range(shards):
        n = sum(v for s, v in sizes.items() if s < shard)
        before = F.when(F.col("shard") == shard, F.lit(n).cast("long")).otherwise(before)
    return steps.result(
        numbered.select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("at") - 1 - before).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
