"""N-gram Jaccard join with signature trees.

A document is the set of its distinct word shingles; equal sets are one class from the start. Two sets that
reach the similarity share a shingle among the first few of each, in any order common to all sets. The order puts
rare shingles first, by a sketch of fixed size that counts all shingles: what is a document's own comes before what its family or
other documents share. In that order the first shingle that two sets share leaves the rest of both as room for their overlap, so it must
stand early in both, and in the smaller one earlier still. A shingle's sets are a block; the sets that meet in blocks are compared in two rounds:

1. every set with two partners: the smallest set that it meets most often, and the hub that it meets most often, a block's set with the
   fewest shingles of its own before the block's. Linked sets form components, and a set that links with any copy of an original mostly links with its hub;
2. every block that still holds several components, by a signature tree: its nodes hold the OR of their sets' token
   bitmaps and their range of sizes. Pairs of nodes are opened from the top; a pair whose largest possible overlap
   is too small for its sizes is dropped, and sets of one component are not compared again.

All candidates are verified on the whole sets. Links inside a component that no step needed are not listed.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vejrkraft.llm.components import components
from vejrkraft.llm.names import shield
from vejrkraft.llm.steps import Steps
from vejrkraft.llm.words import SHINGLE, chunks, list_column, runs_of, shingle_sets, words_of

PERCENT = 80
LEAF = 64
BITS = 6
# Counters of the sketch that orders shingles, and how many travel in a row.
CELLS = 1 << 20
CELLS_IN_ROW = 1 << 16
CELL_GROUPS = 4


def _set_id(own: np.ndarray) -> int:
    digest = xxhash.xxh3_64_intdigest(own.tobytes())
    return digest - (1 << 64) if digest >> 63 else digest


def bitmap(own: np.ndarray) -> bytes:
    """A token bitmap with at least ``BITS`` bits per shingle; its halves folded by OR are the bitmap of half the width."""
    width = max(256, 1 << int(BITS * len(own) - 1).bit_length())
    bits = np.zeros(width, dtype=bool)
    bits[(own >> np.uint64(20)) % np.uint64(width)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """A bitmap (or rows of them) brought down to ``size`` bytes."""
    while bits.shape[-1] > size:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] | bits[..., half:]
    return bits


def _cell(shingles: np.ndarray, cells: int) -> np.ndarray:
    return ((shingles >> np.uint64(20)) % np.uint64(cells)).astype(np.int64)


def _survey(k: int, cells: int):
    """Per document its set's id, size and bitmap; and the task's sketch: how many of its distinct sets' shingles fall into each cell."""

    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, done = np.zeros(cells, dtype=np.int64), set()
        for part in chunks(batches, "text"):
            sets = list(shingle_sets(words_of(part.column("text")), k))
            ids = [_set_id(s) for s in sets]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": part.column("doc_id"),
                    "text_hash": part.column("text_hash"),
                    "set_id": pa.array(ids, pa.int64()),
                    "n": pa.array([len(s) for s in sets], pa.int64()),
                    "bitmap": pa.array([bitmap(s) for s in sets], pa.binary()),
                    "cells": pa.nulls(len(sets), pa.int32()),
                }
            )
            new = [s for s, i in zip(sets, ids) if i not in done]
            done.update(ids)
            if new:
                counts += np.bincount(_cell(np.concatenate(new), cells), minlength=cells)
        # Only the order of shingles depends on the counters: one that is full stays full.
        full = np.minimum(counts, np.iinfo(np.uint16).max).astype("<u2")
        for at in range(0, cells, CELLS_IN_ROW):
            own = full[at : at + CELLS_IN_ROW]
            if own.any():
                yield pa.RecordBatch.from_pydict(
                    {
                        **{c: pa.nulls(1, pa.int64()) for c in ("doc_id", "text_hash", "set_id", "n")},
                        "bitmap": pa.array([own.tobytes()], pa.binary()),
                        "cells": pa.array([at], pa.int32()),
                    }
                )

    return survey


def _add_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of each stretch of cells over the tasks' rows, 32 bits a cell. Streams: one sum per stretch is held."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for at, own in zip(batch.column("cells").to_pylist(), batch.column("bitmap").to_pylist()):
            counts = np.frombuffer(own, "<u2")
            sums[at] = sums.get(at, np.zeros(len(counts), np.int64)) + counts
    full = [np.minimum(x, np.iinfo(np.uint32).max).astype("<u4").tobytes() for x in sums.values()]
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(full, pa.binary())], names=["cells", "bitmap"])


def _order(surveyed: DataFrame, cells: int) -> np.ndarray:
    """The sketch: 4 bytes a cell, whatever the corpus. The driver adds up CELL_GROUPS rows a stretch."""
    stretches = surveyed.where("cells is not null").select("cells", "bitmap")
    some = stretches.withColumn("some", F.pmod(F.spark_partition_id(), F.lit(CELL_GROUPS)))
    added = some.repartition("cells", "some").select("cells", "bitmap").mapInArrow(_add_cells, "cells int, bitmap binary")
    counts = np.zeros(cells, dtype=np.int64)
    for row in added.collect():
        own = np.frombuffer(row["bitmap"], "<u4")
        counts[row["cells"] : row["cells"] + len(own)] += own
    return np.minimum(counts, np.iinfo(np.uint32).max).astype(np.uint32)


def _prefixes(k: int, percent: int, order):
    """The first shingles of each set, with their places, of one text per set in a task."""

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, done = order.value, set()
        for part in chunks(batches, "text"):
            keys, ids, sizes = [], [], []
            for own in shingle_sets(words_of(part.column("text")), k):
                n = len(own)
                if n == 0 or (set_id := _set_id(own)) in done:
                    continue
                done.add(set_id)
                first = n - -(-n * percent // 100) + 1
                rare = np.argsort(counts[_cell(own, len(counts))], kind="stable")[:first]
                keys.append(own[rare])
                ids.append(set_id)
                sizes.append(n)
            if ids:
                each = [len(x) for x in keys]
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": np.concatenate(keys).astype(np.int64),
                        "set_id": np.repeat(np.array(ids, np.int64), each),
                        "n": np.repeat(np.array(sizes, np.int32), each),
                        "pos": np.concatenate([np.arange(x, dtype=np.int32) for x in each]),
                    }
                )

    return prefixes


def _least_shared(n_a, n_b, percent: int):
    """How many shingles sets of these sizes must share."""
    return -(-percent * (n_a + n_b) // (100 + percent))


def _meetings(percent: int):
    """From rows sorted by (key, n, set_id): those that may be the first shingle a pair shares, each with a partner before it.

    The smaller set of a pair must have room for the overlap behind the shingle even if both are equally large: such rows are
    `early`. A row stays if an early row before it, or, early itself, a row behind it, is of similar size. Streams: only the last row is carried on.
    """

    def meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in chain(batches, [None]):
            if batch is None:
                if held is None:
                    return
                rows = {c: np.array([held[c]], dtype=np.int64) for c in ("key", "set_id", "n", "pos")}
            elif not batch.num_rows:
                continue
            else:
                rows = {c: batch.column(c).to_numpy().astype(np.int64) for c in ("key", "set_id", "n", "pos")}
                if held:
                    rows = {c: np.append(held[c], x) for c, x in rows.items()}
            key, set_id, n, pos = rows.values()
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (set_id[1:] != set_id[:-1])
            key, set_id, n, pos = key[new], set_id[new], n[new], pos[new]
            at = np.arange(len(key))
            early = n - pos >= _least_shared(n, n, percent)
            first = np.ones(len(key), bool)
            first[1:] = key[1:] != key[:-1]
            begin = np.maximum.accumulate(np.where(first, at, 0))
            before = np.append(-1, np.maximum.accumulate(np.where(early, at, -1))[:-1])
            here = before >= begin
            before_n, before_id = np.where(here, n[before], -1), np.where(here, set_id[before], 0)
            if held:
                carried = ~here & (begin == 0)
                before_n[carried], before_id[carried] = held["before_n"], held["before_id"]
            met = 100 * before_n >= percent * n
            # The partner is the first row of the run of similar sizes, or the early row before if that one is too small.
            lead = np.maximum.accumulate(np.where(met, -1, at))
            leader, leader_n = set_id[lead], n[lead]
            if held:
                leader[lead < 0], leader_n[lead < 0] = held["leader"], held["leader_n"]
            fits = met & (100 * leader_n >= percent * n)
            partner = np.where(fits, leader, before_id)
            follows = np.zeros(len(key), bool)
            follows[:-1] = early[:-1] & ~first[1:] & (100 * n[:-1] >= percent * n[1:])
            last = len(key) - 1
            done = last if batch is not None else last + 1
            out = np.flatnonzero((met | follows)[:done])
            if len(out):
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": key[out],
                        "set_id": set_id[out],
                        "n": n[out].astype(np.int32),
                        "pos": pos[out].astype(np.int32),
                        "partner": pa.array(partner[out], pa.int64(), mask=~met[out]),
                    }
                )
            names = ("key", "set_id", "n", "pos", "before_n", "before_id", "leader", "leader_n")
            held = dict(zip(names, (int(x[last]) for x in (key, set_id, n, pos, before_n, before_id, leader, leader_n))))

    return meetings


def _full_sets(k: int):
    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text"):
            sets = list(shingle_sets(words_of(part.column("text")), k))
            yield pa.RecordBatch.from_pydict(
                {
                    "set_id": pa.array([_set_id(s) for s in sets], pa.int64()),
                    "n": pa.array([len(s) for s in sets], pa.int32()),
                    "shingles": list_column(sets, pa.int64()),
                }
            )

    return full


def _prints(k: int):
    """The first 16 bits of each shingle's hash, sorted: a quarter of the set, and nearly as sharp."""

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text"):
            sets = list(shingle_sets(words_of(part.column("text")), k))
            yield pa.RecordBatch.from_pydict(
                {
                    "set_id": pa.array([_set_id(s) for s in sets], pa.int64()),
                    "prints": pa.array([(s >> np.uint64(48)).astype(np.uint16).tobytes() for s in sets], pa.binary()),
                }
            )

    return prints


def _narrow(percent: int):
    """Pairs whose prints agree often enough; shingles that are shared have equal prints."""

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, two in zip(batch.column("prints_a"), batch.column("prints_b")):
                x, y = np.frombuffer(one.as_py(), np.uint16), np.frombuffer(two.as_py(), np.uint16)
                # The i-th of equal prints can only meet the i-th: both texts' are numbered and compared.
                most = len(np.intersect1d(_numbered(x), _numbered(y), assume_unique=True))
                keep.append((100 + percent) * most >= percent * (len(x) + len(y)))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return narrow


def _numbered(sorted_prints: np.ndarray) -> np.ndarray:
    edges = runs_of(sorted_prints)
    place = np.arange(len(sorted_prints)) - np.repeat(edges[:-1], np.diff(edges))
    return sorted_prints.astype(np.int64) << 32 | place


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity."""
    side = lambda c: sets.select(
        F.col("set_id").alias(c), F.col("n").alias(f"n_{c}"), F.col("shingles").alias(f"s_{c}")
    )
    shared = F.size(F.array_intersect("s_a", "s_b"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").withColumn("shared", shared)
    enough = 100 * F.col("shared") >= percent * (F.col("n_a") + F.col("n_b") - F.col("shared"))
    return both.where(enough).select("a", "b")


def _grow(percent: int):
    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Trees from rows sorted by block: a leaf is up to LEAF rows of a block that follow each other, a
        parent up to LEAF leaves. A block of one leaf is compared at once and gives pairs; of others the nodes go on."""
        open_rows, leaves, key, held = [], [], None, 0
        out = {c: [] for c in _NODES.names}

        def put(row: dict) -> None:
            nonlocal held
            held += 1 + len(row.get("members") or ())
            for c in out:
                out[c].append(row.get(c))

        def node(level: int, number: int, of: list[dict], members: list | None) -> dict:
            size = min(len(r["bits"]) for r in of)
            bits = np.bitwise_or.reduce([folded(r["bits"], size) for r in of])
            # Folding makes tokens share bits: the slack is that of the node's own width.
            slack = max(r["n_max"] - int(np.bitwise_count(folded(r["bits"], size)).sum()) for r in of) if level == 0 else None
            if level:
                slack = max(r["slack"] for r in of) + (0 if all(len(r["bits"]) == size for r in of) else 1 << 30)
            made = {
                "key": key,
                "level": level,
                "no": number,
                "parent": number // LEAF,
                "bitmap": bits.tobytes(),
                "n_min": min(r["n_min"] for r in of),
                "n_max": max(r["n_max"] for r in of),
                "slack": slack,
                "members": members,
            }
            return {**made, "bits": bits}

        def members() -> list[dict]:
            return [{c: r[c] for c in ("set_id", "n", "pos", "label", "bitmap")} for r in open_rows]

        def close_leaf() -> None:
            nonlocal leaf_no
            put(leaf := node(0, leaf_no, open_rows, members()))
            leaves.append(leaf)
            leaf_no += 1
            open_rows.clear()
            if len(leaves) == LEAF:
                close_parent()

        def close_parent() -> None:
            if leaves:
                put(node(1, leaves[0]["no"] // LEAF, leaves, None))
                leaves.clear()

        def close_block() -> None:
            if open_rows and not leaf_no:
                for a, b in _leaf_pairs(members(), None, percent):
                    put({"a": a, "b": b})
                open_rows.clear()
            elif open_rows:
                close_leaf()
            close_parent()

        leaf_no = 0
        for batch in batches:
            for row in chain.from_iterable(batch.slice(at, 512).to_pylist() for at in range(0, batch.num_rows, 512)):
                if row["key"] != key:
                    close_block()
                    key, leaf_no = row["key"], 0
                elif len(open_rows) == LEAF:
                    close_leaf()
                bits = np.frombuffer(row["bitmap"], dtype=np.uint8)
                open_rows.append({**row, "bits": bits, "n_min": row["n"], "n_max": row["n"]})
                if held >= 2048:
                    yield pa.RecordBatch.from_pydict(out, schema=_NODES)
                    out, held = {c: [] for c in out}, 0
        close_block()
        yield pa.RecordBatch.from_pydict(out, schema=_NODES)

    return grow


_MEMBER = pa.struct(
    [("set_id", pa.int64()), ("n", pa.int32()), ("pos", pa.int32()), ("label", pa.int64()), ("bitmap", pa.binary())]
)
_NODES = pa.schema(
    [
        ("key", pa.int64()),
        ("level", pa.int32()),
        ("no", pa.int64()),
        ("parent", pa.int64()),
        ("bitmap", pa.binary()),
        ("n_min", pa.int32()),
        ("n_max", pa.int32()),
        ("slack", pa.int32()),
        ("members", pa.list_(_MEMBER)),
        ("a", pa.int64()),
        ("b", pa.int64()),
    ]
)
_NODE_SCHEMA = (
    "key long, level int, no long, parent long, bitmap binary, n_min int, n_max int, slack int, "
    "members array<struct<set_id: long, n: int, pos: int, label: long, bitmap: binary>>, a long, b long"
)


def _count(bits: np.ndarray) -> np.ndarray:
    return np.bitwise_count(bits).sum(axis=-1, dtype=np.int64)


def _most_shared(one: bytes, two: bytes, slack_one: int, slack_two: int) -> int:
    """Shingles that two nodes can share: common bits, and tokens that may hide behind a bit of either."""
    x, y = np.frombuffer(one, np.uint8), np.frombuffer(two, np.uint8)
    size = min(len(x), len(y))
    # The slack of a node holds at its own width only.
    slack = [s for s, b in ((slack_one, x), (slack_two, y)) if len(b) == size]
    return int(_count(folded(x, size) & folded(y, size))) + min(slack)


def _possible(percent: int):
    """Pairs of nodes whose largest possible overlap is enough for their smallest sizes."""

    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("bitmap_a", "bitmap_b", "slack_a", "slack_b", "n_min_a", "n_min_b", "n_max_a", "n_max_b")
        for batch in batches:
            keep = []
            for one, two, sa, sb, low_a, low_b, high_a, high_b in zip(*(batch.column(c).to_pylist() for c in names)):
                most = min(_most_shared(one, two, sa, sb), high_a, high_b)
                keep.append((100 + percent) * most >= percent * (low_a + low_b))
            kept = batch.filter(pa.array(keep, pa.bool_()))
            yield kept.select([c for c in kept.schema.names if c in ("key", "no_a", "no_b", "a", "b")])

    return possible


def _leaf_pairs(one: list[dict], two: list[dict] | None, percent: int) -> Iterator[tuple[int, int]]:
    """Sets of two leaves (of one, without ``two``) that may reach the similarity and differ in label."""
    other = one if two is None else two
    size = min(len(m["bitmap"]) for m in (*one, *other))
    side = lambda ms: (
        np.stack([folded(np.frombuffer(m["bitmap"], np.uint8), size) for m in ms]),
        *(np.array([m[c] for m in ms], dtype=np.int64) for c in ("n", "pos", "label", "set_id")),
    )
    x, n_x, pos_x, label_x, id_x = side(one)
    y, n_y, pos_y, label_y, id_y = (x, n_x, pos_x, label_x, id_x) if two is None else side(other)
    hidden_x, hidden_y = n_x - _count(x), n_y - _count(y)
    for i in range(len(one)):
        most = _count(x[i] & y) + np.minimum(hidden_x[i], hidden_y)
        most = np.minimum(most, np.minimum(n_x[i], n_y))
        # If this is the first shingle they share, the others stand behind it in both.
        most = np.minimum(most, np.minimum(n_x[i] - pos_x[i], n_y - pos_y))
        good = ((100 + percent) * most >= percent * (n_x[i] + n_y)) & (label_x[i] != label_y)
        if two is None:
            good[: i + 1] = False
        for j in np.flatnonzero(good):
            yield int(id_x[i]), int(id_y[j])


def _plausible(percent: int):
    """Pairs of sets whose bitmaps allow the similarity."""

    def plausible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, two, n_a, n_b in zip(*(batch.column(c).to_pylist() for c in ("bitmap_a", "bitmap_b", "n_a", "n_b"))):
                x, y = np.frombuffer(one, np.uint8), np.frombuffer(two, np.uint8)
                size = min(len(x), len(y))
                x, y = folded(x, size), folded(y, size)
                most = int(_count(x & y)) + min(n_a - int(_count(x)), n_b - int(_count(y)))
                keep.append((100 + percent) * min(most, n_a, n_b) >= percent * (n_a + n_b))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return plausible


def _compare(percent: int):
    """Pairs of sets from pairs of leaves."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = []
            # Leaves are turned into Python one pair at a time: a batch may hold thousands, with all their bitmaps.
            for one, two, same in zip(*(batch.column(c) for c in ("members_a", "members_b", "same"))):
                pairs += _leaf_pairs(one.as_py(), None if same.as_py() else two.as_py(), percent)
            a, b = zip(*pairs) if pairs else ((), ())
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return compare


def tree_candidates(rows: DataFrame, percent: int, steps: Steps) -> DataFrame:
    """Pairs of sets (a < b) of different labels that meet in a block and may reach the similarity.

    ``rows``: key (the block), set_id, n, pos (the block's place in the set), label, linked, bitmap.
    """
    grouped = F.when(F.col("linked"), F.col("label"))
    ordered = rows.repartition("key").sortWithinPartitions(
        F.col("key"), grouped.asc_nulls_last(), F.col("n"), F.col("set_id")
    )
    grown = steps.write(
        ordered.select("key", "set_id", "n", "pos", "label", "bitmap").mapInArrow(_grow(percent), _NODE_SCHEMA),
        release=True,
    )
    nodes = grown.where("level is not null")

    def side(of: DataFrame, end: str, *kept: str) -> DataFrame:
        return of.select("key", *[F.col(c).alias(f"{c}_{end}") for c in kept])

    sizes_fit = (100 * F.col("n_max_a") >= percent * F.col("n_min_b")) & (
        100 * F.col("n_max_b") >= percent * F.col("n_min_a")
    )
    facts = ("no", "bitmap", "n_min", "n_max", "slack")
    pair = "key long, no_a long, no_b long"
    tops = nodes.where("level = 1")
    top_pairs = (
        side(tops, "a", *facts)
        .join(side(tops, "b", *facts), "key")
        .where((F.col("no_a") <= F.col("no_b")) & sizes_fit)
        .mapInArrow(_possible(percent), pair)
        .select("key", F.col("no_a").alias("parent_a"), F.col("no_b").alias("parent_b"))
    )
    leaves = nodes.where("level = 0")
    leaf_pairs = (
        top_pairs.join(side(leaves, "a", "parent", *facts), ["key", "parent_a"])
        .join(side(leaves, "b", "parent", *facts), ["key", "parent_b"])
        .where((F.col("no_a") <= F.col("no_b")) & sizes_fit)
        .mapInArrow(_possible(percent), pair)
    )
    opened = (
        leaf_pairs.join(side(leaves, "a", "no", "members"), ["key", "no_a"])
        .join(side(leaves, "b", "no", "members"), ["key", "no_b"])
        .select("members_a", "members_b", (F.col("no_a") == F.col("no_b")).alias("same"))
    )
    found = opened.mapInArrow(_compare(percent), "a long, b long")
    found = found.unionByName(grown.where("a is not null").select("a", "b"))
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def jaccard_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = PERCENT,
    k: int = SHINGLE,
    cells: int = CELLS,
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, text_hash, label (one per component).

    Two documents link if 100 * shared shingles >= ``percent`` * shingles of either; ``component_id`` is the
    smallest doc_id that links reach. Shingles are runs of ``k`` words, A-Z lower-cased; a shorter text is one
    shingle. Null, empty and blank texts have no shingles and link with nothing: their component is their own
    doc_id. Repeated rows are in one component; null ids take part, but are no component's smallest id unless all
    are null. Other columns are not read; an empty table gives no rows. ``cells`` is the number of counters that order shingles
    (4 bytes each, sent to all tasks): it changes the work, not the result.
    """
    spark = docs.sparkSession
    steps = Steps(spark)
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash"),
    )
    surveyed = steps.write(
        texts.mapInArrow(
            _survey(k, cells), "doc_id long, text_hash long, set_id long, n long, bitmap binary, cells int"
        )
    )
    members = surveyed.where("cells is null").drop("cells")
    shared = spark.sparkContext.broadcast(_order(surveyed, cells))
    first = texts.select("text").mapInArrow(_prefixes(k, percent, shared), "key long, set_id long, n int, pos int")
    met = steps.write(
        first.repartition("key")
        .sortWithinPartitions("key", "n", "set_id")
        .mapInArrow(_meetings(percent), "key long, set_id long, n int, pos int, partner long"),
        release=True,
    )

    wanted = met.select("set_id").distinct()
    bitmaps = steps.write(
        members.join(wanted, "set_id", "left_semi")
        .groupBy("set_id")
        .agg(
            F.min("text_hash").alias("text_hash"),
            F.any_value("bitmap").alias("bitmap"),
            F.any_value("n").alias("n"),
        ),
        release=True,
    )

    def of_sets(pairs: DataFrame, mapper, schema: str) -> DataFrame:
        """What ``mapper`` makes of the sets that stand in the pairs, from one text each."""
        ids = pairs.select(F.explode(F.array("a", "b")).alias("set_id")).distinct()
        hashes = bitmaps.join(ids, "set_id", "left_semi").select("text_hash")
        chosen = texts.select("text", "text_hash").join(hashes, "text_hash", "left_semi")
        found = chosen.dropDuplicates(["text_hash"]).select("text")
        return steps.write(found.mapInArrow(mapper, schema), release=True)

    def whole_sets(pairs: DataFrame) -> DataFrame:
        return of_sets(pairs, _full_sets(k), "set_id long, n int, shingles array<bigint>")

    def narrowed(pairs: DataFrame) -> DataFrame:
        prints = of_sets(pairs, _prints(k), "set_id long, prints binary")
        side = lambda c: prints.select(F.col("set_id").alias(c), F.col("prints").alias(f"prints_{c}"))
        both = pairs.join(side("a"), "a").join(side("b"), "b")
        out = steps.write(both.mapInArrow(_narrow(percent), "a long, b long"), release=True)
        steps.forget(prints)
        return out

    times = met.where("partner is not null").groupBy("set_id", "partner").agg(F.count(F.lit(1)).alias("times"))
    best = times.groupBy("set_id").agg(F.max_by("partner", F.struct("times", "partner")).alias("partner"))
    # The hub of a block: the one with the earliest place, of equal ones the smallest.
    place = F.col("pos").cast("long") * (1 << 32) + F.col("n")
    hubs = met.groupBy("key").agg(F.min_by("set_id", place).alias("hub"), F.min_by("n", place).alias("hub_n"))
    alike = (100 * F.col("n") >= percent * F.col("hub_n")) & (100 * F.col("hub_n") >= percent * F.col("n"))
    to_hub = met.join(hubs, "key").where((F.col("set_id") != F.col("hub")) & alike)
    to_hub = to_hub.groupBy("set_id", "hub").agg(F.count(F.lit(1)).alias("times"))
    to_hub = to_hub.groupBy("set_id").agg(F.max_by("hub", F.struct("times", "hub")).alias("partner"))
    best = best.unionByName(to_hub)
    pairs = best.select(F.least("set_id", "partner").alias("a"), F.greatest("set_id", "partner").alias("b"))
    side = lambda c: bitmaps.select(
        F.col("set_id").alias(c), F.col("n").alias(f"n_{c}"), F.col("bitmap").alias(f"bitmap_{c}")
    )
    both = pairs.distinct().join(side("a"), "a").join(side("b"), "b")
    # The bitmaps rule most pairs out; whole sets are fetched for the others only.
    pairs = steps.write(both.mapInArrow(_plausible(percent), "a long, b long"), release=True)
    sets = whole_sets(pairs)
    links = steps.write(verified(pairs, sets, percent), release=True)
    steps.forget(sets)
    labels = components(links, steps)

    labelled = met.join(labels.withColumnRenamed("id", "set_id"), "set_id", "left").select(
        "key", "set_id", "n", "pos", F.coalesce("label", "set_id").alias("label"), F.col("label").isNotNull().alias("linked")
    )
    labelled = steps.write(labelled, release=True)
    mixed_blocks = (
        labelled.groupBy("key")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"))
        .where("low <> high")
        .select("key")
    )
    open_rows = labelled.join(mixed_blocks, "key", "left_semi").join(
        bitmaps.select("set_id", "bitmap"), "set_id"
    )
    more = steps.write(tree_candidates(open_rows, percent, steps), release=True)
    if more.head(1):
        more = narrowed(more)
        found = steps.write(verified(more, whole_sets(more), percent), release=True)
        labels = components(links.unionByName(found), steps)

    classed = members.join(labels.withColumnRenamed("id", "set_id"), "set_id", "left").withColumn(
        "label", F.coalesce("label", "set_id")
    )
    smallest = classed.where("n > 0").groupBy("label").agg(F.min("doc_id").alias("least"))
    linked = classed.where("n > 0").join(smallest, "label")
    alone = classed.where("n = 0").withColumn("least", F.col("doc_id"))
    return steps.result(
        linked.unionByName(alone, allowMissingColumns=True).select(
            "doc_id", F.col("n").alias("n_shingles"), F.col("least").alias("component_id"), "text_hash", "label"
        )
    )


def one_per_class(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = PERCENT,
    k: int = SHINGLE,
) -> DataFrame:
    """The rows of ``docs`` less near-duplicates, same columns, whatever their names: of each component the row with the least id.

    Texts without a shingle link with nothing and all stay; of repeated rows one stays.
    """
    docs, now, back = shield(docs, "_row_id", "_row_hash", "_id", "_hash")
    id_col, text_col = now[id_col], now[text_col]
    classes = jaccard_classes(docs, id_col, text_col, percent, k)
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    stay = (
        classes.where("n_shingles > 0")
        .groupBy("label")
        .agg(F.min(first).alias("first"))
        .select(F.col("first.doc_id").alias("_id"), F.col("first.text_hash").alias("_hash"))
    )
    text_hash = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    blank = F.btrim(F.coalesce(F.col(text_col), F.lit("")), F.lit(" \t\n\v\f\r")) == ""
    same = F.col("_row_id").eqNullSafe(F.col("_id")) & (F.col("_row_hash") == F.col("_hash"))
    kept = (
        docs.where(~blank)
        .withColumns({"_row_id": F.col(id_col).cast("long"), "_row_hash": text_hash})
        .join(stay, same, "left_semi")
        .dropDuplicates(["_row_id", "_row_hash"])
    )
    return back(docs.where(blank).unionByName(kept.select(*docs.columns)))
