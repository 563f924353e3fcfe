"""Alignment of the tokens of two tokenizers by interval coalescing, and corpus counts of linked ids.

Tokens are byte ranges of the text. Sorted by start, with the running maximum of their ends, they fall into groups: a group
ends where a token starts at or after all ends so far, which is where both tokenizers cut. Tokens of a group are linked.

Counting links over the corpus never moves a document's links as rows. Documents lie in blocks of about ``BLOCK_BYTES`` of text; a
block lists its distinct id pairs once, with the number of its documents that hold each, and a document's links are numbers
into that list. The lists are summed over the corpus, the sums go back to the blocks that asked, and each block meets
its documents in one group of bounded size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vejrkraft.llm.steps import Steps
from vejrkraft.llm.tokenizers_read import ByteLevel, Pieces, file_bytes, vocabulary
from vejrkraft.llm.words import chunks

BLOCK_BYTES = 8 << 20
PAIRS_AT_ONCE = 1 << 22
_PAGE = 1 << 16


@dataclass
class Aligned:
    """Tokens of a chunk of texts: ids and groups per side; ``first_group[i]`` is where the groups of text i begin."""

    a: np.ndarray
    b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    first_group: np.ndarray

    @property
    def group_sizes(self) -> tuple[np.ndarray, np.ndarray]:
        n = self.first_group[-1]
        return np.bincount(self.group_a, minlength=n), np.bincount(self.group_b, minlength=n)


def coalesced(start: np.ndarray, end: np.ndarray, side: np.ndarray) -> np.ndarray:
    """The group of each interval: groups break where a start reaches the running maximum of the ends."""
    group = np.zeros(len(start), dtype=np.int64)
    if len(start):
        order = np.lexsort((side, start))
        reach = np.maximum.accumulate(end[order])
        group[order[1:]] = np.cumsum(start[order][1:] >= reach[:-1])
    return group


def align_texts(texts: list[str | None], first, second) -> Aligned:
    """Tokens of both vocabularies and their groups. The first reads a space and the text, the second the text, before which it
    puts a space itself. A text has no tokens if it is null or empty or either side's bytes are not space + text."""
    texts = [t or "" for t in texts]
    spaced = [" " + t for t in texts]
    whole = [t.encode() for t in spaced]
    a, n_a = first.encode(spaced)
    b, n_b = second.encode(texts)
    good = np.array([t != "" for t in texts], dtype=bool)
    good &= first.restores(a, n_a, whole) & second.restores(b, n_b, whole)
    a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
    n_a, n_b = n_a * good, n_b * good
    length = np.concatenate([first.lengths[a], second.lengths[b]])
    end = np.concatenate([np.cumsum(length[: len(a)]), np.cumsum(length[len(a) :])])
    side = np.repeat([0, 1], [len(a), len(b)])
    group = coalesced(end - length, end, side)
    group_a, group_b = group[: len(a)], group[len(a) :]
    total = int(group_a[-1]) + 1 if len(a) else 0
    begins = np.concatenate([group_a, [total]])[np.concatenate([[0], np.cumsum(n_a)])]
    return Aligned(a, b, n_a, n_b, group_a, group_b, begins)


def _products(ga, ia, ca, gb, ib, cb, groups: int) -> Iterator[tuple[np.ndarray, ...]]:
    """All (group, a, b, times) of entries that share a group, in slices of about ``PAIRS_AT_ONCE``. Entries are sorted by group."""
    begin = np.searchsorted(gb, np.arange(groups + 1))
    each = np.diff(begin)[ga]
    upto = np.concatenate([[0], np.cumsum(each)])
    low = 0
    while low < len(ga):
        high = max(low + 1, int(np.searchsorted(upto, upto[low] + PAIRS_AT_ONCE, side="right")) - 1)
        n = each[low:high]
        left = np.repeat(np.arange(low, high), n)
        right = np.arange(upto[high] - upto[low]) - np.repeat(upto[low:high] - upto[low], n) + begin[ga[left]]
        yield ga[left], ia[left], ib[right], ca[left] * cb[right]
        low = high


def _tally(key: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sum of their times."""
    if not len(key):
        return key, times
    order = np.argsort(key)
    key, times = key[order], times[order]
    cut = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
    return key[cut], np.add.reduceat(times, cut)


def _entries(group: np.ndarray, ids: np.ndarray, many: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Entries (group, id, times) of the groups with one token on a side, then of those with several on both, where equal ids of
    a group are one entry: a group of repeated ids makes few pairs, however long it is."""
    inside = many[group]
    yield group[~inside], ids[~inside], np.ones(int((~inside).sum()), dtype=np.int64)
    key, times = _tally(group[inside] * width + ids[inside], np.ones(int(inside.sum()), dtype=np.int64))
    yield key // width, key % width, times


def linked_pairs(found: Aligned, width_a: int, width_b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text and pair of linked ids: the text's number, the pair as ``a * width_b + b``, and how many links it is."""
    size_a, size_b = found.group_sizes
    many = (size_a > 1) & (size_b > 1)
    text_of = np.repeat(np.arange(len(found.n_a)), np.diff(found.first_group))
    codes = width_a * width_b
    keys, times = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    both = zip(_entries(found.group_a, found.a, many, width_a), _entries(found.group_b, found.b, many, width_b))
    for left, right in both:
        for group, a, b, n in _products(*left, *right, len(many)):
            key, n = _tally(text_of[group] * codes + a * width_b + b, n)
            keys.append(key)
            times.append(n)
    key, n = _tally(np.concatenate(keys), np.concatenate(times))
    return key // codes, key % codes, n


class _Writer:
    """The groups of each text as ``a1,a2|b1;a3|b2,b3``: ids of both sides, group by group."""

    def __init__(self, ids: int) -> None:
        numbers = [str(i) for i in range(ids)]
        self.ids = ids
        self.words = np.array([s + n for s in ("", ",", ";", "|") for n in numbers], dtype=object)

    def __call__(self, found: Aligned) -> list[str]:
        a, b = found.group_a, found.group_b
        n = found.first_group[-1]
        before_a = np.searchsorted(b, np.arange(n + 1))  # tokens of the other side in lower groups
        before_b = np.searchsorted(a, np.arange(n + 1))
        first = lambda g: np.concatenate([[True], g[1:] != g[:-1]])[: len(g)]
        mark_a = np.where(first(a), 2, 1)
        mark_a[(np.cumsum(found.n_a) - found.n_a)[found.n_a > 0]] = 0
        mark_b = np.where(first(b), 3, 1)
        word = np.zeros(len(a) + len(b), dtype=np.int64)
        word[np.arange(len(a)) + before_a[a]] = mark_a * self.ids + found.a
        word[np.arange(len(b)) + before_b[b + 1]] = mark_b * self.ids + found.b
        words = self.words[word].tolist()
        ends = np.concatenate([[0], np.cumsum(found.n_a + found.n_b)]).tolist()
        return ["".join(words[x:y]) for x, y in zip(ends[:-1], ends[1:])]


def _packed(places: np.ndarray, times: np.ndarray, pages: int) -> tuple[bytes, bytes]:
    """Ascending places as 16-bit numbers after the size of each page of 2^16; times as bytes, 255 for those that follow."""
    sizes = np.bincount(places // _PAGE, minlength=pages).astype("<u4")
    large = times[times >= 255].astype("<u4")
    return (
        sizes.tobytes() + (places % _PAGE).astype("<u2").tobytes(),
        np.minimum(times, 255).astype(np.uint8).tobytes() + large.tobytes(),
    )


def _unpacked(places: bytes, times: bytes, pages: int) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.frombuffer(places, "<u4", pages)
    low = np.frombuffer(places, "<u2", offset=4 * pages).astype(np.int64)
    often = np.frombuffer(times, np.uint8, len(low)).astype(np.int64)
    often[often == 255] = np.frombuffer(times, "<u4", offset=len(low))
    return low + np.repeat(np.arange(pages) * _PAGE, sizes), often


class _Block:
    """Texts of one block, until it is full."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.size = 0

    def add(self, ids: list, found: Aligned, groups: list[str], pairs: tuple[np.ndarray, ...]) -> None:
        text, pair, times = pairs
        cuts = np.searchsorted(text, np.arange(len(ids) + 1)).tolist()
        links = np.concatenate([[0], np.cumsum(times)])[cuts]
        counts = (found.n_a, found.n_b, np.diff(found.first_group), np.diff(links))
        self.rows += zip(ids, *(c.tolist() for c in counts), groups)
        self.pairs += [pair[x:y] for x, y in zip(cuts[:-1], cuts[1:])]
        self.times += [times[x:y] for x, y in zip(cuts[:-1], cuts[1:])]

    def batches(self, number: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        every = np.concatenate([*self.pairs, np.zeros(0, np.int64)])
        distinct, place = np.unique(every, return_inverse=True)
        pages = -(-len(distinct) // _PAGE)
        cuts = np.concatenate([[0], np.cumsum([len(p) for p in self.pairs])]).tolist()
        links, times = [], []
        for x, y, n in zip(cuts[:-1], cuts[1:], self.times):
            packed = _packed(place[x:y], n, pages) if y > x else (None, None)
            links.append(packed[0])
            times.append(packed[1])
        n = len(self.rows)
        columns = [list(c) for c in zip(*self.rows)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([number] * n, pa.int64()),
                *[pa.array(c, schema.field(i + 1).type) for i, c in enumerate(columns)],
                pa.array(links, pa.binary()),
                pa.array(times, pa.binary()),
                pa.nulls(n, pa.list_(pa.int64())),
                pa.nulls(n, pa.list_(pa.int64())),
            ],
            schema=schema,
        )
        if len(distinct):
            docs = np.bincount(place)
            row = {f.name: pa.nulls(1, f.type) for f in schema}
            row["block"] = pa.array([number], pa.int64())
            row["pairs"] = pa.array([distinct], pa.list_(pa.int64()))
            row["holders"] = pa.array([docs], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(list(row.values()), schema=schema)


def _blocks(batches: Iterator[pa.RecordBatch], first, second, block_bytes: int) -> Iterator[pa.RecordBatch]:
    first, second = vocabulary(ByteLevel, first.value), vocabulary(Pieces, second.value)
    width_a, width_b = len(first.entries), len(second.entries)
    write = _Writer(max(width_a, width_b))
    number, block, schema = TaskContext.get().partitionId() << 32, _Block(), None
    for chunk in chunks(batches, "text"):
        schema = schema or pa.schema(
            [
                ("block", pa.int64()),
                ("doc_id", chunk.schema.field("doc_id").type),
                *[(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")],
                ("groups", pa.string()),
                ("links", pa.binary()),
                ("times", pa.binary()),
                ("pairs", pa.list_(pa.int64())),
                ("holders", pa.list_(pa.int64())),
            ]
        )
        texts = chunk.column("text").to_pylist()
        found = align_texts(texts, first, second)
        block.add(chunk.column("doc_id").to_pylist(), found, write(found), linked_pairs(found, width_a, width_b))
        block.size += chunk.column("text").nbytes
        if block.size >= block_bytes:
            yield from block.batches(number, schema)
            number, block = number + 1, _Block()
    if block.rows:
        yield from block.batches(number, schema)


def _counted(docs: pa.Table, sums: pa.Table) -> pa.Table:
    """One block: its documents, and the corpus counts of its pairs."""
    place = sums.column("place").to_numpy()
    count = np.zeros(len(place), dtype=np.int64)
    best = np.zeros(len(place), dtype=np.int64)
    count[place] = sums.column("count").to_numpy()
    best[place] = sums.column("best").to_numpy()
    pages = -(-len(place) // _PAGE)
    n_best, total = [], []
    for links, times in zip(docs.column("links").to_pylist(), docs.column("times").to_pylist()):
        at, n = _unpacked(links, times, pages) if links is not None else (np.zeros(0, np.int64),) * 2
        n_best.append(int((best[at] * n).sum()))
        total.append(int((count[at] * n).sum()))
    kept = docs.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
    return (
        kept.append_column("n_best", pa.array(n_best, pa.int64()))
        .append_column("count_sum", pa.array(total, pa.int64()))
        .append_column("groups", docs.column("groups"))
    )


def align_tokens(
    docs: DataFrame,
    byte_level: str,
    pieces: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: Callable[[Column], Column] = lambda groups: groups,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups.

    ``byte_level`` is the path of a byte-level BPE file (A, which reads space + text), ``pieces`` that of a sentencepiece model (B, which
    puts the space itself), both without special tokens. The tokens are cut into groups at the bytes where both end; all
    pairs of an A and a B token of a group are links. The count of a pair of ids is the number of rows that hold it linked;
    ``n_best`` counts the links whose count is the highest of their A id, ties included, ``count_sum`` sums over the links.
    ``groups`` is the text `a1,a2|b1;a3|b2,b3` as ``keep`` turns it, so that a caller who wants less than the text never stores it.
    Texts that are null or empty, or that a side's bytes do not restore, have no tokens: zeros and the empty text. A null id stays null;
    repeated rows are rows of their own, in counts too; other columns are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    steps = Steps(spark)
    first, second = (spark.sparkContext.broadcast(file_bytes(p)) for p in (byte_level, pieces))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    counts = "n_a long, n_b long, n_groups long, n_links long"
    blocks = texts.mapInArrow(
        lambda batches: _blocks(batches, first, second, block_bytes),
        f"block long, doc_id {kind}, {counts}, groups string, links binary, times binary, pairs array<long>, holders array<long>",
    )
    blocks = steps.write(blocks.withColumn("groups", keep(F.col("groups"))))
    asked = blocks.where("pairs is not null").select("block", F.posexplode(F.arrays_zip("pairs", "holders")).alias("place", "own"))
    asked = asked.select("block", "place", F.col("own.pairs").alias("pair"), F.col("own.holders").alias("holders"))
    width = len(vocabulary(Pieces, second.value).entries)
    # One A id has as many pairs as the second vocabulary has ids, at most.
    of_a = Window.partitionBy(F.expr(f"pair div {width}"))
    sums = asked.groupBy("pair").agg(F.sum("holders").alias("count"))
    sums = sums.withColumn("best", (F.col("count") == F.max("count").over(of_a)).cast("int"))
    answers = asked.select("block", "place", "pair").join(sums, "pair")
    answers = answers.select(F.col("block").alias("of_block"), "place", "count", "best")
    own = blocks.where("pairs is null").select("block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "links", "times")
    told = own.groupBy("block").cogroup(answers.groupBy("of_block"))
    kept = blocks.schema["groups"].dataType.simpleString()
    return steps.result(
        told.applyInArrow(_counted, f"doc_id {kind}, {counts}, n_best long, count_sum long, groups {kept}")
    )
