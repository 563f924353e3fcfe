"""Benchmark decontamination by size-partitioned MinHash containment search.

The test items are the queries. An item's sketch is the smallest hashes of its shingles: with
n shingles of which a document must hold m, any n - m + 1 of them include one that the document holds, so the
sketch of that size misses nothing, however long the document. (Signatures of fixed length over
whole documents would: a short item is a vanishing part of a long document.) Items are parted by size, a part for each power of
two, so sketches of one part have similar lengths and a document too small for a part is not compared with it. A document's
shingles are looked up in the sketches of each part; a hit names an item, and each item named is verified by exact
containment.

Items are taken in blocks of bounded size, so what travels with the tasks has a proven bound.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vejrkraft.llm.words import PLAIN, SHINGLE, chunks, runs_of, shingle_sets, words_of
from vejrkraft.session import staged

THRESHOLD = 80  # percent of an item's shingles
BLOCK_SHINGLES = 1 << 19


def needed(n: int | np.ndarray, percent: int):
    """The least number of an item's ``n`` shingles that ``percent`` of them asks for."""
    return -(-n * percent // 100)


def _item_sets(k: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Item id, word length of its shingles (k, or all words of a shorter item), shingles."""
        for part in chunks(batches, "text"):
            words = words_of(part.column("text"), PLAIN)
            found = [s.astype(np.int64) for s in shingle_sets(words, k)]
            yield pa.RecordBatch.from_pydict(
                {
                    "item_id": part.column("item_id"),
                    "width": np.minimum(words.counts, k).astype(np.int32),
                    "shingles": pa.array(found, pa.list_(pa.int64())),
                    "n": np.array([len(s) for s in found], dtype=np.int32),
                }
            )

    return sets


class _Part:
    """Items of similar size: their sketches' hashes, sorted, each with its item, and the fewest shingles any of them needs."""

    def __init__(self, items: np.ndarray, sketches: list[np.ndarray], least: int) -> None:
        hashes, owner = np.concatenate(sketches), np.repeat(items, [len(s) for s in sketches])
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.owner, self.least = hashes[order], owner[order], least

    def candidates(self, hits: np.ndarray) -> np.ndarray:
        """Items whose sketch holds one of the shingles ``hits``."""
        low = np.searchsorted(self.hashes, hits, side="left")
        size = np.searchsorted(self.hashes, hits, side="right") - low
        at = np.repeat(low, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        return np.unique(self.owner[at])


class _Index:
    """Items of one block, parted by size."""

    def __init__(self, sets: list[np.ndarray], percent: int) -> None:
        self.sets = sets
        self.sizes = np.array([len(s) for s in sets])
        self.need = needed(self.sizes, percent)
        # Sets are sorted, so their least hashes come first.
        sketch = [s[: n - m + 1] for s, n, m in zip(sets, self.sizes, self.need)]
        size_class = np.array([int(n).bit_length() for n in self.sizes])
        self.parts = []
        for c in np.unique(size_class[self.sizes > 0]):
            items = np.flatnonzero(size_class == c)
            self.parts.append(_Part(items, [sketch[i] for i in items], int(self.need[items].min())))
        self.all = np.unique(np.concatenate(sketch))

    def matches(self, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Items that a document with the sorted shingles ``own`` contains, and how many of theirs it holds."""
        place = np.searchsorted(self.all, own)
        place[place == len(self.all)] = 0
        hits = own[self.all[place] == own]
        if not len(hits):
            return _NONE, _NONE
        named = [part.candidates(hits) for part in self.parts if len(own) >= part.least]
        found, counts = [], []
        for item in np.sort(np.concatenate([_NONE, *named])).tolist():
            at = np.searchsorted(own, self.sets[item])
            at[at == len(own)] = 0
            shared = int((own[at] == self.sets[item]).sum())
            if shared >= self.need[item]:
                found.append(item)
                counts.append(shared)
        return np.array(found, dtype=np.int64), np.array(counts, dtype=np.int64)


_NONE = np.zeros(0, dtype=np.int64)


def _prober(block):
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_width = block.value
        for part in chunks(batches, "text"):
            words = words_of(part.column("text"), PLAIN)
            rows, items, counts, sizes = [], [], [], []
            for width, (ids, index) in by_width.items():
                for i, own in enumerate(shingle_sets(words, width)):
                    if words.counts[i] < width or not len(own):
                        continue
                    found, shared = index.matches(own)
                    rows.extend([i] * len(found))
                    items.extend(ids[found].tolist())
                    counts.extend(shared.tolist())
                    sizes.extend(index.sizes[found].tolist())
            if rows:
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part.column("doc_id").take(pa.array(rows, pa.int64())),
                        "item_id": pa.array(items, pa.int64()),
                        "item_shingles": pa.array(sizes, pa.int32()),
                        "shared": pa.array(counts, pa.int32()),
                    }
                )

    return probe


def _dropper(block, text_col: str):
    """Rows whose text contains no item of the block, whole."""

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, text_col):
            words = words_of(part.column(text_col), PLAIN)
            clean = np.ones(part.num_rows, dtype=bool)
            for width, (_, index) in block.value.items():
                for i, own in enumerate(shingle_sets(words, width)):
                    if clean[i] and words.counts[i] >= width and len(own):
                        clean[i] = not len(index.matches(own)[0])
            yield part.filter(pa.array(clean))

    return drop


def _item_blocks(items: DataFrame, item_col: str, item_text_col: str, percent: int, k: int, block_shingles: int):
    """Broadcast indexes of the items, each of about ``block_shingles`` shingles."""
    spark = items.sparkSession
    asked = items.where(F.col(item_col).isNotNull()).select(
        F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text")
    )
    sets = staged(
        asked.mapInArrow(_item_sets(k), "item_id long, width int, shingles array<bigint>, n int").where("n > 0")
    )
    total = sets.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_shingles))
    # Sizes of hashed blocks vary around block_shingles; an item is in one block.
    parted = sets.withColumn("block", F.pmod(F.xxhash64("item_id", "shingles"), F.lit(blocks)))
    for block in range(blocks):
        rows = parted.where(F.col("block") == block).orderBy("width", "item_id").toArrow()
        if not rows.num_rows:
            continue
        widths = rows.column("width").to_numpy()
        ids = rows.column("item_id").to_numpy()
        own = [np.sort(np.array(s.values.to_numpy()).astype(np.uint64)) for s in rows.column("shingles")]
        edges = runs_of(widths)
        by_width = {
            int(widths[low]): (ids[low:high], _Index(own[low:high], percent))
            for low, high in zip(edges[:-1], edges[1:])
        }
        yield spark.sparkContext.broadcast(by_width)


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    percent: int = THRESHOLD,
    k: int = SHINGLE,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """Per document row and item it contains: doc_id, item_id, item_shingles, shared.

    A document contains an item if it holds ``percent`` of the item's distinct shingles or more: runs of ``k`` words,
    A-Z lower-cased, punctuation apart; an item of fewer words is one run of all of them. Items without a word are
    contained nowhere, null texts are empty. Null ids are reported as null; repeated rows, and items repeated
    under several ids, are reported each. Items with null ids are skipped. Other columns are not read.

    The items are the query set; they are read in blocks of about ``block_shingles`` shingles.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, item_id long, item_shingles int, shared int"
    found = [
        texts.mapInArrow(_prober(block), schema)
        for block in _item_blocks(items, item_col, item_text_col, percent, k, block_shingles)
    ]
    return reduce(DataFrame.unionByName, found) if found else docs.sparkSession.createDataFrame([], schema)


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    percent: int = THRESHOLD,
    k: int = SHINGLE,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """The rows of ``docs``, with all their columns, that contain no item by the rule of ``contained_items``.

    Documents are filtered where they lie, without a shuffle; one pass per block of items.
    """
    for block in _item_blocks(items, item_col, item_text_col, percent, k, block_shingles):
        docs = docs.mapInArrow(_dropper(block, text_col), docs.schema)
    return docs
