"""Quality classifier by importance resampling.

Two generative models of hashed n-grams are counted: one over the target (rows labelled good), one over all raw
text. A document's log weight is the log of the ratio of its likelihoods under the two. Gumbel noise is added to the
log weights and the k largest sums are kept, which samples k documents without replacement in proportion to
their weights.

An n-gram is a word, a pair of words, or a run of word shapes (case, symbols, digits, length, repetition of the word
before), so that words never seen still count by their form.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vejrkraft.llm.names import shield
from vejrkraft.llm.steps import small_batches
from vejrkraft.llm.words import chunks, mixed, words_of
from vejrkraft.session import staged

BUCKETS = 1 << 16
LABELLED_ROWS = 20_000
_SEED = 5
_PRIOR = 10.0

_UPPER, _LOWER, _DIGIT, _SYMBOL, _MARK = (np.zeros(256, dtype=np.int32) for _ in range(5))
_UPPER[65:91] = 1
_LOWER[97:123] = 1
_DIGIT[48:58] = 1
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = 1
_MARK[[ord(c) for c in "!?;:=_~^{}[]"]] = 1


def _shapes(words) -> np.ndarray:
    """A small number per word: its case, symbols, marks, digits, length, and if it repeats the word before."""
    out = np.zeros(len(words.hash), dtype=np.uint64)
    for classes in (_UPPER, _LOWER, _DIGIT, _SYMBOL, _MARK):
        sums = np.concatenate([[0], np.cumsum(classes[words.data])])
        n = np.minimum(sums[words.end] - sums[words.start], 2)
        out = out * np.uint64(3) + n.astype(np.uint64)
    size = np.minimum((words.end - words.start) // 4, 7).astype(np.uint64)
    again = np.zeros(len(out), dtype=np.uint64)
    if len(out):
        rows = words.rows
        again[1:] = (words.hash[1:] == words.hash[:-1]) & (rows[1:] == rows[:-1])
    return (out * np.uint64(8) + size) * np.uint64(2) + again


def ngram_buckets(column: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every n-gram of some texts, and its row."""
    words = words_of(column)
    rows = words.rows
    shapes = mixed(_shapes(words) + np.uint64(101))
    found, owners = [words.hash, shapes], [rows, rows]
    for values, salt in ((words.hash, 3), (shapes, 7)):
        if len(values) > 1:
            same = rows[1:] == rows[:-1]
            pair = mixed(values[:-1] * np.uint64(salt) + values[1:])[same]
            found.append(pair)
            owners.append(rows[1:][same])
    bucket = np.concatenate(found) % np.uint64(buckets)
    return bucket.astype(np.int64), np.concatenate(owners)


def _counter(good: np.ndarray, buckets: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = (np.zeros(buckets, dtype=np.int64) for _ in range(2))
        for part in chunks(batches, "text"):
            bucket, row = ngram_buckets(part.column("text"), buckets)
            ids = part.column("doc_id").fill_null(-(1 << 62)).to_numpy(zero_copy_only=False)
            raw += np.bincount(bucket, minlength=buckets)
            chosen = np.isin(ids, good)
            if chosen.any():
                target += np.bincount(bucket[chosen[row]], minlength=buckets)
        seen = np.flatnonzero(raw)
        yield pa.RecordBatch.from_pydict(
            {"bucket": seen.astype(np.int64), "raw": raw[seen], "target": target[seen]}
        )

    return count


def _weigher(ratio, buckets: int, text_col: str, kept: list[str]):
    """The columns ``kept``, then the number of n-grams and the log weight."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ratio.value
        for part in chunks(batches, text_col):
            bucket, row = ngram_buckets(part.column(text_col), buckets)
            n = np.bincount(row, minlength=part.num_rows).astype(np.int64)
            # Rounded so that the order of summing cannot show.
            weight = np.bincount(row, weights=table[bucket], minlength=part.num_rows)
            weight = np.round(weight.astype(np.float64), 6)
            columns = [part.column(c) for c in kept] + [pa.array(n), pa.array(weight)]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "_n_grams", "_log_weight"])

    return weigh


def labelled_sample(labels: DataFrame, id_col: str, label_col: str, rows: int) -> dict[int, list]:
    """Ids by label (0 and 1) of at most ``rows`` labelled rows, picked by a hash of the id."""
    picked = (
        labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).cast("long").alias("id"))
        .agg(F.min(F.col(label_col).cast("int")).alias("label"))
        .orderBy(F.xxhash64("id", F.lit(_SEED)), "id")
        .limit(rows)
        .collect()
    )
    return {k: np.array(sorted(r["id"] for r in picked if r["label"] == k), np.int64) for k in (0, 1)}


def kth_largest(df: DataFrame, col: str, k: int, bins: int = 4096) -> float:
    """The k-th largest value (the least one if there are fewer), by counting ever finer bins.

    At most ``bins`` rows reach the driver at once.
    """
    low, high, n = df.agg(F.min(col), F.max(col), F.count(col)).first()
    if k >= n:
        return low
    above = 0
    while low < high:
        width = (high - low) / bins
        # Bins narrower than the spacing of numbers: each value is a bin.
        fine = width == 0 or low + width == low or high - width == high
        place = F.col(col) if fine else F.least(F.floor((F.col(col) - low) / width), F.lit(bins - 1))
        inside = df.where(F.col(col).between(low, high)).groupBy(place.alias("bin"))
        found = inside.agg(F.count(F.lit(1)).alias("n"), F.min(col).alias("lo"), F.max(col).alias("hi"))
        for row in sorted(found.collect(), key=lambda r: -r["hi"]):
            if above + row["n"] >= k:
                low, high = row["lo"], row["hi"]
                break
            above += row["n"]
    return low


def quality_cut(weights_good: np.ndarray, weights_bad: np.ndarray) -> float:
    """The log weight that parts good from bad best (share of good kept less share of bad kept)."""
    if not len(weights_bad) or not len(weights_good):
        return -np.inf
    values = np.concatenate([weights_good, weights_bad])
    sign = np.concatenate([np.full(len(weights_good), 1 / len(weights_good)), np.full(len(weights_bad), -1 / len(weights_bad))])
    order = np.argsort(-values, kind="stable")
    values, gain = values[order], np.cumsum(sign[order])
    ends = np.append(values[1:] != values[:-1], True)
    best = np.flatnonzero(ends & (gain >= gain[ends].max() - 1e-12))[-1]
    return float((values[best] + values[best + 1]) / 2) if best + 1 < len(values) else float(values[best])


def _fitted(texts: DataFrame, good: np.ndarray, buckets: int):
    """Broadcast log ratio of the two models per bucket; all 0 without a good row.

    Both models are smoothed with ``_PRIOR`` counts per bucket, at the target's scale: an n-gram that is rare in
    the raw text, and so may be missing in the target by chance, says little.
    """
    counts = (
        texts.mapInArrow(_counter(good, buckets), "bucket long, raw long, target long")
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
        .toArrow()  # one row per bucket
    )
    raw, target = (np.zeros(buckets) for _ in range(2))
    where = counts.column("bucket").to_numpy()
    raw[where] = counts.column("raw").to_numpy()
    target[where] = counts.column("target").to_numpy()
    raw *= target.sum() / max(raw.sum(), 1)
    ratio = np.log(target + _PRIOR) - np.log(raw + _PRIOR)
    return texts.sparkSession.sparkContext.broadcast(ratio if len(good) else np.zeros(buckets))


def _weighed(docs: DataFrame, ratio, buckets: int, id_col: str, text_col: str, seed: int) -> DataFrame:
    """``docs`` with _n_grams, _log_weight and _key (log weight plus Gumbel noise), where they lie."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    weigh = _weigher(ratio, buckets, text_col, docs.columns)
    noise = F.xxhash64(F.lit(seed), F.col(id_col).cast("long"), "_n_grams", "_log_weight")
    unit = (F.shiftrightunsigned(noise, 11).cast("double") + 0.5) / float(1 << 53)
    return docs.mapInArrow(weigh, f"{fields}, _n_grams long, _log_weight double").withColumn(
        "_key", F.col("_log_weight") - F.log(-F.log(unit))
    )


def _scored(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str,
    text_col: str,
    label_col: str,
    keep: int | None,
    buckets: int,
    labelled_rows: int,
    seed: int,
):
    """The model, all rows with their weights, and the least key that is kept."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sample = labelled_sample(labels, id_col, label_col, labelled_rows)
    ratio = _fitted(texts, sample[1], buckets)
    weighed = staged(_weighed(texts, ratio, buckets, "doc_id", "text", seed).drop("text"))
    alive = weighed.where("_n_grams > 0")
    if keep is None:
        cut = _learnt_cut(alive, sample)
        keep = alive.where(F.col("_log_weight") >= cut).count()
    least = kth_largest(alive, "_key", keep) if keep and alive.head(1) else np.inf
    return ratio, weighed, float(least)


def importance_resample(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    keep: int | None = None,
    buckets: int = BUCKETS,
    labelled_rows: int = LABELLED_ROWS,
    seed: int = 29,
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_grams, log_weight, gumbel_key and kept (among the k largest keys).

    The target model is counted over at most ``labelled_rows`` labelled rows (picked by a hash of the id), the
    raw model over all documents. ``keep`` is k; by default it is the number of documents with a log weight
    above the cut that parts the good from the bad labelled rows best. Documents without an n-gram (null,
    empty or blank text) are never kept. Without good labels all weights are 0, without bad ones there is no
    cut: then all documents with an n-gram are kept. Rows whose keys tie with the k-th are all kept, so
    repeated rows share their fate. Null ids are weighed like others. Other columns are not read.
    """
    _, weighed, least = _scored(
        docs, labels, id_col, text_col, label_col, keep, buckets, labelled_rows, seed
    )
    return weighed.select(
        "doc_id",
        F.col("_n_grams").alias("n_grams"),
        F.col("_log_weight").alias("log_weight"),
        F.col("_key").alias("gumbel_key"),
        ((F.col("_n_grams") > 0) & (F.col("_key") >= least)).alias("kept"),
    )


def select_documents(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    keep: int | None = None,
    buckets: int = BUCKETS,
    labelled_rows: int = LABELLED_ROWS,
    seed: int = 29,
) -> DataFrame:
    """The rows of ``docs`` that ``importance_resample`` keeps, with all their columns, whatever their names.

    Rows are weighed again where they lie: no text is shuffled.
    """
    own = ("_n_grams", "_log_weight", "_key")
    docs, now, back = shield(docs, *own)
    id_col, text_col = now[id_col], now[text_col]
    ratio, _, least = _scored(
        docs, labels, id_col, text_col, label_col, keep, buckets, labelled_rows, seed
    )
    again = _weighed(docs, ratio, buckets, id_col, text_col, seed)
    kept = (F.col("_n_grams") > 0) & (F.col("_key") >= least)
    return back(again.where(kept).drop(*own))


def _learnt_cut(weighed: DataFrame, sample: dict[int, np.ndarray]) -> float:
    """The cut between the labelled rows' log weights; the labelled rows are bounded by the sample."""
    spark = weighed.sparkSession
    ids = [(int(i), k) for k in (0, 1) for i in sample[k]]
    if not ids:
        return -np.inf
    known = F.broadcast(spark.createDataFrame(ids, "doc_id long, label int"))
    one = weighed.join(known, "doc_id").groupBy("doc_id").agg(F.min("label").alias("label"), F.min("_log_weight").alias("w"))
    rows = one.collect()
    good, bad = (np.array([r["w"] for r in rows if r["label"] == k]) for k in (1, 0))
    return quality_cut(good, bad)
