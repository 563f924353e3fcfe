"""Toxicity: a counterfactually regularised linear classifier.

A logistic model over the distinct words of a text and their beginnings. For each labelled text that names a group, a copy
names another group instead; the loss adds the squared change of the score between the two, so that the name
of a group cannot carry the verdict. The model is fitted on a bounded sample, the scores are given to all texts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vejrkraft.llm.words import PLAIN, Words, _LOWER, _powers, _BYTE_CODES, chunks, mixed, words_of

# Names of groups that are swapped with each other, a list per language.
IDENTITY_TERMS: Sequence[Sequence[str]] = (
    ("women", "men", "girls", "boys", "muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("woman", "man", "girl", "boy", "muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "african", "european", "arab", "gay", "straight", "lesbian"),
    ("immigrants", "refugees", "foreigners", "natives", "disabled", "elderly", "transgender", "bisexual"),
    ("frauen", "männer", "muslime", "christen", "juden", "ausländer", "flüchtlinge", "behinderte"),
    ("femmes", "hommes", "musulmans", "chrétiens", "juifs", "étrangers", "réfugiés", "handicapés"),
    ("mujeres", "hombres", "musulmanes", "cristianos", "judíos", "extranjeros", "refugiados"),
)
ROWS_PER_LABEL = 4000
FOLDS = 5
_STEM = 4
_STEM_SALT = np.uint64(0x5851F42D4C957F2D)


def _features(words: Words) -> np.ndarray:
    """Hash of every word, and of its first bytes, in two rows."""
    stem = np.zeros(0, dtype=np.uint64)
    if len(words.hash):
        up, down = _powers(len(words.data) + 1)
        codes = _BYTE_CODES[_LOWER[words.data]] * up[:-1]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes, dtype=np.uint64)])
        end = np.minimum(words.end, words.start + _STEM)
        stem = mixed((sums[end] - sums[words.start]) * down[words.start] + _STEM_SALT)
    return np.stack([words.hash, stem])


def _swaps(terms: Sequence[Sequence[str]]) -> dict[int, tuple[int, int, int]]:
    """By the word hash of a term: hashes of the term that replaces it and of both stems."""
    out = {}
    for group in terms:
        words = words_of(pa.array(group), PLAIN)
        word, stem = _features(words)
        for i in range(len(group)):
            j = (i + 1) % len(group)
            out[int(word[i])] = (int(word[j]), int(stem[i]), int(stem[j]))
    return out


def _learner(label_of: dict[int, int], terms: Sequence[Sequence[str]]):
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = np.array(sorted(label_of), dtype=np.int64)
        swaps = _swaps(terms)
        named = np.array(sorted(swaps), dtype=np.uint64)
        for part in chunks(_only(batches, ids), "text"):
            words = words_of(part.column("text"), PLAIN)
            both = _features(words)
            out = {"doc_id": part.column("doc_id"), "label": [], "features": [], "swapped": []}
            for i, doc in enumerate(part.column("doc_id").to_pylist()):
                own = both[:, words.first[i] : words.first[i + 1]]
                seen = np.unique(own)
                other = None
                hit = np.isin(own[0], named)
                if hit.any():
                    changed = own.copy()
                    for at in np.flatnonzero(hit):
                        changed[0, at], _, changed[1, at] = swaps[int(own[0, at])]
                    other = np.unique(changed).astype(np.int64)
                out["label"].append(label_of[doc])
                out["features"].append(seen.astype(np.int64))
                out["swapped"].append(other)
            yield pa.RecordBatch.from_pydict(out, schema=_LEARNT)

    return learn


_LEARNT = pa.schema(
    [("doc_id", pa.int64()), ("label", pa.int32()), ("features", pa.list_(pa.int64())), ("swapped", pa.list_(pa.int64()))]
)


def _only(batches: Iterator[pa.RecordBatch], ids: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        own = batch.column("doc_id").fill_null(-(1 << 62)).to_numpy(zero_copy_only=False)
        yield batch.filter(pa.array(np.isin(own, ids)))


class _Rows:
    """Feature places of some rows, one after the other; unknown features are left out."""

    def __init__(self, lists: list[np.ndarray], known: np.ndarray) -> None:
        sizes = np.array([len(x) for x in lists], dtype=np.int64)
        flat = np.concatenate(lists) if lists else np.zeros(0, np.uint64)
        place = np.minimum(np.searchsorted(known, flat), max(len(known) - 1, 0))
        real = known[place] == flat if len(known) else np.zeros(len(flat), bool)
        self.n = len(lists)
        self.row = np.repeat(np.arange(self.n), sizes)[real]
        self.place = place[real]
        self.value = 1 / np.sqrt(np.maximum(np.bincount(self.row, minlength=self.n), 1))[self.row]

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.place] * self.value, minlength=self.n)

    def back(self, g: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.place, weights=g[self.row] * self.value, minlength=size)


def fit(
    labels: np.ndarray,
    features: list[np.ndarray],
    swapped: list[np.ndarray | None],
    penalty: float = 4.0,
    ridge: float = 1e-4,
    steps: int = 150,
    least_rows: int = 3,
    most_features: int = 200_000,
) -> tuple[np.ndarray, np.ndarray, float]:
    """Feature hashes (sorted), their weights, and the bias.

    Minimises the mean logistic loss, both labels weighing the same, plus ``penalty`` times the mean squared change of
    the logit under the swap, plus ``ridge`` times the squared weights.
    """
    all_hashes, rows_with = np.unique(np.concatenate(features) if features else np.zeros(0, np.uint64), return_counts=True)
    common = np.flatnonzero(rows_with >= min(least_rows, max(1, len(features) // 4)))
    if len(common) > most_features:
        common = np.sort(common[np.argsort(-rows_with[common], kind="stable")[:most_features]])
    known = all_hashes[common]
    if not len(known) or len(set(labels.tolist())) < 2:
        share = labels.mean() if len(labels) else 0.0
        odds = np.clip(share, 1e-3, 1 - 1e-3)
        return known[:0], np.zeros(0), float(np.log(odds / (1 - odds)))
    x = _Rows(features, known)
    pairs = [i for i, s in enumerate(swapped) if s is not None]
    before, after = _Rows([features[i] for i in pairs], known), _Rows([swapped[i] for i in pairs], known)
    toxic = labels == 1
    weight = np.where(toxic, 0.5 / max(toxic.sum(), 1), 0.5 / max((~toxic).sum(), 1))
    # Start from the smoothed log ratio of each feature's frequency under the two labels.
    hit = np.bincount(x.place, weights=toxic[x.row], minlength=len(known)) + 0.5
    miss = np.bincount(x.place, weights=~toxic[x.row], minlength=len(known)) + 0.5
    scale = np.abs(np.log(hit / hit.sum()) - np.log(miss / miss.sum())) + 0.05
    w, bias = np.zeros(len(known)), 0.0
    m, v = np.zeros(len(known) + 1), np.zeros(len(known) + 1)
    for step in range(1, steps + 1):
        logit = x.times(w * scale) + bias
        slope = weight * (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - toxic)
        g = x.back(slope, len(known)) * scale
        if pairs:
            change = before.times(w * scale) - after.times(w * scale)
            each = 2 * penalty / len(pairs) * change
            g += (before.back(each, len(known)) - after.back(each, len(known))) * scale
        g = np.append(g + 2 * ridge * w, slope.sum())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        rate = 0.2 * (1 - step / (steps + 1)) + 0.01
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    return known, w * scale, float(bias)


def _scorer(model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, weights, bias = model.value
        for part in chunks(batches, "text"):
            words = words_of(part.column("text"), PLAIN)
            both = _features(words)
            lists = [np.unique(both[:, words.first[i] : words.first[i + 1]]) for i in range(part.num_rows)]
            logit = bias + (_Rows(lists, known).times(weights) if len(known) else np.zeros(len(lists)))
            score = np.round(1 / (1 + np.exp(-np.clip(logit, -30, 30))), 9)
            yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "score": score})

    return score


def fold_of(doc_id) -> F.Column:
    """crc32 of the id as text, modulo five: fold 0 is held out."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    terms: Sequence[Sequence[str]] = IDENTITY_TERMS,
    rows_per_label: int = ROWS_PER_LABEL,
    penalty: float = 4.0,
) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score (0 to 1) and predicted (1 from 0.5 on).

    The model is fitted on at most ``rows_per_label`` rows of each label, picked by a hash of the id among the labelled
    rows that are not held out; only texts enter a score. A null or empty text gets the score of a text without any known
    word. An id labelled twice counts with its larger label, a labelled id that stands on several rows teaches with each.
    Null ids are scored, not held out, and teach nothing. Without both labels all scores are the
    share of label 1. Repeated rows are scored each; other columns are not read.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    own = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & (fold_of(id_col) != 0))
    own = own.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(label_col).cast("int").alias("label"))
    label_of: dict[int, int] = {}
    for k in (0, 1):
        picked = own.where(F.col("label") == k).orderBy(F.xxhash64("id"), "id").limit(rows_per_label)
        label_of.update((r["id"], k) for r in picked.collect())
    schema = "doc_id long, label int, features array<bigint>, swapped array<bigint>"
    learnt = texts.mapInArrow(_learner(label_of, terms), schema)
    taught = learnt.orderBy("doc_id", "label").toArrow() if label_of else None
    lists = lambda c: [
        None if x is None else np.array(x, dtype=np.int64).astype(np.uint64) for x in _arrays(taught.column(c))
    ]
    if taught is None or not taught.num_rows:
        model = fit(np.zeros(0), [], [])
    else:
        model = fit(taught.column("label").to_numpy(), lists("features"), lists("swapped"), penalty)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    scored = texts.mapInArrow(_scorer(shared), "doc_id long, score double")
    return scored.select(
        "doc_id",
        F.coalesce(fold_of("doc_id") == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def _arrays(column: pa.ChunkedArray) -> Iterator[np.ndarray | None]:
    for chunk in column.chunks:
        for i in range(len(chunk)):
            yield chunk[i].values.to_numpy() if chunk[i].is_valid else None
