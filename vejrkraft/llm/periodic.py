"""Periodic runs of words: Lyndon arrays by Baier's grouping, roots extended into runs.

A run is a longest stretch of words with period q that holds q several times. Its Lyndon root is the longest Lyndon word
at some place of the stretch, under an order of the words or under the reversed one (the runs theorem of Bannai et al.).
Phase one of Baier's suffix sorter refines groups of suffixes by their contexts, and the context a suffix has when its
group's turn comes is that longest Lyndon word. So two passes of the grouping list all roots; how far a root's
repetition reaches is asked by longest common extensions, and every answer is compared word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vejrkraft.llm.words import Words, _powers, chunks, mixed, runs_of, words_of

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def lyndon_array(ranks: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word at each place of a sequence of ranks (a prefix is less than what it begins).

    The sequence is a list of factors, at first one per place; equal factors form a group. The highest group is taken
    in turn: k neighbouring members end the factor before them, whose group is split by k, more copies higher.
    The members leave the list, and the length they have is their answer. Each place leaves once, so the work is linear
    but for the sorting of ranks.
    """
    n = len(ranks)
    letters, first = np.unique(ranks, return_inverse=True)
    group = first.tolist()
    top = len(letters) - 1
    by_letter = np.argsort(first, kind="stable")
    cuts = np.searchsorted(first[by_letter], np.arange(top + 2)).tolist()
    places = by_letter.tolist()
    members = [places[cuts[g] : cuts[g + 1]] for g in range(top + 1)]
    lengths = [1] * (top + 1)
    below = list(range(-1, top))
    above = [*range(1, top + 1), -1]
    before = list(range(-1, n - 1))
    after = list(range(1, n + 1))
    before.append(n - 1)  # of the end of the list
    out = [0] * n
    g = top
    while g >= 0:
        length = lengths[g]
        tails: dict[tuple[int, int], list[int]] = {}
        at, copies, follower = -1, 0, -1
        for s in members[g]:
            if group[s] != g:
                continue
            out[s] = length
            if s == follower:
                copies += 1
                follower = after[s]
                continue
            if copies:
                before[follower] = at
                if at >= 0:
                    after[at] = follower
                    tails.setdefault((group[at], copies), []).append(at)
            at, copies, follower = before[s], 1, after[s]
        if copies:
            before[follower] = at
            if at >= 0:
                after[at] = follower
                tails.setdefault((group[at], copies), []).append(at)
        members[g] = ()
        low = below[g]
        if low >= 0:
            above[low] = -1
        # New groups stand right above the one they come from, the most copies on top.
        for old, copies in sorted(tails, reverse=True):
            moved = tails[old, copies]
            new, higher = len(members), above[old]
            members.append(moved)
            lengths.append(lengths[old] + copies * length)
            below.append(old)
            above.append(higher)
            above[old] = new
            if higher >= 0:
                below[higher] = new
            else:
                low = new
            for s in moved:
                group[s] = new
        g = low
    return np.array(out, dtype=np.int64)


class Extensions:
    """Longest common extensions in a sequence, by prefix sums of word codes and binary search."""

    def __init__(self, ids: np.ndarray) -> None:
        up, self.down = _powers(len(ids) + 1)
        codes = mixed(ids.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * up[:-1], dtype=np.uint64)])

    def _same(self, x: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
        of = lambda at: (self.sums[at + n] - self.sums[at]) * self.down[at]
        return of(x) == of(y)

    def forward(self, x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words from x on equal those from y on, ``most`` at most."""
        return self._longest(most, lambda n, i: self._same(x[i], y[i], n))

    def backward(self, x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words before x equal those before y."""
        return self._longest(most, lambda n, i: self._same(x[i] - n, y[i] - n, n))

    @staticmethod
    def _longest(most: np.ndarray, holds) -> np.ndarray:
        low, high = np.zeros(len(most), np.int64), most.copy()
        live = np.flatnonzero(low < high)
        while len(live):
            middle = (low[live] + high[live] + 1) // 2
            yes = holds(middle, live)
            low[live[yes]] = middle[yes]
            high[live[~yes]] = middle[~yes] - 1
            live = live[low[live] < high[live]]
        return low


def _scanned(ids: np.ndarray, low: int, high: int, at: int, period: int) -> tuple[int, int]:
    """Start and end of the stretch around ``at`` that keeps ``period``, word by word."""
    begin, end = at, at + period
    while end < high and ids[end] == ids[end - period]:
        end += 1
    while begin > low and ids[begin - 1] == ids[begin - 1 + period]:
        begin -= 1
    return begin, end


def runs_in(
    ids: np.ndarray, segments: list[tuple[int, int]], least: int, exponent: int
) -> np.ndarray:
    """Rows (start, length, period) of the runs within each segment of ``ids``: ``least`` words and ``exponent`` (2 or
    more) periods at least, by start, then period."""
    found = []
    for low, high in segments:
        own = ids[low:high]
        n = high - low
        for ranks in (own, -own):
            lyndon = lyndon_array(ranks)
            # A run of e periods holds e - 1 whole roots in a row, and each is the longest Lyndon word at its place.
            at = np.arange(n)
            for k in range(1, exponent - 1):
                step = at + k * lyndon[at]
                at, step = at[step < n], step[step < n]
                at = at[lyndon[step] == lyndon[at]]
            found.append(np.stack([low + at, lyndon[at], np.full(len(at), low), np.full(len(at), high)], axis=1))
    none = np.zeros((0, 3), dtype=np.int64)
    if not found:
        return none
    at, period, low, high = np.concatenate(found).T
    if not len(at):
        return none
    common = Extensions(ids)
    end = at + period + common.forward(at, at + period, high - at - period)
    begin = at - common.backward(at, at + period, at - low)
    long = end - begin >= np.maximum(least, exponent * period)
    at, period, low, high, begin, end = (v[long] for v in (at, period, low, high, begin, end))
    rows, which = np.unique(np.stack([begin, end, period], axis=1), axis=0, return_inverse=True)
    # Hashes proposed the ends; words decide.
    wrong = [not np.array_equal(ids[b : e - q], ids[b + q : e]) for b, e, q in rows.tolist()]
    for i in np.flatnonzero(np.array(wrong)[which.reshape(-1)]).tolist() if any(wrong) else ():
        begin[i], end[i] = _scanned(ids, low[i], high[i], at[i], period[i])
    long = end - begin >= np.maximum(least, exponent * period)
    return np.unique(np.stack([begin, period, end - begin], axis=1)[long], axis=0)[:, [0, 2, 1]]


def _frequent(hashes: np.ndarray, rows: np.ndarray, least: int, exponent: int) -> list[tuple[int, int]]:
    """Segments that may hold a run. Each word of a run stands in it ``exponent`` times, so a run never holds a word that
    is rarer in its segment: segments are cut at such words until none is left."""
    kept, segment = np.arange(len(hashes)), rows
    while len(kept):
        key = mixed(hashes[kept] + segment.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        _, which, count = np.unique(key, return_inverse=True, return_counts=True)
        often = count[which] >= exponent
        some, of = kept[often], segment[often]
        if not len(some):
            return []
        cut = np.concatenate([[True], (np.diff(some) != 1) | (np.diff(of) != 0)])
        number = np.cumsum(cut) - 1
        long = np.bincount(number)[number] >= least
        done = long.all() and len(some) == len(kept)
        kept, segment = some[long], number[long]
        if done:
            break
    cuts = runs_of(segment)
    return [(int(kept[a]), int(kept[b - 1]) + 1) for a, b in zip(cuts[:-1], cuts[1:])]


def _ids(words: Words, segments: list[tuple[int, int]]) -> np.ndarray:
    """A number per word in the segments: equal words, equal numbers (others: -1)."""
    ids = np.full(len(words.hash), -1, dtype=np.int64)
    data, seen = words.data.tobytes(), {}
    for low, high in segments:
        places = zip(words.start[low:high].tolist(), words.end[low:high].tolist())
        ids[low:high] = [seen.setdefault(data[a:b], len(seen)) for a, b in places]
    return ids


def text_runs(column: pa.Array, least: int, exponent: int) -> tuple[Words, np.ndarray]:
    """Words of a chunk of texts, and the runs in them: rows (start, length, period), start counted in the chunk."""
    words = words_of(column, lower=False)
    segments = _frequent(words.hash, words.rows, least, exponent)
    return words, runs_in(_ids(words, segments), segments, least, exponent)


def _collapsed(words: Words, row: int, dropped: np.ndarray | None) -> str:
    low, high = words.first[row], words.first[row + 1]
    text = words.data[words.byte0[row] : words.byte0[row + 1]].tobytes().split()
    if dropped is not None:
        text = [w for w, gone in zip(text, dropped[low:high].tolist()) if not gone]
    return b" ".join(text).decode()


def _found(batches: Iterator[pa.RecordBatch], least: int, exponent: int) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "text"):
        words, runs = text_runs(batch.column("text"), least, exponent)
        n = batch.num_rows
        row = np.searchsorted(words.first, runs[:, 0], side="right") - 1
        edges = np.zeros(len(words.hash) + 1, dtype=np.int64)
        np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
        np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
        dropped = np.cumsum(edges[:-1]) > 0
        has = np.zeros(n, dtype=bool)
        has[row] = True
        structs = pa.StructArray.from_arrays(
            [pa.array(runs[:, 0] - words.first[row]), pa.array(runs[:, 1]), pa.array(runs[:, 2])], fields=list(_RUN)
        )
        offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(words.counts.astype(np.int64)),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs),
                pa.array([_collapsed(words, i, dropped if has[i] else None) for i in range(n)], pa.string()),
            ],
            names=["doc_id", "n_words", "runs", "collapsed"],
        )


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 6, exponent: int = 4
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, runs (by start, then period) and collapsed, the text with each run's first period only.

    A run is a stretch of consecutive words whose smallest period is q, of ``least`` words and ``exponent`` (2 or more) times q at
    least, that no neighbouring word extends with that period. Words stand between the characters 9 to 13 and 32; the collapsed text
    joins the kept ones by one space. Texts that are null or without words have no runs and collapse to the empty text; a null id
    stays null; repeated rows are rows of their own; other columns of ``docs`` are not read; an empty table gives no rows.
    Rows stay in their task: nothing is shuffled or collected, and memory follows one chunk of text (1 MB, or one longer text).
    """
    if exponent < 2:
        raise ValueError("a run holds its period twice at least")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, runs {RUNS}, collapsed string"
    return texts.mapInArrow(lambda batches: _found(batches, least, exponent), schema)
