"""Substring deduplication by collinear chaining.

Seeds are the minimizers of the texts' word k-mers: any ``K + WINDOW - 1`` words that two texts share give them a common
seed. A seed's places are sorted; each is matched with the first one and with the one of the text before
it, so matches grow with the seeds and not with their pairs. Those two need not have the passage, so runs of as many words
as a passage has are matched as well: all texts with the same run do share a passage, and the first one stands for all.
Runs are made only around minimizers of longer k-mers that stand in several texts, of which every such run holds one. The matches of two texts are chained:
in order in both texts, with a cost for the words between them, through a Fenwick tree. A text of a large family has chains with
many others over the same words: only the best ones that cover its words are listed, and the outermost spans of the others. A text with such a span
that passages leave open is chained once more, for its chains over the open words. The chains' words are aligned, which finds where a passage begins
and ends and how much of it agrees; edits inside a passage are allowed.
"""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vejrkraft.llm.names import shield
from vejrkraft.llm.steps import Steps, among
from vejrkraft.llm.words import chunks, list_column, runs_of, shingles, words_of

K = 6
WINDOW = 10
MIN_WORDS = 50
PERCENT = 80
MIN_SEEDS = 3
LONG = 70  # percent of a passage's words in a long k-mer
GAP_COST = 0.2
MARGIN = 40
SOLID = 4  # words in a row that agree
LEFT_OUT = 10  # words of a chain that other chains or passages may leave out
STRANGE = 10  # words that do not agree, between two passages


def minimizers(hashes: np.ndarray, each: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and places (in the row) of the least hash of every ``window`` k-mers; of all if a row has fewer."""
    first = np.concatenate([[0], np.cumsum(each)])
    row = np.repeat(np.arange(len(each)), each)
    places = []
    if len(hashes) >= window:
        view = np.lib.stride_tricks.sliding_window_view(hashes, window)
        at = np.arange(len(view)) + view.argmin(axis=1)
        whole = row[: len(view)] == row[window - 1 :]
        places.append(at[whole])
    for i in np.flatnonzero((each > 0) & (each < window)):
        places.append([first[i] + hashes[first[i] : first[i + 1]].argmin()])
    chosen = np.unique(np.concatenate(places)).astype(np.int64) if places else np.zeros(0, np.int64)
    return row[chosen], chosen - first[row[chosen]]


def _seeds(k: int, window: int):
    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One text per hash in a task: copies have the same seeds."""
        done: set[int] = set()
        for part in chunks(batches, "text"):
            node = part.column("node").to_numpy()
            fresh = np.array([not (x in done or done.add(x)) for x in node.tolist()], bool)
            part, node = part.filter(pa.array(fresh)), node[fresh]
            hashes, each = shingles(words_of(part.column("text")), k, short=False)
            row, place = minimizers(hashes, each, window)
            yield _seed_rows(hashes, each, node, row, place)

    return seeds


def _seed_rows(hashes: np.ndarray, each: np.ndarray, node: np.ndarray, row: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    first = np.concatenate([[0], np.cumsum(each)])
    return pa.RecordBatch.from_pydict(
        {"seed": hashes[first[row] + place].astype(np.int64), "node": node[row], "place": place.astype(np.int32)}
    )


def _recurring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From seeds sorted by (seed, node): places of seeds that stand in several texts. The rows of a seed's first text wait
    for a second one."""
    waiting: list[np.ndarray] = []
    last, several = None, False
    for batch in batches:
        if not batch.num_rows:
            continue
        seed, node, place = (batch.column(c).to_numpy().astype(np.int64) for c in ("seed", "node", "place"))
        edges = runs_of(seed)
        size = np.diff(edges)
        keep = np.repeat(node[edges[:-1]] != node[edges[1:] - 1], size)
        if last is not None and seed[0] == last[0]:
            head = slice(0, edges[1])
            if several or node[edges[1] - 1] != last[1]:
                keep[head] = several = True
            else:
                waiting.append(np.stack([node[head], place[head]]))
            if several and waiting:
                yield _places(np.concatenate(waiting, axis=1))
                waiting = []
        else:
            waiting, several = [], False
        yield _places(np.stack([node[keep], place[keep]]))
        if last is None or seed[-1] != last[0] or len(edges) > 2:
            several = bool(keep[-1])
            tail = slice(edges[-2], len(seed))
            waiting = [] if several else [np.stack([node[tail], place[tail]])]
        last = (seed[-1], node[-1])


def _places(rows: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"node": rows[0], "place": rows[1].astype(np.int32)})


def _runs_around(n: int, k: int):
    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All runs of ``n`` words of a text that hold one of its k-mers at ``places``."""
        for part in chunks(batches, "text"):
            hashes, each = shingles(words_of(part.column("text")), n, short=False)
            rows, places = [], []
            for i, at in enumerate(part.column("places")):
                around = np.unique(at.values.to_numpy()[:, None] - np.arange(n - k + 1))
                around = around[(around >= 0) & (around < each[i])]
                rows.append(np.full(len(around), i))
                places.append(around)
            node = part.column("node").to_numpy()
            yield _seed_rows(hashes, each, node, np.concatenate(rows), np.concatenate(places))

    return runs


def _matcher(n: int, previous: bool):
    return lambda batches: _match(batches, n, previous)


def _match(batches: Iterator[pa.RecordBatch], n: int, previous: bool) -> Iterator[pa.RecordBatch]:
    """From seeds of ``n`` words sorted by (seed, node, place): each place with the seed's first one, and if asked with the
    last one of the node before. Streams: the first, the last and the one before are carried on."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        seed, node, place = (batch.column(c).to_numpy().astype(np.int64) for c in ("seed", "node", "place"))
        if held:
            seed, node, place = (np.append(held[c], x) for c, x in (("seed", seed), ("node", node), ("place", place)))
        same = np.zeros(len(seed), bool)
        same[1:] = seed[1:] == seed[:-1]
        run = ~same
        run[1:] |= node[1:] != node[:-1]
        index = np.arange(len(seed))
        lead = np.maximum.accumulate(np.where(same, 0, index))
        begin = np.maximum.accumulate(np.where(run, index, 0))
        first_node, first_place = node[lead], place[lead]
        before = np.maximum(begin - 1, 0)
        has_before = same[begin]
        before_node, before_place = node[before], place[before]
        if held:
            first_node[lead == 0], first_place[lead == 0] = held["first"]
            mine = begin == 0
            has_before = np.where(mine, held["before"] is not None, has_before)
            before_node[mine], before_place[mine] = held["before"] or (0, 0)
        copied = np.zeros(len(seed), bool)
        copied[1:] = ~run[1:] & (place[1:] == place[:-1])
        copied[0] = bool(held)
        to_first = (node != first_node) & ~copied
        to_before = has_before & (before_node != first_node) & ~copied if previous else np.zeros(len(seed), bool)
        yield pa.RecordBatch.from_pydict(
            {
                "b": np.concatenate([node[to_first], node[to_before]]),
                "a": np.concatenate([first_node[to_first], before_node[to_before]]),
                "at_b": np.concatenate([place[to_first], place[to_before]]).astype(np.int32),
                "at_a": np.concatenate([first_place[to_first], before_place[to_before]]).astype(np.int32),
                "n": np.full(to_first.sum() + to_before.sum(), n, np.int32),
            }
        )
        held = {
            "seed": seed[-1],
            "node": node[-1],
            "place": place[-1],
            "first": (first_node[-1], first_place[-1]),
            "before": (before_node[-1], before_place[-1]) if has_before[-1] else None,
        }


class _Fenwick:
    """Largest (value, index) among the places up to one."""

    def __init__(self, size: int) -> None:
        self.best = [(-np.inf, -1)] * (size + 1)

    def put(self, place: int, item: tuple[float, int]) -> None:
        place += 1
        while place < len(self.best):
            if item > self.best[place]:
                self.best[place] = item
            place += place & -place

    def get(self, place: int) -> tuple[float, int]:
        found = (-np.inf, -1)
        place += 1
        while place > 0:
            if self.best[place] > found:
                found = self.best[place]
            place -= place & -place
        return found


def anchors(at_b: np.ndarray, at_a: np.ndarray, n: np.ndarray, reach: int) -> np.ndarray:
    """Matches (of ``n`` words) on one diagonal, at most ``reach`` apart, as one run: rows (begin in b, begin in a, length)."""
    order = np.lexsort((at_b, at_a - at_b))
    b, a, n = at_b[order], at_a[order], n[order]
    new = np.ones(len(b), bool)
    new[1:] = ((a - b)[1:] != (a - b)[:-1]) | (b[1:] - b[:-1] > reach)
    begin = np.flatnonzero(new)
    found = np.stack([b[begin], a[begin], np.maximum.reduceat(b + n, begin) - b[begin]], axis=1)
    return found[np.lexsort((found[:, 1], found[:, 0]))]


def chain(runs: np.ndarray, cost: float = GAP_COST) -> list[np.ndarray]:
    """Chains of runs that follow each other in both texts, best first; a run is in one chain.

    A chain scores the words of its runs less ``cost`` per word that either text has between them.
    """
    n = len(runs)
    if n == 1:
        return [runs]
    end_b, end_a = runs[:, 0] + runs[:, 2], runs[:, 1] + runs[:, 2]
    grid = np.unique(end_a)
    tree = _Fenwick(len(grid))
    rank_of_end = np.searchsorted(grid, end_a)
    rank_of_begin = np.searchsorted(grid, runs[:, 1], side="right") - 1
    score, before = runs[:, 2].astype(float), np.full(n, -1)
    waiting = np.argsort(end_b, kind="stable")
    w = 0
    for i in range(n):
        while w < n and end_b[waiting[w]] <= runs[i, 0]:
            j = waiting[w]
            tree.put(int(rank_of_end[j]), (score[j] + cost * (end_b[j] + end_a[j]), int(j)))
            w += 1
        if rank_of_begin[i] >= 0:
            value, j = tree.get(int(rank_of_begin[i]))
            gain = value - cost * (runs[i, 0] + runs[i, 1])
            if gain > 0:
                score[i] += gain
                before[i] = j
    used, out = np.zeros(n, bool), []
    for i in np.argsort(-score, kind="stable"):
        path = []
        while i >= 0 and not used[i]:
            used[i] = True
            path.append(i)
            i = before[i]
        if path:
            out.append(runs[path[::-1]])
    return out


def _chains(k: int, min_words: int, reach: int, spare: bool):
    def chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by (b, a); a text's matches are bounded by its length. Lists the chains that cover a text's words; if asked, those to
        spare that have ``LEFT_OUT`` words outside the known spans instead. A known span is a row (begin at_b, end at_a) with n = 0."""
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(c).to_numpy() for c in ("b", "a", "at_b", "at_a", "n")]
            if rest is not None:
                cols = [np.concatenate([x, y]) for x, y in zip(rest, cols)]
            change = np.flatnonzero(cols[0][1:] != cols[0][:-1]) + 1
            cut = change[-1] if len(change) else 0
            rest = [x[cut:] for x in cols]
            if cut:
                yield _pairs([x[:cut] for x in cols], k, min_words, reach, spare)
        if rest is not None:
            yield _pairs(rest, k, min_words, reach, spare)

    return chains


def _pairs(cols, k: int, min_words: int, reach: int, spare: bool) -> pa.RecordBatch:
    """Chains of all pairs of some texts b, whose rows are whole: of each b those that cover its words, or those to spare that are open."""
    known: dict[int, list[tuple[int, int]]] = {}
    for text, begin, end in zip(*(x[cols[4] == 0].tolist() for x in cols[:1] + cols[2:4])):
        known.setdefault(text, []).append((begin, end))
    found = _pair_chains([x[cols[4] > 0] for x in cols], k, min_words, reach)
    listed: list[int] = []
    spans: list[list[dict]] = []
    cuts = runs_of(np.array([x[0] for x in found], dtype=np.int64)) if found else []
    for low, high in zip(cuts[:-1], cuts[1:]):
        chains = [runs for _, _, runs in found[low:high]]
        over = covering(chains)
        if spare:
            chosen = is_open(chains, known.get(found[low][0], []))
            listed += [low + i for i in range(high - low) if over[i] and chosen[i]]
            continue
        chosen = [low + i for i in range(high - low) if not over[i]]
        # With all chains shorter than LEFT_OUT, none is listed.
        listed += chosen
        spans += [[] for _ in chosen]
        if chosen:
            spans[-1] = outermost([runs for runs, x in zip(chains, over) if x])
    out = {"b": [found[i][0] for i in listed], "a": [found[i][1] for i in listed]}
    for name, j in (("run_b", 0), ("run_a", 1), ("run_n", 2)):
        out[name] = [found[i][2][:, j].tolist() for i in listed]
    out["spares"] = [[]] * len(listed) if spare else spans
    return pa.RecordBatch.from_pydict(out, schema=_CHAINS)


def _pair_chains(cols, k: int, min_words: int, reach: int) -> list[tuple[int, int, np.ndarray]]:
    """Chains (b, a, runs) of all pairs of some texts."""
    b, a, at_b, at_a, n = cols
    if not len(b):
        return []
    change = np.flatnonzero((b[1:] != b[:-1]) | (a[1:] != a[:-1])) + 1
    edges = np.concatenate([[0], change, [len(b)]])
    sizes = np.diff(edges)
    whole = np.maximum.reduceat(n, edges[:-1]) >= min_words
    found: list[tuple[int, int, np.ndarray]] = []
    for i in np.flatnonzero((sizes >= MIN_SEEDS) | whole):
        low, high = edges[i], edges[i + 1]
        # A long passage has far more seeds; this only skips pairs that share a phrase.
        if not whole[i] and at_b[low:high].max() - at_b[low:high].min() + k + 2 * (WINDOW + k) < min_words:
            continue
        for runs in chain(anchors(*(x[low:high].astype(np.int64) for x in (at_b, at_a, n)), reach)):
            end = runs[-1]
            if end[0] + end[2] - runs[0, 0] + 2 * (WINDOW + k) >= min_words:
                found.append((int(b[low]), int(a[low]), runs))
    return found


def _spans(chains: list[np.ndarray]) -> list[tuple[int, int]]:
    return [(int(r[0, 0]), int(r[-1, 0] + r[-1, 2])) for r in chains]


def covering(chains: list[np.ndarray]) -> list[bool]:
    """Which chains of a text are to spare: their words lie in chains with more seeds, but for ``LEFT_OUT``."""
    spans = _spans(chains)
    covered = np.zeros(max(end for _, end in spans), dtype=bool)
    spare = [False] * len(chains)
    for i in sorted(range(len(chains)), key=lambda i: -int(chains[i][:, 2].sum())):
        begin, end = spans[i]
        spare[i] = end - begin - int(covered[begin:end].sum()) < LEFT_OUT
        if not spare[i]:
            covered[begin:end] = True
    return spare


def outermost(chains: list[np.ndarray]) -> list[dict[str, int]]:
    """Spans of a text's chains that lie in no other one: if any chain has so many words outside some spans, one of these has."""
    out, last = [], -1
    for begin, end in sorted(_spans(chains), key=lambda x: (x[0], -x[1])):
        if end > last:
            out.append({"begin": begin, "end": end})
            last = end
    return out


def is_open(chains: list[np.ndarray], known: list[tuple[int, int]]) -> list[bool]:
    """Which chains of a text have ``LEFT_OUT`` words or more outside the known spans."""
    spans = _spans(chains)
    still = np.ones(max(end for _, end in spans), dtype=bool)
    for begin, end in known:
        still[begin:end] = False
    return [int(still[begin:end].sum()) >= LEFT_OUT for begin, end in spans]


def _merged(spans: Column) -> Column:
    """Spans (start, end) as disjoint ones in order."""
    last = lambda acc: F.element_at(acc, -1)
    joined = lambda acc, x: F.struct(
        last(acc)["start"].alias("start"), F.greatest(last(acc)["end"], x["end"]).alias("end")
    )
    return F.aggregate(
        F.array_sort(spans),
        F.array().cast("array<struct<start: int, end: int>>"),
        lambda acc, x: F.when((F.size(acc) == 0) | (F.get(acc, F.size(acc) - 1)["end"] < x["start"]), F.concat(acc, F.array(x))).otherwise(
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(joined(acc, x)))
        ),
    )


def _open_words(begin: Column, end: Column, spans: Column) -> Column:
    """Words from ``begin`` to ``end`` that lie in none of the disjoint spans (null: there are none)."""
    shared = lambda x: F.greatest(F.lit(0), F.least(end, x["end"]) - F.greatest(begin, x["start"]))
    return end - begin - F.coalesce(F.aggregate(spans, F.lit(0), lambda acc, x: acc + shared(x)), F.lit(0))


_CHAINS = pa.schema(
    [("b", pa.int64()), ("a", pa.int64())]
    + [(c, pa.list_(pa.int32())) for c in ("run_b", "run_a", "run_n")]
    + [("spares", pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())])))]
)
_CHAIN_SCHEMA = "b long, a long, run_b array<int>, run_a array<int>, run_n array<int>, spares array<struct<begin: int, end: int>>"


def _regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word hashes (32 bits: they only tell two aligned words apart) of the asked parts of texts; a text's questions come together,
    so it is split once for them."""
    for batch in batches:
        asked = batch.column("asked")
        for i in range(batch.num_rows):
            words = (words_of(batch.column("text").slice(i, 1)).hash >> np.uint64(32)).astype(np.uint32).view(np.int32)
            own = pa.RecordBatch.from_struct_array(asked[i].values)
            lows, highs = own.column("low").to_pylist(), own.column("high").to_pylist()
            for at in range(0, own.num_rows, _REGIONS_AT_ONCE):
                some = slice(at, at + _REGIONS_AT_ONCE)
                found = [words[low:high] for low, high in zip(lows[some], highs[some])]
                yield pa.RecordBatch.from_pydict(
                    {c: own.column(c).slice(at, _REGIONS_AT_ONCE) for c in ("chain", "side", "low")}
                    | {"words": list_column(found, pa.int32())}
                )


_REGIONS_AT_ONCE = 1024
_DEALS = 32  # rows that the questions about one text are dealt to


def _reach(equal: np.ndarray) -> int:
    """How far an end is extended: the best sum of 1 per equal and -2 per other word."""
    if not len(equal):
        return 0
    gain = np.cumsum(np.where(equal, 1, -2))
    best = int(gain.argmax())
    return best + 1 if gain[best] > 0 else 0


def _agreeing(b: np.ndarray, a: np.ndarray) -> int:
    """Words of the gaps ``b`` and ``a`` that an alignment matches."""
    if not len(b) or not len(a):
        return 0
    if len(b) == len(a):
        return int((b == a).sum())
    matcher = SequenceMatcher(None, b.tolist(), a.tolist(), autojunk=False)
    return sum(block.size for block in matcher.get_matching_blocks())


def pieces(b: np.ndarray, a: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """The parts of runs in which ``SOLID`` words or more in a row agree; a run without any stays as it is."""
    out = []
    for x, y, size in runs:
        same = np.concatenate([[False], b[x : x + size] == a[y : y + size], [False]])
        turns = np.flatnonzero(same[1:] != same[:-1]).reshape(-1, 2)
        turns = turns[turns[:, 1] - turns[:, 0] >= SOLID]
        if not len(turns):
            turns = np.array([[0, size]])
        out.append(np.stack([x + turns[:, 0], y + turns[:, 0], turns[:, 1] - turns[:, 0]], axis=1))
    return np.concatenate(out)


def align(b: np.ndarray, a: np.ndarray, runs: np.ndarray, min_words: int, percent: int) -> list[tuple]:
    """Passages (begin and end in b, in a, matched words) along a chain; places count from the arrays' begin."""
    room = (0, 0, len(b), len(a))
    return _align(b, a, pieces(b, a, runs), min_words, percent, room, 0) if len(runs) else []


def _align(b: np.ndarray, a: np.ndarray, runs: np.ndarray, min_words: int, percent: int, room: tuple, depth: int) -> list[tuple]:
    """``room``: where the ends may be extended to (begin in b, in a, end in b, in a)."""
    begin_b, begin_a = int(runs[0, 0]), int(runs[0, 1])
    end_b, end_a = int(runs[-1, 0] + runs[-1, 2]), int(runs[-1, 1] + runs[-1, 2])
    n = max(0, min(begin_b - room[0], begin_a - room[1], MARGIN))
    back = _reach((b[begin_b - n : begin_b] == a[begin_a - n : begin_a])[::-1])
    n = max(0, min(room[2] - end_b, room[3] - end_a, MARGIN))
    ahead = _reach(b[end_b : end_b + n] == a[end_a : end_a + n])
    first_b, first_a, last_b, last_a = begin_b - back, begin_a - back, end_b + ahead, end_a + ahead
    matched = int((b[first_b:begin_b] == a[first_a:begin_a]).sum() + (b[end_b:last_b] == a[end_a:last_a]).sum())
    gaps, strange = [], []
    for i, (x, y, size) in enumerate(runs):
        matched += int((b[x : x + size] == a[y : y + size]).sum())
        if i + 1 < len(runs):
            inner_b, inner_a = b[x + size : runs[i + 1, 0]], a[y + size : runs[i + 1, 1]]
            same = _agreeing(inner_b, inner_a)
            matched += same
            most = max(len(inner_b), len(inner_a))
            gaps.append(most - same)
            strange.append(most - same if most - same >= STRANGE and 2 * same < most else 0)
    span = max(last_b - first_b, last_a - first_a)
    found = last_b - first_b >= min_words and 100 * matched >= percent * span
    if len(runs) > 1 and span >= min_words and (not found or max(strange) > 0):
        # Two passages with a stranger's words between them. Far down, halves keep the depth small.
        cut = int(np.argmax(strange if max(strange) > 0 else gaps)) + 1 if depth < 300 else len(runs) // 2
        x, y, size = (int(v) for v in runs[cut - 1])
        # Of the words between, each part may take what agrees with it, but not run on into the other part.
        before = _align(b, a, runs[:cut], min_words, percent, (*room[:2], int(runs[cut, 0]), int(runs[cut, 1])), depth + 1)
        after = _align(b, a, runs[cut:], min_words, percent, (x + size, y + size, *room[2:]), depth + 1)
        if not found or (before and after):
            return before + after
    return [(first_b, last_b, first_a, last_a, matched)] if found else []


def _aligner(min_words: int, percent: int):
    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {c.name: [] for c in _PASSAGES}
            names = ("words_b", "words_a", "run_b", "run_a", "run_n")
            lists = {c: batch.column(c) for c in names}
            one = {c: batch.column(c).to_pylist() for c in ("b", "a", "low_b", "low_a")}
            for i in range(batch.num_rows):
                own = {c: lists[c][i].values.to_numpy() for c in names}
                low_b, low_a = one["low_b"][i], one["low_a"][i]
                runs = np.stack([own["run_b"] - low_b, own["run_a"] - low_a, own["run_n"]], axis=1).astype(np.int64)
                for x, y, u, v, matched in align(own["words_b"], own["words_a"], runs, min_words, percent):
                    row = (one["b"][i], one["a"][i], x + low_b, y + low_b, u + low_a, v + low_a, matched)
                    for name, value in zip(out, row):
                        out[name].append(value)
            yield pa.RecordBatch.from_pydict(out, schema=_PASSAGES)

    return aligned


_PASSAGES = pa.schema(
    [("node", pa.int64()), ("other", pa.int64())]
    + [(c, pa.int32()) for c in ("start_word", "end_word", "other_start", "other_end", "matched")]
)
_PASSAGE_SCHEMA = "node long, other long, start_word int, end_word int, other_start int, other_end int, matched int"


def text_passages(
    texts: DataFrame, min_words: int, percent: int, k: int, window: int, steps: Steps
) -> DataFrame:
    """Passages of distinct texts (``node``, ``text``; copies allowed) that stand in a text of smaller node."""
    seed_schema = "seed long, node long, place int"
    long_k = max(k, min_words * LONG // 100)

    def sought(seeds: DataFrame) -> DataFrame:
        return seeds.repartition("seed").sortWithinPartitions("seed", "node", "place")

    def matched(seeds: DataFrame, n: int, previous: bool) -> DataFrame:
        return sought(seeds).mapInArrow(_matcher(n, previous), "b long, a long, at_b int, at_a int, n int")

    # Every run of min_words words holds a minimizer of its long k-mers.
    recurring = sought(texts.mapInArrow(_seeds(long_k, min_words - long_k + 1), seed_schema)).mapInArrow(
        _recurring, "node long, place int"
    )
    spots = steps.write(recurring.groupBy("node").agg(F.collect_set("place").alias("places")), release=True)
    held = among(texts, spots.select("node"), "node").dropDuplicates(["node"]).join(spots, "node")
    runs = held.select("node", "text", "places").mapInArrow(_runs_around(min_words, long_k), seed_schema)
    matches = matched(texts.mapInArrow(_seeds(k, window), seed_schema), k, True).unionByName(
        matched(runs, min_words, False)
    )
    matches = steps.write(matches, release=True)

    def chained(rows: DataFrame, spare: bool) -> DataFrame:
        out = (
            rows.repartition("b")
            .sortWithinPartitions("b", "a", "at_b", "at_a")
            .mapInArrow(_chains(k, min_words, min_words, spare), _CHAIN_SCHEMA)
        )
        return steps.write(out.withColumn("chain", F.monotonically_increasing_id()), release=True)

    chains = chained(matches, False)
    begin = lambda side: F.get(f"run_{side}", 0)
    last = lambda side: F.element_at(f"run_{side}", -1) + F.element_at("run_n", -1)

    def passages(chosen: DataFrame) -> DataFrame:
        """What alignment makes of some chains."""

        def asked(side: str) -> DataFrame:
            return chosen.select(
                F.col(side).alias("node"),
                "chain",
                F.lit(side).alias("side"),
                F.greatest(begin(side) - MARGIN, F.lit(0)).alias("low"),
                (last(side) + MARGIN).alias("high"),
            )

        # A row per chain would carry the text with each.
        wanted = (
            asked("b")
            .unionByName(asked("a"))
            .groupBy("node", F.pmod("chain", F.lit(_DEALS)).alias("deal"))
            .agg(F.collect_list(F.struct("chain", "side", "low", "high")).alias("asked"))
        )
        wanted = steps.write(wanted, release=True)
        nodes = steps.write(wanted.select("node").distinct(), release=True)
        once = among(texts, nodes, "node").dropDuplicates(["node"])
        regions = steps.write(
            once.join(wanted, "node")
            .select("text", "asked")
            .mapInArrow(_regions, "chain long, side string, low int, words array<int>"),
            release=True,
        )
        part = lambda side: regions.where(F.col("side") == side).select(
            "chain", F.col("low").alias(f"low_{side}"), F.col("words").alias(f"words_{side}")
        )
        both = chosen.join(part("b"), "chain").join(part("a"), "chain").drop("chain", "spares")
        out = steps.write(both.mapInArrow(_aligner(min_words, percent), _PASSAGE_SCHEMA), release=True)
        steps.forget(regions, wanted, nodes)
        return out

    first = passages(chains)
    # A text has few passages: those of the chains that cover it.
    spans = F.collect_set(F.struct(F.col("start_word").alias("start"), F.col("end_word").alias("end")))
    known = first.groupBy("node").agg(_merged(spans).alias("known"))
    spare = chains.where(F.size("spares") > 0).select(F.col("b").alias("node"), "spares").join(known, "node", "left")
    still = F.exists("spares", lambda c: _open_words(c["begin"], c["end"], F.col("known")) >= LEFT_OUT)
    left = steps.write(spare.where(still).select(F.col("node").alias("b"), "known"), release=True)
    if not left.head(1):
        steps.forget(matches)
        return first
    spans = left.select("b", F.explode("known").alias("x")).select(
        "b", F.col("b").alias("a"), F.col("x.start").alias("at_b"), F.col("x.end").alias("at_a"), F.lit(0).alias("n")
    )
    more = chained(among(matches, left.select("b"), "b").unionByName(spans), True)
    steps.forget(matches)
    return first.unionByName(passages(more))


def _texts(docs: DataFrame, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.xxhash64(text).alias("node"), text.alias("text"))


def repeated_passages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    percent: int = PERCENT,
    k: int = K,
    window: int = WINDOW,
) -> DataFrame:
    """Passages of documents that stand in another document too: doc_id, start_word, end_word, n_words,
    other_id, other_start, other_end, matched.

    A passage has ``min_words`` words or more (A-Z lower-cased, cut at white space) of which ``percent`` agree with the other
    document's; places count words from 0, the end is exclusive. Of two texts only one has the
    passage listed, the other keeps it: texts are ordered by their hash, copies of one text by doc_id. A copy
    of a whole text is listed as one passage over all its words. ``other_id`` is the least doc_id of the other text. A passage
    that stands in several texts is listed against one or a few of them, not against all; of a passage's words, up to ``LEFT_OUT`` at an end
    may be left out that only agree with a text not listed.
    Null and empty texts have no words; null ids are reported as null and come last among copies; repeated rows are
    copies. Other columns are not read; an empty table gives no rows.
    """
    steps = Steps(docs.sparkSession)
    texts = _texts(docs, text_col)
    found = steps.write(text_passages(texts, min_words, percent, k, window, steps), release=True)
    text = F.coalesce(F.col(text_col), F.lit(""))
    members = steps.write(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            F.xxhash64(text).alias("node"),
            F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).alias("total"),
        )
    )
    first = members.groupBy("node").agg(
        F.min("doc_id").alias("other_id"), F.count(F.lit(1)).alias("copies"), F.any_value("total").alias("total")
    )
    here = found.join(members.select("doc_id", "node"), "node").join(
        first.select(F.col("node").alias("other"), "other_id"), "other"
    )
    columns = ["doc_id", "start_word", "end_word", "n_words", "other_id", "other_start", "other_end", "matched"]
    here = here.withColumn("n_words", F.col("end_word") - F.col("start_word")).select(columns)
    # The first copy keeps the text; which of several rows with the least id that is does not show.
    copies = members.join(first.where((F.col("copies") > 1) & (F.col("total") >= min_words)).drop("total"), "node")
    listed = copies.where(~F.col("doc_id").eqNullSafe(F.col("other_id")))
    whole = listed.select(
        "doc_id",
        F.lit(0).alias("start_word"),
        F.col("total").alias("end_word"),
        F.col("total").alias("n_words"),
        "other_id",
        F.lit(0).alias("other_start"),
        F.col("total").alias("other_end"),
        F.col("total").alias("matched"),
    )
    return steps.result(here.unionByName(whole))


def _cutter(text_col: str):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, text_col):
            words = words_of(part.column(text_col))
            texts = part.column(text_col).to_pylist()
            stay = np.ones(part.num_rows, bool)
            for i, spans in enumerate(part.column("_spans").to_pylist()):
                if not spans:
                    continue
                low, high = words.first[i], words.first[i + 1]
                raw, base = words.data[words.byte0[i] : words.byte0[i + 1]], words.byte0[i]
                keep = np.ones(len(raw), bool)
                for span in spans:
                    begin, end = low + span["start_word"], min(low + span["end_word"], high)
                    until = words.start[end] - base if end < high else len(raw)
                    keep[words.start[begin] - base : until] = False
                texts[i] = raw[keep].tobytes().decode().rstrip(" \t\n\v\f\r")
                stay[i] = texts[i] != ""
            at = part.schema.get_field_index(text_col)
            part = part.set_column(at, part.schema.field(at), pa.array(texts, part.schema.field(at).type))
            yield part.drop_columns(["_spans"]).filter(pa.array(stay))

    return cut


def cut_passages(
    docs: DataFrame,
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    percent: int = PERCENT,
    k: int = K,
    window: int = WINDOW,
) -> DataFrame:
    """``docs`` without the passages that another text keeps, same columns, whatever their names; texts that were nothing else go.

    Passages are those of ``repeated_passages`` between different texts; copies of a whole text are cut alike. Null texts stay as they are.
    """
    steps = Steps(docs.sparkSession)
    docs, now, back = shield(docs, "_node", "_spans")
    text_col = now[text_col]
    found = steps.result(text_passages(_texts(docs, text_col), min_words, percent, k, window, steps))
    spans = found.groupBy("node").agg(F.collect_set(F.struct("start_word", "end_word")).alias("_spans"))
    node = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    marked = docs.withColumn("_node", node).join(spans.withColumnRenamed("node", "_node"), "_node", "left")
    return back(marked.select(*docs.columns, "_spans").mapInArrow(_cutter(text_col), docs.schema))
