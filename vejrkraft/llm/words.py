"""Words and shingles of Arrow string columns, hashed with numpy.

A word is hashed from its bytes by a polynomial over random byte codes (one prefix sum serves all
words of a chunk), then mixed. Texts are cut into chunks of whole rows, so memory follows the
chunk and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
SHINGLE = 5

_random = np.random.default_rng(20_231_107)
_BYTE_CODES = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE_CODES = _random.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# Words in white-space text are [^\x20\x09-\x0D]+.
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
# Words without punctuation: ASCII letters and digits, and all bytes of other characters.
PLAIN = np.zeros(256, dtype=bool)
PLAIN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def mixed(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over all 64."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class _Powers:
    """base^i and base^-i, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
                old = getattr(self, name)
                step = np.uint64(pow(base, len(old), 1 << 64))
                setattr(self, name, np.concatenate([old, old * step]))
        return self.up[:n], self.down[:n]


_powers = _Powers()


@dataclass
class Words:
    """The words of some rows: ``hash`` of all words, row ``i`` owns ``first[i]:first[i + 1]``.

    ``start`` and ``end`` are byte places in ``data``, where row ``i`` begins at ``byte0[i]``.
    """

    hash: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray
    data: np.ndarray
    byte0: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column (null: empty) and where each row begins."""
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    places = np.frombuffer(column.buffers()[1], dtype=np.int64)
    places = places[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    return data[places[0] : places[-1]], places - places[0]


def words_of(column: pa.Array, kind: np.ndarray = SPACED, lower: bool = True) -> Words:
    """Words of each row, A-Z lower-cased if asked; null counts as empty."""
    data, byte0 = bytes_of(column)
    if len(data) == 0:
        none = np.zeros(0, dtype=np.int64)
        first = np.zeros(len(column) + 1, dtype=np.int64)
        return Words(np.zeros(0, np.uint64), first, none, none, data, byte0)
    inside = kind[data]
    begins = np.zeros(len(data) + 1, dtype=bool)
    begins[byte0] = True
    before = np.concatenate([[False], inside[:-1]])
    start = np.flatnonzero(inside & (begins[:-1] | ~before))
    after = np.concatenate([inside[1:], [False]])
    end = np.flatnonzero(inside & (begins[1:] | ~after)) + 1
    up, down = _powers(len(data) + 1)
    codes = _BYTE_CODES[_LOWER[data] if lower else data]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * up[:-1], dtype=np.uint64)])
    hashes = mixed((sums[end] - sums[start]) * down[start])
    return Words(hashes, np.searchsorted(start, byte0), start, end, data, byte0)


def shingles(words: Words, k: int = SHINGLE, short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words, and the number of shingles per row.

    With ``short``, a row of n = 1 to k - 1 words has one shingle, made of all its words: the one it has for k = n.
    """
    h, n = words.hash, len(words.hash)
    counts = words.counts
    if n >= k:
        runs = np.zeros(n - k + 1, dtype=np.uint64)
        for j in range(k):
            runs += h[j : n - k + 1 + j] * _PLACE_CODES[j]
        rows = words.rows
        whole = rows[: n - k + 1] == rows[k - 1 :]
        runs = mixed(runs[whole] + np.uint64(k))
    else:
        runs = np.zeros(0, dtype=np.uint64)
    each = np.maximum(counts - k + 1, 0)
    few = np.flatnonzero((counts > 0) & (counts < k)) if short else []
    if len(few):
        place = np.concatenate([[0], np.cumsum(each)])
        extra = []
        for i in few:
            own = h[words.first[i] : words.first[i + 1]]
            extra.append((own * _PLACE_CODES[: len(own)]).sum(dtype=np.uint64) + np.uint64(len(own)))
        runs = np.insert(runs, place[few], mixed(np.array(extra, dtype=np.uint64)))
        each = each.copy()
        each[few] = 1
    return runs, each


def shingle_sets(words: Words, k: int = SHINGLE) -> Iterator[np.ndarray]:
    """The distinct shingles of each row, sorted."""
    runs, each = shingles(words, k)
    place = np.concatenate([[0], np.cumsum(each)])
    for i in range(len(each)):
        own = np.sort(runs[place[i] : place[i + 1]])
        if len(own) > 1:
            own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        yield own


def chunks(
    batches: Iterator[pa.RecordBatch], column: str, budget: int = CHUNK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Slices of batches with about ``budget`` bytes in ``column``, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(sizes, dtype=np.int64)
        low = 0
        while low < batch.num_rows:
            done = total[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(total, done + budget, side="right")))
            yield batch.slice(low, high - low)
            low = high


def runs_of(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin in a sorted array, and its length at the end."""
    if len(keys) == 0:
        return np.zeros(1, dtype=np.int64)
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])


def list_column(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """A list column with one array per row."""
    sizes = np.array([0, *map(len, parts)], dtype=np.int64)
    flat = np.concatenate(parts) if parts else np.zeros(0)
    return pa.ListArray.from_arrays(
        pa.array(np.cumsum(sizes), pa.int32()), pa.array(flat.astype(kind.to_pandas_dtype()), kind)
    )
