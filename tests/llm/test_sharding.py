"""Shards by bytes against a plain partition of the ordered groups."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from vejrkraft.llm import sharding
from vejrkraft.llm.sharding import Ends, minimax_cuts, shard_documents

DOCS = "doc_id long, text string, shard string, digest int, copy array<int>"


def _smallest(sizes, shards):
    """By trying every capacity that some stretch of groups has."""
    sums = sorted({sum(sizes[i:j]) for i in range(len(sizes)) for j in range(i + 1, len(sizes) + 1)})
    for capacity in sums:
        used, room = 0, 0
        for s in sizes:
            if s > capacity:
                break
            if s > room:
                used, room = used + 1, capacity
            room -= s
        else:
            if used <= shards:
                return capacity
    return 0


def _cuts(sizes, shards):
    out, begin, place = [], 0, 0
    for left in range(shards, 0, -1):
        room = _smallest(sizes[place:], left)
        while place < len(sizes) and sizes[place] <= room:
            room -= sizes[place]
            begin += sizes[place]
            place += 1
        out.append(begin)
    return out


def _ends(sizes, bins):
    upto = [sum(sizes[: i + 1]) for i in range(len(sizes))]
    asked = []

    def fetch(spans):
        asked.append(len(spans))
        found = {}
        for i, (a, b) in enumerate(spans):
            each = max(1, bins // len(spans))
            for v in upto:
                if a < v < b:
                    at = (i, int((v - a - 1) * min(1.0, each / max(1, b - a - 1))))
                    found[at] = (v, found.get(at, (0, 0))[1] + 1)
        return list(found.values())

    return Ends(upto[-1], fetch), asked


@pytest.mark.parametrize("bins", [1, 4, 30, 1000])
def test_cuts_equal_a_plain_search(bins):
    rng = random.Random(bins)
    for _ in range(150):
        sizes = [rng.choice([1, 2, 5, 50, 400]) * rng.randrange(1, 4) for _ in range(rng.randrange(1, 50))]
        shards = rng.randrange(1, 10)
        ends, _ = _ends(sizes, bins)
        assert minimax_cuts(ends, shards) == _cuts(sizes, shards), (sizes, shards)


def test_few_fetches_and_few_known_ends():
    rng = random.Random(5)
    sizes = [rng.randrange(1, 3000) for _ in range(60_000)]
    upto, s = [], 0
    for n in sizes:
        upto.append(s := s + n)
    import numpy as np

    all_ends, calls = np.array(upto), []

    def fetch(spans):
        calls.append(spans)
        out = {}
        for i, (a, b) in enumerate(spans):
            each = max(1, 2000 // len(spans))
            for v in all_ends[(all_ends > a) & (all_ends < b)].tolist():
                at = (i, int((v - a - 1) * min(1.0, each / max(1, b - a - 1))))
                out[at] = (v, out.get(at, (0, 0))[1] + 1)
        return list(out.values())

    ends = Ends(s, fetch)
    cuts = minimax_cuts(ends, 8)
    shards = np.diff([0, *cuts])
    assert len(ends.at) < 10_000 and len(calls) < 40
    assert shards.max() - shards.min() < 6000 and set(cuts) <= set(upto)


def _expected(rows, shards):
    """Size, crc, shard and slot of every row, as a multiset."""
    size = lambda t: len((t or "").encode()) + 1
    digest = lambda t: hashlib.sha256((t or "").encode()).digest()
    groups, total = defaultdict(int), sum(size(t) for _, t, *_ in rows)
    for _, t, *_ in rows:
        groups[digest(t)] += size(t)
    order = sorted(groups, key=lambda d: (-groups[d] if groups[d] * shards * 1024 > total else 0, d))
    cuts, place, upto = _cuts([groups[d] for d in order], shards), {}, 0
    for d in order:
        upto += groups[d]
        place[d] = sum(upto > c for c in cuts[:-1])
    out, seen = [], Counter()
    crc = lambda t: zlib.crc32((t or "").encode())
    for i, t, *_ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, crc(r[1]), digest(r[1]))):
        shard = place[digest(t)]
        out.append((i, size(t), crc(t), "bytes", shard, seen[shard], None))
        seen[shard] += 1
    return sorted(out, key=repr)


def _rows(rng, n):
    texts = ["word " * rng.randrange(1, 40) + str(i) for i in range(n)]
    rows = [(i, t, "x", 1, [1]) for i, t in enumerate(texts)]
    rows += [(1000 + i, "a copy that is often there", "x", 1, []) for i in range(n)]
    rows += [(2000, None, "x", 1, []), (2001, "", None, None, None), (None, "é" * 9, "x", 1, []), (None, None, "x", 1, [])]
    rows += [(n - 1, texts[-1], "y", 2, [])] * 4 + [(2002, "long " * 400, "x", 1, [])]
    return rows


@pytest.mark.parametrize("n, shards, bins", [(60, 8, 1 << 15), (60, 3, 4), (3, 8, 1 << 15), (60, 1, 10)])
def test_operator_equals_a_plain_partition(spark, n, shards, bins):
    rows = _rows(random.Random(n + shards), n)
    df = spark.createDataFrame(rows, DOCS)
    for parts in (1, 5):
        got = shard_documents(df.repartition(parts), shards, bins=bins)
        assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
        assert sorted(map(tuple, got.collect()), key=repr) == _expected(rows, shards)


def test_large_groups_are_few_others_even(spark, monkeypatch):
    monkeypatch.setattr(sharding, "LARGE", 2)
    rows = [(i, f"text {i:04d}", "x", 1, []) for i in range(800)] + [(i, "one third of all", "x", 1, []) for i in range(1000, 1260)]
    got = shard_documents(spark.createDataFrame(rows, DOCS), 8).collect()
    sizes = Counter()
    for r in got:
        sizes[r["shard"]] += r["size"]
    assert {r["shard"] for r in got if r["doc_id"] >= 1000} == {0}
    rest = [sizes[s] for s in range(1, 8)]
    assert max(rest) - min(rest) <= 20 and sizes[0] == 260 * 17


def test_empty_table(spark):
    assert shard_documents(spark.createDataFrame([], DOCS)).count() == 0
