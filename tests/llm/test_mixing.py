import math
import random

import pytest

from vejrkraft.llm import mixing

SCHEMA = "doc_id long, text string, source string, size int, place string"


def _targets(sizes, weights=(5, 2, 1)):
    """By source: iterate until no target is above three times its size."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    total, stopped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in stopped)
        live = sum(w[s] for s in order if s not in stopped)
        target = {s: 3.0 * sizes[s] if s in stopped else left * w[s] / live for s in order}
        above = {s for s in order if s not in stopped and target[s] > 3 * sizes[s]}
        if not above:
            return target
        stopped |= above


def _webster(shares, seats):
    won = dict.fromkeys(shares, 0)
    for _ in range(seats):
        best = max(sorted(shares), key=lambda k: shares[k] / (2 * won[k] + 1))
        won[best] += 1
    return won


@pytest.mark.parametrize("seats", [0, 1, 3, 17, 400])
def test_quotas_are_those_of_highest_quotients(spark, seats):
    rng = random.Random(seats)
    shares = {i: rng.choice([0.5, 1.0, 3.7, 100.0, 1e-3]) * rng.random() for i in range(30)}
    df = spark.createDataFrame(list(shares.items()), "k int, share double")
    got = {r["k"]: r["quota"] for r in mixing.apportion(df, ["k"], "share", seats).collect()}
    assert got == _webster(shares, seats)


def _docs(spark, rng, n=300):
    rows = []
    for i in range(n):
        source = rng.choice(["a", "a", "a", "b", "ä", None])
        size = rng.choice([0, 1, 5, 40, 300])
        rows.append((i, " ".join("w" * rng.randrange(1, 9) for _ in range(size)) or rng.choice([None, "", " \n"]), source, 1, "x"))
    rows += [(None, "a b", "a", 1, "x")] * 2 + [(7, "c d e", "b", 1, "x")] * 3 + [(8, None, "a", 1, "x")] * 2
    return spark.createDataFrame(rows, SCHEMA), rows


@pytest.mark.parametrize("blocks, docs_per_shard", [(1 << 20, 10_000), (500, 20)])
def test_mix_meets_targets(spark, blocks, docs_per_shard):
    df, rows = _docs(spark, random.Random(4))
    run = lambda: mixing.mix_sources(df, blocks=blocks, docs_per_shard=docs_per_shard).collect()
    got = run()
    assert len(got) == len(rows)
    sizes = {}
    for _, text, source, *_ in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    want = _targets(sizes)
    length = max(1, math.ceil(sum(sizes.values()) / blocks))
    for source, size in sizes.items():
        own = [r for r in got if r["source"] == source]
        assert {r["source_size"] for r in own} == {size}
        assert all(math.isclose(r["target"], want[source], rel_tol=1e-9) for r in own)
        shards = len({r["shard"] for r in own})
        assert abs(sum(r["taken"] for r in own) - want[source]) <= length * (shards + 1)
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    assert sorted(map(repr, run())) == sorted(map(repr, got))


def test_empty_and_wordless_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.mix_sources(empty).count() == 0
    blank = spark.createDataFrame([(1, None, None, 1, "x"), (2, " ", "a", 1, "x")], SCHEMA)
    assert [(r["size"], r["taken"], r["target"]) for r in mixing.mix_sources(blank).collect()] == [(0, 0, 0.0)] * 2


def test_small_sources_stop_at_three_times_their_size(spark):
    rows = [(i, "w " * 100, "z", 1, "x") for i in range(50)] + [(100, "w " * 10, "a", 1, "x")]
    got = mixing.mix_sources(spark.createDataFrame(rows, SCHEMA)).collect()
    small = next(r for r in got if r["source"] == "a")
    assert (small["target"], small["taken"]) == (30.0, 30)
    assert sum(r["taken"] for r in got if r["source"] == "z") == 5010 - 30


def test_sources_below_a_block_get_their_target(spark):
    """128 blocks of 391 words: 30 and 3 words are less than half a block."""
    rows = [(i, "w " * 1000, "z", 1, "x") for i in range(50)]
    rows += [(100, "w " * 10, "a", 1, "x"), (101, "w", "b", 1, "x")]
    got = mixing.mix_sources(spark.createDataFrame(rows, SCHEMA), blocks=1).collect()
    assert {r["source"]: (r["target"], r["taken"]) for r in got if r["source"] != "z"} == {"a": (30.0, 30), "b": (3.0, 3)}
    assert sum(r["taken"] for r in got) == 50_011
