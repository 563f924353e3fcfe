"""Token groups and corpus counts against a plain version."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from vejrkraft.llm import alignment
from vejrkraft.llm.alignment import align_texts, align_tokens, coalesced, linked_pairs
from vejrkraft.llm.tokenizers_read import ByteLevel, Pieces, file_bytes, vocabulary

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, block int, pair string, groups array<int>"
TEXTS = [
    None,
    "",
    " ",
    "\n",
    "one",
    "Hello world, hello  world!\n\n\tEnd.",
    "<|endoftext|> stays text, </s> too",
    "naïve façade 漢字かな 😀😀 ​ x",
    "a\x00b",
    "ﬁne ½ Å",
    "x" * 3000,
    " " * 300,
    "the the the the",
    "don't we'll  it's 12345 3.14",
]


def _mixed(rng):
    words = ["the", "The", "können", "über", "l'été", "漢字", "😀", "12", "3.5", "\n", "\n\n", "  ", "\t", "-", "don't", "zxqj", " "]
    return "".join(rng.choice(words) + rng.choice([" ", "", " "]) for _ in range(rng.randrange(1, 60)))


@pytest.fixture(scope="module")
def first():
    return vocabulary(ByteLevel, file_bytes(A))


@pytest.fixture(scope="module")
def second():
    return vocabulary(Pieces, file_bytes(B))


def test_ranks_give_the_tokens_of_the_file(first):
    own = Tokenizer.from_file(A)
    own.encode_special_tokens = True
    rng = random.Random(2)
    letters = "abcé漢😀 \n\t'0.<|>_ ​"
    texts = [_mixed(rng) for _ in range(300)] + ["".join(rng.choice(letters) for _ in range(80)) for _ in range(300)]
    texts += [t for t in TEXTS if t] + ["a" * 20_000, "\n" * 5000, "^" * 5000, "漢字" * 3000]
    want = [own.encode(t, add_special_tokens=False).ids for t in texts]
    assert first.lists(texts) == want
    ids, counts = first.encode(texts)
    assert first.restores(ids, counts, [t.encode() for t in texts]).all()


def test_restores_judges_each_text(first):
    ids, counts = first.encode(["ab", "cd", ""])
    assert first.restores(ids, counts, [b"ab", b"xd", b""]).tolist() == [True, False, True]
    assert first.restores(ids, counts, [b"abc", b"d", b""]).tolist() == [False, False, True]


def test_groups_of_any_intervals_break_at_the_running_maximum():
    start, end, side = map(np.array, ([0, 3, 5, 0, 4, 5], [3, 5, 9, 4, 5, 9], [0, 0, 0, 1, 1, 1]))
    assert coalesced(start, end, side).tolist() == [0, 0, 1, 0, 0, 1]


def _plain(texts, first, second):
    """Per text: groups as lists of ids, by walking both token lists."""
    out = []
    for t in texts:
        t = t or ""
        a, b = first.lists([" " + t])[0], second.lists([t])[0]
        whole = (" " + t).encode()
        if not t or any(b"".join(v.entries[i] for i in ids) != whole for v, ids in ((first, a), (second, b))):
            out.append([])
            continue
        ends = []
        for v, ids in ((first, a), (second, b)):
            at, places = 0, []
            for i in ids:
                at += len(v.entries[i])
                places.append(at)
            ends.append(places)
        groups, low = [], 0
        for cut in sorted(set(ends[0]) & set(ends[1])):
            groups.append(tuple([i for i, e in zip(ids, p) if low < e <= cut] for ids, p in zip((a, b), ends)))
            low = cut
        out.append(groups)
    return out


def _digest(groups):
    text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
    return text


def _brute(rows, first, second):
    grouped = _plain([t for _, t, *_ in rows], first, second)
    holders, links = Counter(), []
    for groups in grouped:
        own = Counter((a, b) for x, y in groups for a in x for b in y)
        links.append(own)
        holders.update(own.keys())
    best = defaultdict(int)
    for (a, _), n in holders.items():
        best[a] = max(best[a], n)
    return [
        (
            row[0],
            sum(len(x) for x, _ in groups),
            sum(len(y) for _, y in groups),
            len(groups),
            sum(own.values()),
            sum(n for p, n in own.items() if holders[p] == best[p[0]]),
            sum(n * holders[p] for p, n in own.items()),
            _digest(groups),
        )
        for row, groups, own in zip(rows, grouped, links)
    ]


@pytest.mark.parametrize("block_bytes, pairs", [(1 << 23, 1 << 22), (200, 3)])
def test_operator_equals_a_plain_count(spark, monkeypatch, first, second, block_bytes, pairs):
    monkeypatch.setattr(alignment, "PAIRS_AT_ONCE", pairs)
    rng = random.Random(11)
    texts = TEXTS + [_mixed(rng) for _ in range(60)]
    rows = [(i, t, 1, "x", [1]) for i, t in enumerate(texts)] + [(3, "the cat", 2, "y", [])] * 3 + [(None, "the end", None, None, None)]
    got = align_tokens(spark.createDataFrame(rows, DOCS).repartition(3), A, B, block_bytes=block_bytes)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(_brute(rows, first, second), key=repr)


def test_long_groups_of_equal_ids_make_few_pairs(first, second):
    """Tokens of both sides over a long line that never cut at one place."""
    n = 20_000
    found = alignment.Aligned(
        np.full(n, 7), np.full(n, 9), np.array([n]), np.array([n]), np.zeros(n, np.int64), np.zeros(n, np.int64), np.array([0, 1])
    )
    text, pair, times = linked_pairs(found, 10, 10)
    assert (text.tolist(), pair.tolist(), times.tolist()) == ([0], [79], [n * n])


def test_links_are_packed_whole():
    rng = np.random.default_rng(3)
    places = np.unique(rng.integers(0, 300_000, 5000))
    times = rng.integers(1, 600, len(places))
    pages = -(-300_000 // 65_536)
    got = alignment._unpacked(*alignment._packed(places, times, pages), pages)
    assert got[0].tolist() == places.tolist() and got[1].tolist() == times.tolist()


def test_empty_table_and_kept_digest(spark):
    from pyspark.sql import functions as F

    empty = spark.createDataFrame([], DOCS)
    assert align_tokens(empty, A, B).count() == 0
    one = spark.createDataFrame([(1, "hello there", 1, "x", [1])], DOCS)
    whole, short = (align_tokens(one, A, B, keep=k).first()["groups"] for k in (lambda g: g, lambda g: F.sha2(g, 256)))
    assert hashlib.sha256(whole.encode()).hexdigest() == short


def test_a_large_file_is_refused(tmp_path, monkeypatch):
    from vejrkraft.llm import tokenizers_read

    (tmp_path / "v").write_bytes(b"12345")
    monkeypatch.setattr(tokenizers_read, "MOST_BYTES", 4)
    with pytest.raises(ValueError, match="larger"):
        file_bytes(str(tmp_path / "v"))
