"""Periodic runs against a plain search over all periods."""

import random

import numpy as np
import pyarrow as pa
import pytest
from conftest import rows

from vejrkraft.llm import periodic

DOCS = "doc_id long, text string, runs string, collapsed int, n_words array<int>"


def _lyndon(x):
    out = []
    for i in range(len(x)):
        j = i + 1
        while j < len(x) and x[j:] > x[i:]:
            j += 1
        out.append(j - i)
    return out


def _runs(x, least, exponent):
    out = []
    for q in range(1, len(x) // exponent + 1):
        i = 0
        while i + q < len(x):
            j = i
            while j + q < len(x) and x[j] == x[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(least, exponent * q) and (i, length) not in [r[:2] for r in out]:
                out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def _sequence(rng):
    k, n = rng.choice([1, 2, 2, 3, 5]), rng.randrange(1, 40)
    x = [rng.randrange(k) for _ in range(n)]
    if rng.random() < 0.5:
        u = [rng.randrange(k) for _ in range(rng.randrange(1, 6))]
        x = x[: rng.randrange(n + 1)] + u * rng.randrange(2, 8) + u[: rng.randrange(len(u) + 1)] + x
    return x


def test_grouping_gives_the_lyndon_array():
    rng = random.Random(1)
    for _ in range(1500):
        x = _sequence(rng)
        assert periodic.lyndon_array(np.array(x)).tolist() == _lyndon(x)
        assert periodic.lyndon_array(-np.array(x)).tolist() == _lyndon([-v for v in x])


@pytest.mark.parametrize("least, exponent", [(6, 4), (1, 2), (3, 3)])
def test_runs_equal_a_plain_search(least, exponent):
    rng = random.Random(exponent)
    for _ in range(1000):
        x = _sequence(rng)
        text = " ".join(f"w{v}" for v in x)
        want = _runs(x, least, exponent)
        words, found = periodic.text_runs(pa.array([None, text, "", text]), least, exponent)
        assert words.counts.tolist() == [0, len(x), 0, len(x)]
        assert [tuple(r) for r in found.tolist()] == want + [(s + len(x), n, q) for s, n, q in want]


def test_wrong_hash_answers_are_put_right(monkeypatch):
    """Extensions that reach too far are found out word by word."""
    most = lambda self, x, y, n: n.copy()
    monkeypatch.setattr(periodic.Extensions, "forward", most)
    monkeypatch.setattr(periodic.Extensions, "backward", most)
    rng = random.Random(8)
    for _ in range(300):
        x = _sequence(rng)
        got = periodic.runs_in(np.array(x), [(0, len(x))], 6, 4).tolist()
        assert [tuple(r) for r in got] == _runs(x, 6, 4)


def test_long_repetitive_texts_stay_linear():
    for text in ("a " * 300_000, "a b c " * 100_000, "ab\n" * 100_000 + "x " * 100_000):
        _, found = periodic.text_runs(pa.array([text]), 6, 4)
        assert len(found) == text.count("\n") // 10**5 + 1


def _collapsed(text):
    words = (text or "").split()
    gone = {i for s, n, q in _runs(words, 6, 4) for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_operator_on_odd_rows(spark):
    rng = random.Random(5)
    texts = [None, "", " \t\r\n", "one", "é é é é é é", "no no no no no no yes", "a b " * 4 + "c", "a b " * 9, "x " * 5000]
    texts += [" ".join(f"w{v}" for v in _sequence(rng)) for _ in range(60)]
    data = [(i, t, "x", 1, [1]) for i, t in enumerate(texts)] + [(None, "z " * 8, None, None, None)] * 2 + [(5, texts[5], "y", 2, [])]
    got = periodic.periodic_runs(spark.createDataFrame(data, DOCS).repartition(5))
    assert got.columns == ["doc_id", "n_words", "runs", "collapsed"]
    words = lambda t: (t or "").split(" ") if t and " " in t else (t or "").split()
    want = []
    for i, t, *_ in data:
        w = [v for v in words(t) if v]
        want.append((i, len(w), [tuple(r) for r in _runs(w, 6, 4)]))
    assert rows(got.selectExpr("doc_id", "n_words", "transform(runs, r -> array(r.start, r.length, r.period)) runs")) == sorted(
        ((i, n, [list(r) for r in runs]) for i, n, runs in want), key=repr
    )
    by_id = {r["doc_id"]: r["collapsed"] for r in got.where("doc_id is not null").collect()}
    assert all(by_id[i] == _collapsed(t) for i, t in enumerate(texts) if not (t and " " in t))
    assert by_id[0] == by_id[1] == by_id[2] == "" and by_id[4] == "é" and by_id[6] == "a b c"


def test_empty_table(spark):
    assert periodic.periodic_runs(spark.createDataFrame([], DOCS)).count() == 0
