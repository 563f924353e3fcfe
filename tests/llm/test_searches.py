"""Decontamination, Jaccard classes, components and repeated passages against plain searches."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from fixture_texts import edited, text, words

from vejrkraft.llm import components as comp
from vejrkraft.llm import decontaminate, jaccard_tree, passages
from vejrkraft.llm.steps import Steps

CLASH = "doc_id long, text string, key int, node string, n string, label string"


def _df(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", "y", "z") for i, t in rows], CLASH)


def _plain(t):
    return re.findall(r"[a-z0-9\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))


def _grams(w, k):
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def _contained(docs, items, percent=80):
    out = []
    for doc, t in docs:
        for item, q in items:
            w = _plain(q)
            if w and item is not None:
                k = min(5, len(w))
                want, have = _grams(w, k), _grams(_plain(t), k)
                if 100 * len(want & have) >= percent * len(want):
                    out.append((doc, item, len(want), len(want & have)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_shingles", [1 << 19, 30])
def test_containment_equals_a_plain_search(spark, block_shingles):
    items = [(i, text(12 + 5 * i, 100 + i)) for i in range(8)]
    items += [(20, "two words"), (21, "Solo!"), (22, ""), (23, None), (None, "one two"), (24, items[0][1]), (25, "a b a b a b a b")]
    rng = random.Random(2)
    docs = [(0, None), (1, ""), (2, " . "), (None, items[2][1]), (None, items[2][1])]
    for i in range(3, 40):
        body = words(rng.randrange(400), i)
        at = rng.randrange(len(body) + 1)
        q = _plain(rng.choice(items[:8])[1])
        body[at:at] = edited(q, rng.choice([0, 0.02, 0.06, 0.3]), i)
        docs.append((i, (" ".join(body)).upper() if i % 3 else ", ".join(body) + ". Two, words"))
    docs += [docs[-1], (50, "solo " + "b a " * 9), (51, " ".join(words(30_000, 9)) + " " + items[7][1])]
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    got = decontaminate.contained_items(_df(spark, docs), asked, block_shingles=block_shingles)
    want = _contained(docs, items)
    assert len(want) > 20 and sorted((tuple(r) for r in got.collect()), key=repr) == want
    clean = decontaminate.decontaminate(_df(spark, docs), asked, block_shingles=block_shingles)
    dirty = [d for d in docs if _contained([d], items)]
    assert sorted((r["doc_id"], r["text"]) for r in clean.collect()) == sorted(d for d in docs if d not in dirty)
    assert clean.columns == _df(spark, docs).columns


def test_containment_of_nothing(spark):
    docs = _df(spark, [(1, "a b")])
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontaminate.contained_items(docs.limit(0), items).count() == 0
    assert decontaminate.contained_items(docs, items.limit(0)).count() == 0
    assert decontaminate.decontaminate(docs, items.limit(0)).count() == 1


def _classes(docs, percent=80):
    sets = []
    for _, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        sets.append(_grams(w, 5) if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            o = len(sets[i] & sets[j])
            if o and 100 * o >= percent * (len(sets[i]) + len(sets[j]) - o):
                root[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(docs):
        ids = [docs[j][0] for j in range(len(docs)) if find(j) == find(i) and docs[j][0] is not None]
        out.append((doc, len(sets[i]), min(ids) if ids else None))
    return sorted(out, key=repr)


def _families(seed, n=25):
    """Families of near copies around the limit of similarity, with passages that many share."""
    rng = random.Random(seed)
    shared = words(40, 77)
    docs = []
    for f in range(n):
        base = words(rng.choice([3, 6, 12, 30, 60, 150]), 1000 * seed + f)
        for _ in range(rng.choice([1, 1, 2, 4])):
            own = edited(base, rng.choice([0, 0, 0.005, 0.01, 0.02, 0.03]), rng.random())
            if rng.random() < 0.4:
                at = rng.randrange(len(own))
                own[at:at] = shared
            docs.append(" ".join(own))
    return docs


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_classes_equal_all_pairs(spark, seed):
    cells = 1 if seed == 2 else 64 if seed == 3 else jaccard_tree.CELLS  # one cell: the order is that of hashes
    docs = list(enumerate(_families(seed), 10))
    docs += [(1, None), (2, ""), (3, " \n"), (4, "A b"), (5, "a  B\n"), (None, docs[0][1]), docs[3], docs[3], (6, docs[5][1].upper())]
    got = jaccard_tree.jaccard_classes(_df(spark, docs), cells=cells).select("doc_id", "n_shingles", "component_id")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == _classes(docs)


@pytest.mark.parametrize("size", [1, 3, 1000])
def test_meetings_keep_every_first_common_shingle(size):
    """Batches of any size; a row stays if and only if a plain search of its block finds a partner for it."""
    rng = random.Random(size)
    rows = sorted({(k, rng.choice([10, 11, 13, 20, 40, 50]), i) for k in range(40) for i in rng.sample(range(60), rng.randrange(1, 12))})
    rows = [(k, n, i, rng.randrange(0, n // 5 + 2)) for k, n, i in rows]
    table = pa.table({c: pa.array([r[j] for r in rows], pa.int64()) for c, j in (("key", 0), ("n", 1), ("set_id", 2), ("pos", 3))})
    got = [tuple(r.values()) for b in jaccard_tree._meetings(80)(iter(table.to_batches(max_chunksize=size))) for r in b.to_pylist()]
    want = []
    for i, (k, n, s, p) in enumerate(rows):
        early = lambda r: r[1] - r[3] >= -(-160 * r[1] // 180)
        before = [r for r in rows[:i] if r[0] == k and early(r) and 100 * r[1] >= 80 * n]
        after = [r for r in rows[i + 1 :] if r[0] == k and early(rows[i]) and 100 * n >= 80 * r[1]]
        if before or after:
            want.append((k, s, n, p, [r[2] for r in before]))
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert all((g[4] in w[4]) if w[4] else g[4] is None for g, w in zip(got, want))


def test_one_document_of_each_class_stays(spark):
    docs = list(enumerate(_families(4), 10)) + [(1, None), (2, ""), (2, ""), (None, "a b c")]
    docs += [docs[0], docs[0], (None, "A b c"), (7, docs[1][1])]
    df = _df(spark, docs)
    got = jaccard_tree.one_per_class(df)
    want = {c for d, n, c in _classes(docs) if n}
    kept = [r["doc_id"] for r in got.where("trim(text) <> ''").collect()]
    assert sorted(kept, key=repr) == sorted(want, key=repr)
    assert got.where("text is null or trim(text) = ''").count() == 3 and got.columns == df.columns


def test_classes_of_an_empty_table(spark):
    assert jaccard_tree.jaccard_classes(_df(spark, []).limit(0)).count() == 0
    assert jaccard_tree.jaccard_classes(_df(spark, [(1, None)])).first()["component_id"] == 1


def test_tree_finds_what_all_pairs_find(spark):
    """Blocks of several leaves and parents, with labels that hide some pairs."""
    rng = np.random.default_rng(3)
    rows, sets = [], {}
    for i in range(400):
        size = 400 if i < 40 else 140  # bitmaps of several widths
        base = np.random.default_rng(i // 4).integers(0, 1 << 63, size, dtype=np.uint64)
        own = np.unique(np.where(rng.random(size) < 0.05, rng.integers(0, 1 << 63, size, dtype=np.uint64), base))
        own = own[: int(rng.integers(size * 3 // 4, size + 1))]
        sets[i] = set(own.tolist())
        label = i // 2 if i % 8 < 2 else i
        rows.append((i % 2, i, len(own), 0, label, i % 8 < 2, bytearray(jaccard_tree.bitmap(own))))
    df = spark.createDataFrame(rows, "key long, set_id long, n int, pos int, label long, linked boolean, bitmap binary")
    got = {(r["a"], r["b"]) for r in jaccard_tree.tree_candidates(df, 80, Steps(spark)).collect()}
    for i in range(400):
        for j in range(i):
            o = len(sets[i] & sets[j])
            if i % 2 == j % 2 and rows[i][4] != rows[j][4] and 100 * o >= 80 * (len(sets[i] | sets[j])):
                assert (j, i) in got
    assert len(got) < 3000


def test_components(spark):
    rng = random.Random(8)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    links += [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(90)]
    links += [(b, a) for a, b in links[:20]]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r["id"]: r["label"] for r in comp.components(df).collect()}
    root = {x: x for e in links for x in e}
    for _ in range(400):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    assert got == {x: r for x, r in root.items() if any(x in e and e[0] != e[1] for e in links)}
    assert comp.components(df.limit(0)).count() == 0


def test_fenwick_chain_equals_a_plain_one():
    rng = random.Random(6)
    for _ in range(60):
        runs = np.array(sorted((rng.randrange(80), rng.randrange(80), rng.randrange(3, 9)) for _ in range(rng.randrange(2, 14))))
        best = [0.0] * len(runs)
        for i, (b, a, n) in enumerate(runs):
            best[i] = n + max(
                [0.0]
                + [
                    best[j] - passages.GAP_COST * (b - y - m + a - x - m)
                    for j, (y, x, m) in enumerate(runs)
                    if y + m <= b and x + m <= a
                ]
            )
        first = passages.chain(runs)[0]
        gaps = sum((v[0] - u[0] - u[2]) + (v[1] - u[1] - u[2]) for u, v in zip(first, first[1:]))
        assert abs(first[:, 2].sum() - passages.GAP_COST * gaps - max(best)) < 1e-9
        assert sum(len(c) for c in passages.chain(runs)) == len(runs)


def test_planted_passages_are_found(spark):
    rng = random.Random(11)
    planted = {p: words(rng.randrange(60, 120), 5000 + p, 10**6) for p in range(6)}
    docs, holds = [], {}
    for i in range(60):
        body = words(rng.randrange(120, 400), i, 10**6)
        p = i % 10
        if p in planted:
            at = rng.randrange(len(body))
            body[at:at] = edited(planted[p], 0.03 if i >= 30 else 0, i)
            holds[i] = p
        docs.append((i, " ".join(body)))
    docs += [(90, docs[7][1]), (91, docs[7][1]), (92, None), (93, ""), (None, docs[8][1]), (94, "short text")]
    got = passages.repeated_passages(_df(spark, docs)).collect()
    for p in planted:
        group = {i for i, q in holds.items() if q == p}
        found = [r for r in got if r["doc_id"] in group]
        # One text of the group keeps the passage, all others have it listed.
        assert len({r["doc_id"] for r in found}) == len(group) - 1
        assert {r["other_id"] for r in found} <= group
        for i in {r["doc_id"] for r in found}:
            own = [r for r in found if r["doc_id"] == i]
            covered = max(r["end_word"] for r in own) - min(r["start_word"] for r in own)
            assert abs(covered - len(planted[p])) <= 12, own
    rest = {r["doc_id"] for r in got} - set(holds)
    assert rest <= {7, 8, 90, 91, None} and len(rest) == 3
    assert {r["other_id"] for r in got if r["doc_id"] in (90, 91)} == {7}


def test_passages_are_cut(spark):
    passage = words(80, 1, 10**6)
    heads = [words(30, 10 + i, 10**6) for i in range(4)]
    docs = [(i, " ".join(h) + "\n\nÄ " + " ".join(passage) + " tail" + str(i) + " é") for i, h in enumerate(heads)]
    docs += [(9, " ".join(passage)), (10, None), (11, ""), (12, "clean  text\n")]
    df = _df(spark, docs)
    cut = passages.cut_passages(df)
    got = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert cut.columns == df.columns
    assert (got[10], got[11], got[12]) == (None, "", "clean  text\n")
    whole = " ".join(passage)
    assert sum(whole in (t or "") for t in got.values()) == 1
    for i, h in enumerate(heads):
        if whole not in got[i]:
            assert got[i].startswith(" ".join(h)) and got[i].endswith(f"tail{i} é") and len(got[i].split()) <= 36
    assert passages.cut_passages(df.limit(0)).count() == 0
    assert passages.repeated_passages(df.limit(0)).count() == 0


def test_a_passage_is_found_beside_texts_that_hold_its_halves(spark):
    """Texts 0 and 3 hold the first half, 1 and 4 the second, 2 and 5 all: no text before 5 but 2 has the passage."""
    rows = []
    for t in range(20):
        passage = words(64, 9000 + t, 10**6)
        parts = [passage[:32], passage[32:], passage] * 2
        for i, part in enumerate(parts):
            own = words(100, 100 * t + i, 10**6)
            rows.append((6 * t + i, " ".join(own[:50] + part + own[50:])))
    texts = spark.createDataFrame(rows, "node long, text string")
    got = passages.text_passages(texts, 50, 80, passages.K, passages.WINDOW, Steps(spark)).collect()
    whole = {(r["node"], r["other"]) for r in got if r["start_word"] <= 50 and r["end_word"] >= 114}
    assert whole == {(6 * t + 5, 6 * t + 2) for t in range(20)} and len(got) == 20


class _Counted(Steps):
    """Counts the rows of tables of chains."""

    def write(self, df, release=False):
        out = super().write(df, release)
        if "run_b" in df.columns:
            self.chains = [*getattr(self, "chains", []), out.count()]
        return out


def test_a_larger_family_lists_no_more_chains_a_text(spark):
    """A text has matches with ever more texts of its family; only chains that cover its words are listed."""
    family = words(1500, 77, 10**6)
    rows = [(i, " ".join(edited(family, 0.05, i))) for i in range(80)]
    listed = {}
    for n in (20, 80):
        steps = _Counted(spark)
        texts = spark.createDataFrame(rows[:n], "node long, text string")
        got = passages.text_passages(texts, 50, 80, passages.K, passages.WINDOW, steps).collect()
        listed[n] = sum(steps.chains) / n
        assert {r["node"] for r in got} == set(range(1, n)), "all but the first text hold a passage of another one"
    assert listed[80] <= 1.2 * listed[20] and listed[80] < 4, listed


def test_chains_to_spare_are_found_again_where_words_stay_open():
    """Text 9 has the same words in common with several texts, by 50 matched words each or by three short matches."""
    rows = [(9, a, at, at + 100 * a, 50) for a in range(1, 5) for at in (0, 40)]
    rows += [(9, 5, at, at, 6) for at in (20, 45, 70)] + [(9, 6, at, at, 6) for at in (60, 75, 90, 99)]
    rows += [(8, 7, 0, 0, 50)]
    rows.sort()
    batch = lambda x: pa.RecordBatch.from_pydict(dict(zip(("b", "a", "at_b", "at_a", "n"), map(list, zip(*x)))))
    listed = lambda x, spare: [
        r
        for part in passages._chains(6, 50, 50, spare)(iter([batch(x[:4]), batch(x[4:])]))
        for r in part.to_pylist()
    ]
    first = listed(rows, False)
    assert [(r["b"], r["a"]) for r in first] == [(8, 7), (9, 1), (9, 6)]
    assert first[0]["spares"] == [] and [s for r in first[1:] for s in r["spares"]] == [{"begin": 0, "end": 90}]
    known = lambda *spans: [(9, 9, begin, end, 0) for begin, end in spans]
    assert [r["a"] for r in listed(rows[1:], True)] == [2, 3, 4, 5]
    assert [r["a"] for r in listed(rows[1:] + known((0, 85)), True)] == []
    assert [r["a"] for r in listed(rows[1:] + known((0, 15), (25, 105)), True)] == [2, 3, 4]


def test_passages_with_other_words_between_them_are_parted():
    """Equally many other words stand between two passages, all on one diagonal."""
    rng = np.random.default_rng(5)
    own = lambda n: rng.integers(0, 1 << 60, n)
    for size, between in ((55, 35), (120, 35), (60, 100)):
        first, second = own(size), own(size)
        b, a = (np.concatenate([own(20), first, own(between), second, own(20)]) for _ in range(2))
        runs = np.array([[20, 20, 2 * size + between]])
        got = [x[:2] for x in passages.align(b, a, runs, 50, 80)]
        assert got == [(20, 20 + size), (20 + size + between, 20 + 2 * size + between)]
    # Neither half is a passage alone: they stay together.
    first, second = own(45), own(45)
    b, a = (np.concatenate([first, own(12), second]) for _ in range(2))
    assert [x[:2] for x in passages.align(b, a, np.array([[0, 0, 102]]), 50, 80)] == [(0, 102)]
