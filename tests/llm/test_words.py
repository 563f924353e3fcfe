import random
import re

import numpy as np
import pyarrow as pa

from vejrkraft.llm.words import PLAIN, chunks, shingle_sets, shingles, words_of

TEXTS = [None, "", " \t\n", "a", "B b\u00a0b", "a  b\tc\nd\x0be\x0cf\rg", "é É ß\x1cx", "x" * 5000, "a b a b a b"]


def _by_hash(groups):
    """Equal things have equal hashes and other things others."""
    seen, back = {}, {}
    for thing, h in groups:
        assert seen.setdefault(thing, h) == h
        assert back.setdefault(h, thing) == thing


def test_words_are_those_of_the_pattern():
    for lower in (True, False):
        got = words_of(pa.array(TEXTS), lower=lower)
        pairs = []
        for i, t in enumerate(TEXTS):
            t = t or ""
            t = re.sub("[A-Z]", lambda m: m.group().lower(), t) if lower else t
            want = re.findall(r"[^\x20\x09-\x0D]+", t)
            own = got.hash[got.first[i] : got.first[i + 1]].tolist()
            assert len(own) == len(want)
            pairs += zip(want, own)
        _by_hash(pairs)


def test_plain_words_leave_punctuation():
    got = words_of(pa.array(['He said, "No-one" (x).']), PLAIN)
    want = words_of(pa.array(["he said no one x"]), PLAIN)
    assert got.hash.tolist() == want.hash.tolist()


def test_slices_and_shingles():
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randrange(0, 12))) for _ in range(300)]
    batch = pa.RecordBatch.from_pydict({"text": texts}).slice(7, 250)
    pairs, n = [], 0
    for part in chunks([batch], "text", 64):
        runs, each = shingles(words_of(part.column("text")), 5)
        place = np.concatenate([[0], np.cumsum(each)])
        sets = list(shingle_sets(words_of(part.column("text")), 5))
        for i in range(part.num_rows):
            w = texts[7 + n].split()
            n += 1
            want = [tuple(w[j : j + 5]) for j in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else []
            own = runs[place[i] : place[i + 1]].tolist()
            assert len(own) == len(want) and len(sets[i]) == len(set(want))
            pairs += zip(want, own)
    assert n == 250
    _by_hash(pairs)
