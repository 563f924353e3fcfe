"""Small made-up texts for the tests of the text operators."""

import random


def words(n, seed, vocabulary=4000):
    rng = random.Random(seed)
    return ["w%d" % rng.randrange(vocabulary) for _ in range(n)]


def text(n, seed, vocabulary=4000):
    return " ".join(words(n, seed, vocabulary))


def edited(words_, share, seed):
    rng = random.Random(seed)
    return ["x%d" % rng.randrange(10**6) if rng.random() < share else w for w in words_]
