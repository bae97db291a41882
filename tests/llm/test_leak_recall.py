"""Leaks by passages, with insertions, and at every rate of substitution, against a scan of all places."""

import random

import pytest

from glossaflow.llm.decontamination import Block


def leaks(items, texts):
    return {(t, i): (begin, equal) for t, i, begin, equal in Block.of(list(enumerate(items))).find([" ".join(t) for t in texts])}


def words(random_, n, vocabulary=5000):
    return [f"w{random_.randrange(vocabulary)}" for _ in range(n)]


@pytest.mark.parametrize("n, changed", [(8, 1), (8, 3), (15, 3), (15, 4), (15, 5), (15, 6), (20, 6), (20, 7), (20, 8),
                                        (30, 12), (60, 24)])
def test_every_substituted_item_is_found(n, changed):
    r = random.Random(n * 100 + changed)
    items, texts = [words(r, n) for _ in range(40)], []
    for item in items:
        copy = list(item)
        for place in r.sample(range(n), changed):
            copy[place] = "other"
        texts.append(words(r, 30) + copy + words(r, 30))
    found = leaks(items, texts)
    scan = {}
    for t, text in enumerate(texts):
        for i, item in enumerate(items):
            equal, begin = min((-sum(a == b for a, b in zip(item, text[s:])), s) for s in range(len(text) - n + 1))
            if -equal >= 0.6 * n:
                scan[t, i] = begin, -equal
    assert len(scan) >= 40 and {k: found.get(k) for k in scan} == scan


def test_passages_insertions_and_deletions():
    r = random.Random(7)
    items = [words(r, 59), words(r, 16), words(r, 16), words(r, 40)]
    one, two, three, four = items
    texts = [words(r, 9) + one[15:45] + words(r, 9), words(r, 5) + two[:8] + ["new"] + two[8:] + words(r, 5),
             three[:8] + three[9:], words(r, 5) + four[10:22] + words(r, 5), words(r, 5) + one[:6] + words(r, 50)]
    found = leaks(items, texts)
    assert found == {(0, 0): (-6, 30), (1, 1): (5, 16), (2, 2): (0, 15)}


def test_repeated_words_and_edges():
    assert leaks([["a"] * 8], [["a"] * 5000, ["a"] * 5]) == {(0, 0): (0, 8), (1, 0): (-3, 5)}
    assert leaks([["a", "b", "c", "d"]], [["a", "b", "c", "x"], ["x", "a", "b", "c", "d"]]) == {(1, 0): (1, 4)}
