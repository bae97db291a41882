"""Words are hashed many at once: the same words as by splitting, the same sets of shingles, in a fraction of the time."""

import random
import time

import numpy as np
import pyarrow as pa
import xxhash

from glossaflow.llm import jaccard_join

ODD = [None, "", " ", "a", "A", "a b", "a\x0bB", "\x1c\x85 x", "  y", "ab", "x" * 64, "x" * 65, "X" * 64 + " " + "y" * 200,
       "é" * 40, "日本" * 30 + " a", "a ", " a", "tail"]


def sets(texts, words):
    return jaccard_join._sets_of(pa.array(texts, pa.string()), words, jaccard_join._Words())


def plain(text, words):
    parts = text.encode().lower().split() if text else []
    span = min(words, len(parts))
    return {tuple(parts[i : i + span]) for i in range(len(parts) - span + 1)} if parts else set()


def test_sets_are_those_of_the_split_words():
    rnd = random.Random(3)
    texts = ODD + ["".join(rnd.choice("abAB  \t\n\x1cé 日") for _ in range(rnd.choice([1, 2, 9, 17, 70, 300])))
                   for _ in range(1500)]
    for words in (1, 3, 5):
        made, by_hash, by_words = sets(texts, words), {}, {}
        for text, values in zip(texts, made):
            want = plain(text, words)
            assert len(values) == len(want) and (np.diff(values.astype(object)) > 0).all()
            assert by_hash.setdefault(values.tobytes(), want) == want
            assert by_words.setdefault(frozenset(want), values.tobytes()) == values.tobytes()
        several = {s for text in texts for s in plain(text, words)}
        assert len(np.unique(np.concatenate(made))) == len(several)
        part = pa.array(["before", *texts, "after"], pa.large_string()).slice(1, len(texts))
        again = jaccard_join._sets_of(part, words, jaccard_join._Words())
        assert all((x == y).all() for x, y in zip(made, again))
    assert sets([], 3) == [] and [len(x) for x in sets([None, None], 3)] == [0, 0]


def test_words_are_not_looked_up_one_by_one():
    """New words by the thousand, as in real texts: a lookup and a hash per word took several times as long."""
    rnd = random.Random(5)
    texts = [" ".join(f"w{rnd.randrange(10**6)}" for _ in range(400)) for _ in range(400)]

    def word_by_word():
        known = {}
        for text in texts:
            parts = text.encode().lower().split()
            for part in parts:
                if part not in known:
                    known[part] = xxhash.xxh3_64_intdigest(part)
            np.fromiter(map(known.__getitem__, parts), np.uint64, len(parts))

    known = jaccard_join._Words()
    column = pa.array(texts)
    data, offsets = np.frombuffer(column.buffers()[2], np.uint8), np.frombuffer(column.buffers()[1], np.int32).astype(np.int64)

    def seconds(function):
        began = time.process_time()
        function()
        return time.process_time() - began

    ours = min(seconds(lambda: jaccard_join._word_codes(data, offsets, known)) for _ in range(3))
    assert not known and ours < min(seconds(word_by_word) for _ in range(3))
