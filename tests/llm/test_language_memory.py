"""Training language models on the driver: the memory it takes, and that its parts make one model."""

import tracemalloc
from itertools import product

import numpy as np

from glossaflow.llm import language_id


def test_memory_does_not_grow_with_the_characters():
    counts = {(language, "".join(word)): 1 for language in ("one", "two") for word in product("abcd", repeat=8)}
    tracemalloc.start()
    language_id.Models.train(counts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80e6, peak  # 131,072 words are 1.3 million characters with blanks; a hash of each, by six lengths, is 63 MB


def test_parts_make_the_same_models(monkeypatch):
    words = ["abab", "ba", "cab", "zürich", "日本語", "a", "abcabcabc", "xyz"]
    counts = {(language, word): 1 + i for language in "abc" for i, word in enumerate(words) if (i + ord(language)) % 3}
    whole = language_id.Models.train(counts)
    monkeypatch.setattr(language_id, "_WORDS_AT_ONCE", 3)
    parts = language_id.Models.train(counts)
    assert parts.languages == whole.languages == ["a", "b", "c"] and parts.floor == whole.floor
    for name in ("grams", "log_probs", "contexts", "log_weights"):
        assert all(np.array_equal(x, y) for x, y in zip(getattr(parts, name), getattr(whole, name), strict=True))
