"""Order counts in texts of every length, and edits stay local in texts without spaces."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from glossaflow.llm import order_minhash


def near(spark, pairs):
    frame = spark.createDataFrame(pairs, "a string, b string")
    marked = order_minhash.with_signatures(frame, {"x": "a", "y": "b"})
    return marked.agg(F.avg(order_minhash.likeness("x", "y"))).first()[0]


def separate(pairs, selections=64):
    """Mean likeness of selections of two elements by as many hashes."""

    def signatures(text):
        words, seen, elements = text.split(), {}, []
        for place in range(max(1, len(words) - order_minhash.K + 1)):
            kmer = " ".join(words[place : place + order_minhash.K])
            seen[kmer] = seen.get(kmer, -1) + 1
            elements.append((f"{kmer} {seen[kmer]}", place))
        for seed in range(selections):
            least = sorted(elements, key=lambda e: xxhash.xxh3_64_intdigest(e[0], seed))[:2]
            yield tuple(e for e, _ in sorted(least, key=lambda e: e[1]))

    return sum(sum(x == y for x, y in zip(signatures(a), signatures(b))) / selections for a, b in pairs) / len(pairs)


@pytest.mark.parametrize("n", [20, 80, 400])
def test_swapped_halves_are_as_unlike_as_by_separate_selections(spark, n):
    r = random.Random(n)
    texts = [[f"w{r.randrange(10**6)}" for _ in range(n)] for _ in range(60)]
    pairs = [(" ".join(t), " ".join(t[n // 2 :] + t[: n // 2])) for t in texts]
    measured, exact = near(spark, pairs), separate(pairs)
    print(n, round(measured, 2), round(exact, 2))
    assert abs(measured - exact) < 0.1


@pytest.mark.parametrize("letters", ["".join(map(chr, range(0x4E00, 0x5000))), "abcdefghijklmnopqrstuvwxyz"])
def test_a_character_before_a_text_without_spaces(spark, letters):
    r = random.Random(3)
    texts = ["".join(r.choices(letters, k=400)) for _ in range(20)]
    assert near(spark, [(t, letters[0] + t) for t in texts]) > 0.9
    assert near(spark, [(a, b) for a, b in zip(texts, texts[1:])]) < 0.1
