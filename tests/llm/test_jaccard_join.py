"""The join against brute force over all pairs, on texts with copies, near copies and edge cases."""

import random
import re

import pytest

from glossaflow.llm import jaccard_join
from glossaflow.llm.components import connected_components

_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_force(rows, words, num, den):
    sets = []
    for doc, text in rows:
        found = _WORDS.findall((text or "").translate(_LOWER))
        sets.append((doc, {tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1))} if found else set()))
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            one, two = sets[a][1], sets[b][1]
            shared = len(one & two)
            if one and two and shared * den >= num * (len(one) + len(two) - shared):
                parent[root(a)] = root(b)
    least = {}
    for i, (doc, _) in enumerate(sets):
        least[root(i)] = min(least.get(root(i), doc), doc)
    return sorted((doc, len(s), least[root(i)]) for i, (doc, s) in enumerate(sets))


def texts():
    dice = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)] + ["É", "straße", "日本"]
    rows = []
    shared = [dice.choice(vocabulary) for _ in range(30)]
    for size in (1, 2, 3, 4, 6, 9, 12, 15, 22, 40, 80, 160, 300):
        for _ in range(3):
            base = [dice.choice(vocabulary) for _ in range(size)]
            for changes in (0, 0, 1, 1, 2, 3, 5):
                copy = list(base)
                for _ in range(changes):
                    copy[dice.randrange(size)] = dice.choice(vocabulary)
                if dice.random() < 0.2 and size > 100:
                    copy += shared
                rows.append(" ".join(copy))
    rows += [None, "", " \t\n", None, "A b C", "a B c", "É b", "é b"]
    order = list(range(len(rows)))
    dice.shuffle(order)
    return [(10 * i, rows[n]) for i, n in enumerate(order)]


@pytest.mark.parametrize("words, num, den", [(3, 90, 100), (5, 8, 10)])
def test_equals_brute_force(spark, words, num, den):
    rows = texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = jaccard_join.jaccard_classes(docs, words, num, den)
    assert sorted(tuple(r)[:3] for r in found.collect()) == brute_force(rows, words, num, den)


def test_subsets_and_lists_agree(spark, monkeypatch):
    rows = texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(jaccard_join, "choose_front", lambda counts: 3)
    found = jaccard_join.jaccard_classes(docs, 3, 90, 100)
    assert sorted(tuple(r)[:3] for r in found.collect()) == brute_force(rows, 3, 90, 100)


def test_empty_table_repeated_rows_and_columns_of_any_name(spark):
    schema = "doc_id long, text string, node int, front string, `n` int"
    none = spark.createDataFrame([], schema)
    assert jaccard_join.one_per_class(none).collect() == []
    rows = [(1, "a b c d e f", 0, "x", 1), (1, "a b c d e f", 0, "x", 1), (2, "a b c d e f", 9, None, 2), (3, None, 1, "", 3),
            (4, None, 1, "", 3)]
    kept = jaccard_join.one_per_class(spark.createDataFrame(rows, schema))
    assert sorted(kept.columns) == sorted(["doc_id", "text", "node", "front", "n"])
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4]


def test_exactly_one_row_of_each_class_stays(spark, tmp_path):
    """Null ids, rows repeated with their id, one id with two texts, and rows without words."""
    near = " ".join(f"w{i}" for i in range(60))
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, near), (2, near + " x"),
            (2, "other words here now then so"), (None, "only one without an id"), (None, "only one without an id"),
            (5, ""), (5, ""), (None, None), (7, near)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.repartition(4).write.parquet(str(tmp_path / "docs"))
    want = sorted([(1, "a b c d e f"), (2, "other words here now then so"), (None, "only one without an id"), (5, ""), (5, ""),
                   (None, None)], key=repr)
    for kept in (jaccard_join.one_per_class(docs),
                 jaccard_join.one_per_class(spark.read.parquet(str(tmp_path / "docs")), scan=True)):
        found = [tuple(r) for r in kept.collect()]
        (close,) = [r for r in found if r[1] and r[1].startswith("w0")]
        assert close[0] == 2 and sorted((r for r in found if r != close), key=repr) == want


def test_components_of_chains_and_circles(spark):
    links = [(i, i + 1) for i in range(0, 20)] + [(50, 40), (40, 45), (45, 50)] + [(7, 7)]
    found = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(21)}, 40: 40, 45: 40, 50: 40}
