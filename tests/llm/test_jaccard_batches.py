"""What the join hands to scans and workers at once is small, and its settings end with it."""

from collections import Counter

from glossaflow import scratch
from glossaflow.llm import jaccard_join

SCAN, WORKERS = scratch.BATCH_SETTINGS


def test_batches_are_small_while_the_join_runs(spark, monkeypatch):
    seen, write = set(), jaccard_join.stage

    def watched(df, name, folder=None):
        seen.add((spark.conf.get(SCAN), spark.conf.get(WORKERS)))
        return write(df, name, folder)

    monkeypatch.setattr(jaccard_join, "stage", watched)
    before = spark.conf.get(SCAN), spark.conf.get(WORKERS)
    try:
        spark.conf.set(WORKERS, "100")
        jaccard_join.jaccard_classes(spark.createDataFrame([(1, "a b c d")], "doc_id long, text string"), 3, 90, 100)
        assert seen == {("512", "100")}
        assert (spark.conf.get(SCAN), spark.conf.get(WORKERS)) == (before[0], "100")
    finally:
        spark.conf.set(WORKERS, before[1])


def test_reports_in_parts_are_whole(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "_REPORTED", 4)
    rows = [" ".join(f"w{(i * k) % 23}" for i in range(12)) for k in range(1, 9)] + [None, "", "one two", "w1 w2 w3", "w1 w2 w3"]
    found = jaccard_join._frequencies(spark.createDataFrame([(r,) for r in rows], "text string").coalesce(1), 3, 90, 100)
    sets = {jaccard_join._name(s): s for s in (jaccard_join.shingles(r, 3, jaccard_join._Words()) for r in rows) if len(s)}
    counts = Counter(int(v) for s in sets.values() for v in s.view("int64"))
    want = {(0, v, n) for v, n in counts.items() if n > 1} | {(3, -1, 1)}
    for s in sets.values():
        front = jaccard_join.front_length(len(s), 90, 100)
        least = sorted(counts[v] for v in s.view("int64").tolist())[:front]
        want |= {("sets", front, len([x for x in sets.values() if jaccard_join.front_length(len(x), 90, 100) == front]))}
        want |= {("pairs", front, s.tobytes(), sum(n - 1 for n in least))}
    pairs = Counter()
    for row in (w for w in want if w[0] == "pairs"):
        pairs[row[1]] += row[3]
    want = {w for w in want if w[0] in (0, 3)} | {(2, w[1], w[2]) for w in want if w[0] == "sets"} | {(1, f, n) for f, n in pairs.items()}
    assert {tuple(r) for r in found.collect()} == want
