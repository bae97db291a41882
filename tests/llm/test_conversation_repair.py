"""Repair against a plain dynamic program over whole audits, on damaged, random and degenerate conversations."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from glossaflow.llm.conversation_repair import BlockTable, Costs, repair
from glossaflow.llm.queries import damaged, op12_conversation_repair

NAMES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
_AFTER = {"": "su", "s": "u", "u": "a", "a": "u"}


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        lot = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if lot == 4:
            role = "user"
        text = "" if lot == 1 else re.sub("[.!?]", "", text) if lot == 2 else text
        out += [(conv, turn, role, text)] * (0 if lot == 0 else 2 if lot == 3 else 1)
    return out


def plain(rows, costs=Costs()):
    """Summary of one conversation's rows, already in order, by a table of (cost, audit, messages) per state."""
    faults = {"blank": 0, "duplicate": 0, "truncated": 0}
    signs, seen = [], set()
    for _, role, text in rows:
        last = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = ("blank" if not last else "duplicate" if (role, text) in seen else
                 "truncated" if last[-1] not in ".!?" else None)
        seen.add((role, text))
        if fault:
            faults[fault] += 1
        signs.append(fault)
    pairs = zip(rows, rows[1:])
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairs)
    turns = [t for t, _, _ in rows if t is not None]

    def better(table, state, entry):
        if state not in table or entry[:2] < table[state][:2]:
            table[state] = entry

    def inserts(table):
        for _ in range(3):
            for state, (cost, audit, out) in list(table.items()):
                for to in _AFTER[state]:
                    if to != "s":
                        name = {"u": "user", "a": "assistant"}[to]
                        better(table, to, (cost + costs.insert, audit + "I", [*out, (name, "")]))

    # prefixes in order of cost, then audit: of equal length and cost, a smaller prefix never makes a larger whole
    now = {"": (0, "", [])}
    inserts(now)
    for (_, role, text), fault in zip(rows, signs):
        then = {}
        for state, (cost, audit, out) in now.items():
            better(then, state, (cost + costs.delete, audit + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            extra = costs.truncated * (fault == "truncated")
            if role[:1] and role[:1] in _AFTER[state]:
                better(then, role[0], (cost + extra, audit + "K", [*out, (role, text)]))
            for name in ("user", "assistant"):
                if name[0] in _AFTER[state]:
                    better(then, name[0], (cost + extra + costs.rerole, audit + "R", [*out, (name, text)]))
        inserts(then)
        now = then
    cost, audit, out = min((now[s] for s in ("", "a") if s in now), key=lambda e: e[:2])
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    said = "\n".join(f"{r}:{t}" for r, t in out)
    return (gaps, *faults.values(), illegal, cost, audit, hashlib.sha256(said.encode()).hexdigest()), out


def order(row):
    turn, role, text = row
    return turn is not None, turn or 0, role.encode(), text.encode()


def brute_force(ids, rows, costs=Costs()):
    found = {i: [] for i in ids}
    for conv, turn, role, text in rows:
        found[conv].append((turn, *(" " if v is None else v for v in (role, text))))
    return {conv: plain(sorted(mine, key=order), costs) for conv, mine in found.items()}


def collected(summary):
    rows = summary.select("conv_id", *NAMES).collect()
    assert len(rows) == len({r["conv_id"] for r in rows})
    return {r["conv_id"]: tuple(r)[1:] for r in rows}


@pytest.mark.parametrize("costs", [Costs(), Costs(1, 9, 2, 3), Costs(2, 7, 1, 1), Costs(0, 1, 1, 0)])
@pytest.mark.parametrize("block", [1, 3, 4])
def test_tables_against_all_edits(costs, block):
    """Lookups, traces and matrices of all short sequences of symbols, with inserts that pay as well."""
    table = BlockTable(costs, block)
    texts = {0: "", 1: "x", 2: "x."}
    dice = random.Random(4)
    choices = list(itertools.product("suao", (0, 1, 2)))
    sequences = [[dice.choice(choices) for _ in range(dice.randrange(0, 13))] for _ in range(150)]
    for sequence in sequences:
        rows = [(i, role, texts[kind] and f"{i}{texts[kind]}") for i, (role, kind) in enumerate(sequence)]
        (*_, cost, audit, _), _ = plain(rows, costs)
        signs = np.array([0 if k == 0 else 1 + 2 * "suao".index(r) + (k == 1) for r, k in sequence], np.int64)
        _, v, total = table.borders(signs, table.end)
        initials, _, state = table.trace(signs, table.end, 0)
        assert total + table.vectors[v][0] == cost
        assert "".join(initials) + table.close(state)[0] == audit
        cut = dice.randrange(len(sequence) + 1)
        end = np.array(table.with_inserts((0, 1 << 40, 1 << 40, 0)))
        behind = (table.matrix(signs[cut:]) + end).min(axis=1)
        assert (table.matrix(signs[:cut]) + behind).min(axis=1)[0] == cost


def test_given_conversations(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = brute_force({r[0] for r in rows}, damage(rows))
    assert collected(op12_conversation_repair(spark, sf_dir)) == {c: s for c, (s, _) in want.items()}


def random_rows(seed, conversations, turns):
    dice = random.Random(seed)
    roles = ["user"] * 6 + ["assistant"] * 6 + ["system", "tool", "", None, "s", "ärger"]
    texts = ["Yes.", "No!", "why", " \t\n", "", None, " ", " .", "a\x00b?", "more . ", "end\x0b", "　!"]
    return [(dice.choice([*range(conversations), None]), dice.choice([None, *range(turns)]), dice.choice(roles),
             dice.choice(texts) if dice.random() < 0.5 else f"text {dice.randrange(99)}" + dice.choice([".", "", "?"])) for _ in range(conversations * turns)]


@pytest.mark.parametrize("partitions", [1, 4, 40])
def test_conversations_cut_into_chunks(spark, partitions):
    """One conversation holds half of all rows; with many partitions most conversations lie at a border."""
    rows = random_rows(partitions, 12, 20) + [(77, i % 150, "user" if i % 2 else "assistant", f"m{i % 97}.") for i in range(250)]
    rows += [(88, 5, "user", "again.")] * 120
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        summary, messages = repair(damaged(frame), messages=True)
        want = brute_force({r[0] for r in rows}, damage(rows))
        assert collected(summary) == {c: s for c, (s, _) in want.items()}
        said = {}
        for r in sorted(messages.collect(), key=lambda r: (r["chunk"], r["line"])):
            said.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
        assert said == {c: out for c, (_, out) in want.items() if out}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_inserts_across_chunks(spark):
    """Costs by which inserting pays, also behind the last row."""
    costs = Costs(3, 9, 1, 0)
    rows = [(1, i, "user", f"q{i}.") for i in range(40)] + [(2, i, "system", f"s{i}.") for i in range(3)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    spark.conf.set("spark.sql.shuffle.partitions", 9)
    try:
        summary, _ = repair(frame, costs)
        assert collected(summary) == {c: s for c, (s, _) in brute_force({1, 2}, rows, costs).items()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_other_columns_and_no_rows(spark):
    frame = spark.createDataFrame([("a", 1, "user", "Hi.", 3, True), ("a", 2, "assistant", "Yes.", 4, None)],
                                  "conv_id string, turn int, role string, text string, n int, message boolean")
    (row,) = repair(frame)[0].collect()
    assert (row["conv_id"], row["cost"], row["audit"]) == ("a", 0, "KK")
    assert row["repaired_sha256"] == hashlib.sha256(b"user:Hi.\nassistant:Yes.").hexdigest()
    assert repair(frame.limit(0))[0].count() == 0
    gone = frame.withColumn("copies", F.lit(0))
    (row,) = repair(gone)[0].collect()
    assert tuple(row)[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
