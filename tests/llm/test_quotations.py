"""Quotations against a plain linker, and the cases of quoting that need every part of the method."""

import random
import re
from collections import Counter, defaultdict

import pytest

from glossaflow.llm import quotations

SCHEMA = "conv_id long, turn long, role string, text string"


def norm(text):
    return re.sub(r"\s+", " ", text).strip(" ").lower()


def plain_passages(text):
    """(level, first line, passage) of a text."""
    found, current = [], None
    for n, line in enumerate(re.split(r"\r?\n", text or "")):
        marks = re.match(r"^\s*(?:>\s?)+", line)
        level, body = (marks[0].count(">"), line[marks.end() :]) if marks else (0, line)
        if current is None or level != current[0] or not body.strip(" "):
            current = [level, n, body]
            found.append(current)
        else:
            current[2] += "\n" + body
    return [(level, n, norm(body)) for level, n, body in found if norm(body)]


def plain_parts(text):
    for level, n, passage in plain_passages(text):
        yield level, n, True, passage
        sentences = re.split(r"(?<=[.!?])\s", passage)
        if len(sentences) > 1:
            for sentence in sentences:
                yield level, n, False, sentence


def plain_chat(rows):
    said = defaultdict(lambda: defaultdict(set))
    for conv, turn, _, text in rows:
        for level, _, _, part in plain_parts(text):
            if level == 0:
                said[part][conv].add(turn)
    replies = {}
    for conv, turn, _, text in rows:
        by_passage = defaultdict(lambda: [None, 0])
        for level, n, whole, part in plain_parts(text):
            if not level or part not in said:
                continue
            here = min(said[part].get(conv, {turn}))
            others = [c for c in (min(said[part]), max(said[part])) if c != conv]
            to = (conv, here) if here < turn else (others[0], min(said[part][others[0]])) if others else None
            if to and whole:
                by_passage[level, n, to][0] = len(part)
            elif to:
                by_passage[level, n, to][1] += len(part)
        links = defaultdict(lambda: [0, 0])
        for (level, _, to), (whole, sentences) in by_passage.items():
            links[-level, to][0] += whole or 0
            links[-level, to][1] += sentences if whole is None else whole
        if links:
            replies[conv, turn] = max(links, key=lambda k: (k[0], *links[k], -k[1][0], -k[1][1]))[1]
    out, parent = {}, {}
    for (conv, turn), (to, _) in sorted(replies.items()):
        if to != conv:
            parent.setdefault(conv, to)
    names = {conv: conv for conv, *_ in rows}
    for _ in names:
        for (conv, _), (to, _) in replies.items():
            names[conv] = names[to] = min(names[conv], names[to])
    for conv in names:  # circles start at their smallest id
        way, at = [], conv
        while at in parent and at not in way:
            way.append(at)
            at = parent[at]
        if at in parent:
            parent.pop(min(way[way.index(at) :]))
    for conv, turn, *_ in rows:
        depth, at = 0, conv
        while at in parent:
            depth, at = depth + 1, parent[at]
        before = max((t for c, t, *_ in rows if c == conv and t < turn), default=None)
        to = replies.get((conv, turn)) or ((conv, before) if before is not None else (None, None))
        out[conv, turn] = (names[conv], depth, *to)
    return out


def linked(spark, rows, parts=3):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return quotations.chat_messages(frame).collect()


def places(rows):
    return {(r["conv_id"], r["turn"]): (r["thread_id"], r["depth"], r["reply_to_conv"], r["reply_to_turn"]) for r in rows}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_a_plain_linker(spark, seed):
    lot = random.Random(seed)
    sentence = lambda: " ".join(lot.choices(["ab", "cd", "EF", "gh"], k=lot.choice([1, 2, 3]))) + lot.choice(".!?")
    rows = []
    for conv in lot.sample(range(40), 14):
        for turn in sorted(lot.sample(range(9), lot.randint(1, 4))):
            lines = []
            for _ in range(lot.randint(0, 3)):
                old = lot.choice(rows)[3].split("\n") if rows and lot.random() < 0.5 else [sentence() + " " + sentence()]
                quoted = lot.random() < 0.5
                lines += [("> " * lot.choice([1, 1, 2, 3]) if quoted else "") + line for line in old] + [""] * lot.choice([0, 1])
            rows.append((conv, turn, "user", "\n".join(lines)))
    assert places(linked(spark, rows)) == plain_chat(rows)
    assert any(to != conv and to is not None for (conv, _), (_, _, to, _) in plain_chat(rows).items())


def test_levels_parts_circles_gaps_and_control_characters(spark):
    rows = [(3, 0, "user", "Alpha beta gamma. Delta epsilon."), (9, 0, "user", "Zeta eta\u0000theta\u0001."),
            (3, 4, "user", "> > zeta ETA\u0000theta\u0001.\nyes"),          # a deeper level only, out to a larger id
            (3, 7, "user", "nothing quoted"),                              # the turn before is 4, not 6
            (9, 2, "user", "> Delta epsilon.\nagreed"),                    # one sentence of a paragraph; a circle
            (12, 0, "user", "> agreed\nso do I"), (20, 5, "user", "alone"), (20, None, "user", "> alone"),
            (None, 1, "user", "> alone"), (20, 5, "user", "alone")]
    rows = linked(spark, rows)
    found = places(rows)
    assert len(rows) == 10 and Counter(r["conv_id"] for r in rows)[20] == 3
    assert found[3, 4] == (3, 0, 9, 0) and found[9, 2] == (3, 1, 3, 0) and found[12, 0] == (3, 2, 9, 2)
    assert found[3, 7] == (3, 0, 3, 4) and found[3, 0] == (3, 0, None, None)
    assert found[20, 5] == (20, 0, None, None) and found[20, None] == (20, 0, None, None)
    assert found[None, 1] == (None, 0, None, None)


def test_deeper_levels_are_links_too(spark):
    rows = [(1, 0, "user", "First."), (1, 1, "user", "> First.\nSecond."), (1, 2, "user", "> Second.\n> > First.\nThird.")]
    links = quotations.quote_links(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["turn"], r["level"], r["to_turn"]) for r in links) == [(1, 1, 0), (2, 1, 1), (2, 2, 0)]
    assert quotations.quote_links(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_common_quote_and_a_long_chain(spark):
    rows = [(0, 0, "user", "Thanks a lot.")] + [(i, 1, "user", "> Thanks a lot.") for i in range(1, 300)]
    rows += [(1000 + i, 0, "user", f"> number {i - 1}.\nNumber {i}.") for i in range(40)]
    found = places(linked(spark, rows))
    assert all(found[i, 1] == (0, 1, 0, 0) for i in range(1, 300))
    assert [found[1000 + i, 0][:2] for i in range(40)] == [(1000, i) for i in range(40)]


def test_very_long_texts(spark):
    text = "\n".join(f"line {i}" + ("\n" if i % 7 == 0 else "") for i in range(60000))
    quote = "> line 59998\n> line 59999"
    found = places(linked(spark, [(1, 0, "user", text), (1, 1, "user", quote.replace("> line 59998\n", ""))]))
    assert found[1, 1][2:] == (1, 0)
