"""Repair of conversations: the cheapest edits that give roles ``(s?(ua)+)?``, by Four-Russians block tables.

A row is one of nine symbols: it must be deleted, or it has one of four role kinds (system, user, assistant, other) and
is truncated or not. The state is the last role that stays. A cost vector holds, for each of the four states, what the
rest of the conversation costs from there. Less their least entry, only few cost vectors are possible; the table holds,
for each of them and each block of ``BLOCK`` symbols, the vector in front of the block and the cost it adds. A
conversation is worked through from its end, block by block, each by one lookup. Then the edits are read from its start:
each block is expanded backward from the vector behind it, which gives the cost vectors inside, and of the edits that
stay on a cheapest way the one whose initial is least in ASCII is taken. An edit's initial and the state before it
determine the state after it, so this is the least of all cheapest audits.

Spark sorts the rows: equal rows of a turn are combined to one with a number, the rest is range-partitioned by
conversation, turn, role and text, so a conversation of any size is cut into even chunks. Conversations inside one chunk
are finished there. Those at a chunk's borders take four further steps, each on one row per conversation and chunk: texts
seen in an earlier chunk are found by a join of one row per chunk and text; a chunk's rows become a four by four matrix of
costs (the same lookups, begun from each state); the chunks of a conversation pass their vectors on, from the last to the
first; a chunk is then traced from each state, and the states are passed on from the first to the last.

Memory: a task holds the rows of one conversation within one chunk, and one matrix per chunk of a conversation. The audit
of a conversation is one value by contract. SHA-256 reads its text in order, so the texts of a conversation that exceeds a chunk
are streamed through one task, which holds one batch of them. Losing an executor repeats tasks of one step.

Results: one summary per conversation that has a row, a null id being a conversation too, and rows that occur ``copies`` times
(0: the conversation is known, but this row is not there). Null roles and texts count as one space. Rows are taken by
turn, nulls first, then role and text. Repeated rows are duplicates of each other. Roles are told apart by their first
character; an empty role is of the other kind. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossaflow.llm.common import worker_state
from glossaflow.scratch import stage

BLOCK = 4
KINDS = "sua"
NAMES = {"u": "user", "a": "assistant"}
WHITE = " \t\n\x0b\x0c\r"
# Leading characters of a text by which rows are ranged; the driver sees samples of them.
RANGE_CHARS = 256
_FAR = 1 << 40
_MUST_GO = 0
_SYMBOLS = 9
# State after a role: none, system, user, assistant; the pattern's end is allowed after the first and the last.
_AFTER = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
_END = (0, _FAR, _FAR, 0)

SUMMARY = (
    "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, "
    "repaired_sha256 string"
)


@dataclass(frozen=True)
class Costs:
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5


def symbol(kind: int, truncated: bool) -> int:
    """Of a row that may stay; ``kind`` is its place in :data:`KINDS`, or 3."""
    return 1 + 2 * kind + truncated


@dataclass
class BlockTable:
    """All normalised cost vectors, and what one symbol or one block of symbols makes of them."""

    costs: Costs
    block: int = BLOCK
    vectors: list[tuple] = field(default_factory=list)
    known: dict = field(default_factory=dict)

    def __post_init__(self):
        self.end = self.add(self.with_inserts(_END))
        self.unit = [self.add(tuple(0 if s == b else _FAR for s in range(4))) for b in range(4)]
        steps = []
        for v in self.vectors:  # grows as new vectors turn up
            steps.append([self.normalised(self.before(s, v)) for s in range(_SYMBOLS)])
        self.to = np.array([[t for t, _ in row] for row in steps])
        self.cost = np.array([[c for _, c in row] for row in steps])
        self.block_to, self.block_cost = self.to, self.cost
        for _ in range(self.block - 1):
            # one more symbol in front of all shorter blocks
            self.block_cost = np.stack([self.cost[self.block_to, s] + self.block_cost for s in range(_SYMBOLS)], 1)
            self.block_to = np.stack([self.to[self.block_to, s] for s in range(_SYMBOLS)], 1)
            self.block_cost = self.block_cost.reshape(len(self.to), -1)
            self.block_to = self.block_to.reshape(len(self.to), -1)
        self.traced: dict = {}

    def add(self, vector: tuple) -> int:
        if vector not in self.known:
            self.known[vector] = len(self.vectors)
            self.vectors.append(vector)
        return self.known[vector]

    def normalised(self, vector: tuple) -> tuple[int, int]:
        least = min(vector)
        return self.add(tuple(c - least if c < _FAR else _FAR for c in vector)), least

    def with_inserts(self, vector: tuple) -> tuple:
        best = list(vector)
        for _ in range(4):
            for s in range(4):
                for role in NAMES:
                    if role in _AFTER[s]:
                        best[s] = min(best[s], self.costs.insert + best[_AFTER[s][role]])
        return tuple(min(c, _FAR) for c in best)

    def edits(self, sign: int, state: int, after: tuple) -> Iterator[tuple[str, str, int, int]]:
        """``(initial, role, next state, cost to the end)`` of each edit of a row, in ASCII order of the initials."""
        yield "D", "", state, self.costs.delete + after[state]
        if sign == _MUST_GO:
            return
        kind, truncated = divmod(sign - 1, 2)
        extra = truncated * self.costs.truncated
        own = KINDS[kind] if kind < 3 else ""
        if own in _AFTER[state]:
            yield "K", own, _AFTER[state][own], extra + after[_AFTER[state][own]]
        for role in NAMES:
            if role in _AFTER[state]:
                yield "R", role, _AFTER[state][role], extra + self.costs.rerole + after[_AFTER[state][role]]

    def before(self, sign: int, vector: tuple) -> tuple:
        return self.with_inserts(tuple(min(e[3] for e in self.edits(sign, s, vector)) for s in range(4)))

    def borders(self, signs: np.ndarray, last: int) -> tuple[np.ndarray, int, int]:
        """``(vector behind each block, vector in front of all, cost)``; ``last`` is the vector behind all.

        The first block holds what is left over of ``len(signs) / block``.
        """
        blocks = -(-len(signs) // self.block)
        behind = np.zeros(blocks, np.int64)
        codes = self.codes(signs)
        v, cost = last, 0
        for i in range(blocks - 1, -1, -1):
            behind[i] = v
            if i == 0 and len(signs) % self.block:
                for sign in signs[: len(signs) % self.block][::-1]:
                    cost += int(self.cost[v, sign])
                    v = int(self.to[v, sign])
            else:
                cost += int(self.block_cost[v, codes[i]])
                v = int(self.block_to[v, codes[i]])
        return behind, v, cost

    def codes(self, signs: np.ndarray) -> list[int]:
        """Each block of symbols as a number; that of a short first block is not used."""
        spare = -len(signs) % self.block
        whole = np.concatenate([np.zeros(spare, np.int64), signs]).reshape(-1, self.block)
        return (whole @ _SYMBOLS ** np.arange(self.block - 1, -1, -1)).tolist()

    def matrix(self, signs: np.ndarray) -> np.ndarray:
        """Costs from each state in front of the symbols to each state behind them."""
        found = []
        for unit in self.unit:
            _, v, cost = self.borders(signs, unit)
            found.append([c + cost if c < _FAR else _FAR for c in self.vectors[v]])
        return np.array(found).T

    def trace_block(self, signs: tuple, behind: int, state: int) -> tuple[list[str], list[str], int]:
        """``(initials, roles)`` per symbol and the state behind the block."""
        key = signs, behind, state
        if key not in self.traced:
            if len(self.traced) >= 1 << 18:
                self.traced.clear()
            inside = [self.vectors[behind]]
            for sign in reversed(signs):
                inside.append(self.before(sign, inside[-1]))
            inside.reverse()
            initials, roles = [], []
            for i, sign in enumerate(signs):
                state, made = self.least(sign, state, inside[i], inside[i + 1])
                initials.append("".join(m[0] for m in made))
                roles.append("".join(m[1] or "-" for m in made))
            self.traced[key] = initials, roles, state
        return self.traced[key]

    def least(self, sign: int | None, state: int, here: tuple, after: tuple) -> tuple[int, list[tuple[str, str]]]:
        """The edits at one row, inserts in front of it included; behind the last row (``sign`` None) inserts only."""
        made = []
        while True:
            ways = list(self.edits(sign, state, after)) if sign is not None else [("", "", state, after[state])]
            ways += [("I", r, t, self.costs.insert + here[t]) for r, t in _AFTER[state].items() if r in NAMES]
            initial, role, target, _ = min((w for w in ways if w[3] == here[state]), key=lambda w: w[0])
            if initial:
                made.append((initial, role))
            state = target
            if initial != "I":
                return state, made

    def trace(self, signs: np.ndarray, last: int, state: int) -> tuple[list[str], list[str], int]:
        """Initials and roles of the edits at every symbol, and the state behind them."""
        behind, _, _ = self.borders(signs, last)
        initials, roles, at = [], [], 0
        for v in behind.tolist():
            size = (len(signs) - at) % self.block or self.block
            part = tuple(signs[at:at + size].tolist())
            at += size
            one, two, state = self.trace_block(part, v, state)
            initials += one
            roles += two
        return initials, roles, state

    def close(self, state: int) -> tuple[str, str]:
        """Inserts behind the last row."""
        _, made = self.least(None, state, self.with_inserts(_END), _END)
        return "".join(m[0] for m in made), "".join(m[1] for m in made)


def block_table(costs: Costs, block: int) -> BlockTable:
    return worker_state("conversation-repair", (costs.rerole, costs.delete, costs.insert, costs.truncated, block),
                        lambda: BlockTable(costs, block))


def messages_of(initials: str, roles: str, role: str, text: str) -> list[tuple[str, str]]:
    """``(role, text)`` of what the edits at a row leave and insert."""
    out = []
    for initial, to in zip(initials, roles):
        if initial == "I":
            out.append((NAMES[to], ""))
        elif initial == "R":
            out.append((NAMES[to], text))
        elif initial == "K":
            out.append((role, text))
    return out


@dataclass
class Run:
    """Consecutive rows of one conversation, and what was counted in them."""

    signs: list = field(default_factory=list)
    owners: list = field(default_factory=list)
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    first_kind: int = -1
    last_kind: int = -1
    turns: list = field(default_factory=list)

    def add(self, place: int, turn: int | None, n: int, kind: int, blank: bool, truncated: bool, seen: bool) -> None:
        """``n`` equal rows."""
        if not n:
            return
        self.illegal += illegal_pair(self.last_kind, kind) + n - 1
        self.first_kind = kind if self.first_kind < 0 else self.first_kind
        self.last_kind = kind
        if turn is not None and (not self.turns or self.turns[-1] != turn):
            self.turns.append(turn)
        if blank:
            self.blank += n
        else:
            self.duplicate += n - (not seen)
            self.truncated += truncated and not seen
        stays = not blank and not seen
        self.signs += [symbol(kind, truncated) if stays else _MUST_GO] + [_MUST_GO] * (n - 1)
        self.owners += [place] * n


def illegal_pair(one: int, two: int) -> bool:
    """Whether two neighbours of these kinds are none of su, ua, au; before the first row there is none (-1)."""
    return one >= 0 and (one, two) not in ((0, 1), (1, 2), (2, 1))


def gaps(turns: list) -> int:
    return turns[-1] - turns[0] + 1 - len(turns) if turns else 0


_PASS = (
    "chunk int, place bigint, turn bigint, role string, text string, n bigint, kind int, is_blank boolean, is_truncated boolean, "
    "seen boolean, digest binary, message boolean"
)


def _prepared(turns: DataFrame) -> DataFrame:
    """Rows with their number of copies, symbols and digest, in chunks, sorted."""
    there = F.col("copies") > 0
    rows = turns.select(
        "conv_id",
        *[F.when(there, c).alias(n) for n, c in (
            ("turn", F.col("turn").cast("bigint")), ("role", F.coalesce("role", F.lit(" "))), ("text", F.coalesce("text", F.lit(" "))))],
        "copies",
    ).groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").cast("long").alias("n"))
    initial = F.substring("role", 1, 1)
    kind = F.lit(len(KINDS))
    for i, known in enumerate(KINDS):
        kind = F.when(initial == known, i).otherwise(kind)
    trimmed = F.rtrim("text", F.lit(WHITE))
    parts = rows.select(
        "*", kind.cast("int").alias("kind"),
        (F.ltrim(trimmed, F.lit(WHITE)) == "").alias("is_blank"),
        (~F.substring(trimmed, -1, 1).isin(".", "!", "?")).alias("is_truncated"),
        F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))).alias("digest"),
    )
    ranged = parts.repartitionByRange("conv_id", "turn", F.substring("role", 1, RANGE_CHARS), F.substring("text", 1, RANGE_CHARS))
    return ranged.sortWithinPartitions("conv_id", "turn", "role", "text").withColumn("chunk", F.spark_partition_id())


def _finish_inside(rows: DataFrame, costs: Costs, block: int, messages: bool) -> DataFrame:
    """Summaries of conversations that lie inside a chunk, and the rows of those at its borders."""
    id_type = rows.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {id_type}, {_PASS}, {SUMMARY}"
    n_summary = len(SUMMARY.split(","))
    fields = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = block_table(costs, block)
        out: list[tuple] = []
        types = None
        held: list[tuple] = []
        first = True

        def ready() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], fields)
            out.clear()
            return made

        def open_rows() -> None:
            seen = set()
            for place, (conv, chunk, turn, role, text, n, kind, blank, truncated, digest) in enumerate(held):
                again = digest in seen
                if n and not blank:
                    seen.add(digest)
                out.append((conv, chunk, place, turn, role, text, n, kind, blank, truncated, again, digest, False) + (None,) * n_summary)

        def whole() -> None:
            seen, run = set(), Run()
            for place, (_, _, turn, _, _, n, kind, blank, truncated, digest) in enumerate(held):
                run.add(place, turn, n, kind, blank, truncated, digest in seen)
                if n and not blank:
                    seen.add(digest)
            signs = np.array(run.signs, np.int64)
            _, v, cost = table.borders(signs, table.end)
            initials, roles, state = table.trace(signs, table.end, 0)
            tail = table.close(state)
            digest, lines = hashlib.sha256(), 0
            conv, chunk = held[0][:2]
            edits = list(zip(run.owners, initials, roles)) + ([(-1, *tail)] if tail[0] else [])
            for place, one, two in edits:
                _, _, turn, role, text, *_ = held[place]
                for to, said in messages_of(one, two, role, text):
                    digest.update(f"{chr(10) if lines else ''}{to}:{said}".encode())
                    if messages:
                        out.append((conv, chunk, lines, turn, to, said, 1) + (None,) * 5 + (True,) + (None,) * n_summary)
                    lines += 1
            out.append((conv, chunk) + (None,) * 10 + (False, gaps(run.turns), run.blank, run.duplicate, run.truncated, run.illegal,
                       cost + table.vectors[v][0], "".join(e[1] for e in edits), digest.hexdigest()))

        for batch in batches:
            types = types or [
                batch.schema.field("conv_id").type, pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(),
                pa.int32(), pa.bool_(), pa.bool_(), pa.bool_(), pa.binary(), pa.bool_(), *[pa.int64()] * 6, pa.string(), pa.string()]
            names = ("conv_id", "chunk", "turn", "role", "text", "n", "kind", "is_blank", "is_truncated", "digest")
            for row in zip(*(batch.column(c).to_pylist() for c in names)):
                if held and held[0][0] != row[0]:
                    open_rows() if first else whole()
                    first = False
                    held.clear()
                    if len(out) > 2000:
                        yield ready()
                held.append(row)
        if held:
            open_rows()
        if out:
            yield ready()

    return rows.mapInArrow(run, schema)


def _seen_before(rows: DataFrame) -> DataFrame:
    """``(key, chunk, place)`` of rows whose role and text an earlier chunk of the conversation has."""
    asked = rows.where("n > 0 and not is_blank and not seen").select("key", "chunk", "place", "digest")
    firsts = stage(asked.groupBy("key", "digest").agg(F.min("chunk").alias("first_chunk")), "firsts")
    return asked.join(firsts, ["key", "digest"]).where("first_chunk < chunk").select("key", "chunk", "place", F.lit(True).alias("before"))


_SEGMENT = (
    "key string, chunk int, signs binary, owners binary, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
    "first_kind int, last_kind int, turn_from string, turn_to string, n_turns bigint, matrix array<bigint>"
)


def _segments(rows: DataFrame, costs: Costs, block: int) -> DataFrame:
    """One row per conversation and chunk: its symbols, counts and matrix."""

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        table, found = block_table(costs, block), Run()
        for r in part.sort_values("place").itertuples(index=False):
            turn = None if pd.isna(r.turn) else int(r.turn)
            found.add(int(r.place), turn, int(r.n), int(r.kind), bool(r.is_blank), bool(r.is_truncated), bool(r.seen))
        signs = np.array(found.signs, np.int64)
        turns = found.turns
        return pd.DataFrame([{
            "key": key[0], "chunk": key[1], "signs": signs.astype("u1").tobytes(),
            "owners": np.array(found.owners, "<i8").tobytes(), "blank": found.blank, "duplicate": found.duplicate,
            "truncated": found.truncated, "illegal": found.illegal, "first_kind": found.first_kind, "last_kind": found.last_kind,
            "turn_from": str(turns[0]) if turns else None, "turn_to": str(turns[-1]) if turns else None, "n_turns": len(turns),
            "matrix": table.matrix(signs).ravel().tolist(),
        }])

    narrow = rows.select("key", "chunk", "place", F.col("turn").cast("string").alias("turn"), "n", F.coalesce("kind", F.lit(3)).alias("kind"),
                         F.coalesce("is_blank", F.lit(True)).alias("is_blank"), F.coalesce("is_truncated", F.lit(False)).alias("is_truncated"), "seen")
    return narrow.groupBy("key", "chunk").applyInPandas(run, _SEGMENT)


def _pass_vectors(segments: DataFrame, end: tuple) -> DataFrame:
    """Counts and cost of each conversation, and the cost vector behind each of its chunks; ``end`` is the last one."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("chunk")
        illegal, last_kind, n_turns, turns = int(part.illegal.sum()), -1, 0, []
        for r in part.itertuples(index=False):
            if r.first_kind >= 0:
                illegal += illegal_pair(last_kind, r.first_kind)
                last_kind = r.last_kind
            if r.n_turns:
                n_turns += int(r.n_turns) - (turns[-1:] == [int(r.turn_from)])
                turns += [int(r.turn_from), int(r.turn_to)]
        vector, behind = np.array(end, np.int64), []
        for matrix in reversed(part.matrix.tolist()):
            behind.append(vector.tolist())
            vector = np.minimum((np.array(matrix, np.int64).reshape(4, 4) + vector).min(axis=1), _FAR)
        out = pd.DataFrame({"key": part.key, "chunk": part.chunk, "behind": behind[::-1]})
        out["gaps"] = turns[-1] - turns[0] + 1 - n_turns if turns else 0
        for c in ("blank", "duplicate", "truncated"):
            out[c] = int(part[c].sum())
        out["illegal"], out["cost"] = illegal, int(vector[0])
        return out

    schema = ("key string, chunk int, behind array<bigint>, gaps bigint, blank bigint, duplicate bigint, truncated bigint, "
              "illegal bigint, cost bigint")
    return segments.drop("signs", "owners").groupBy("key").applyInPandas(run, schema)


def _traces(segments: DataFrame, costs: Costs, block: int) -> DataFrame:
    """The edits of a chunk for each state in front of it: initials, roles, the rows they belong to, the state behind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = block_table(costs, block)
        for batch in batches:
            for r in batch.to_pylist():
                signs = np.frombuffer(r["signs"], "u1").astype(np.int64)
                owners = np.frombuffer(r["owners"], "<i8")
                least = min(r["behind"])
                behind = table.known[tuple(c - least for c in r["behind"])]
                for state in range(4):
                    initials, roles, after = table.trace(signs, behind, state)
                    places = np.repeat(owners, [len(i) for i in initials]).astype("<i8").tobytes()
                    found = (r["key"], r["chunk"], state, after, "".join(initials), "".join(roles), places)
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(found, types)], names)

    names = ["key", "chunk", "state", "after", "audit", "roles", "places"]
    types = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.binary()]
    return segments.mapInArrow(run, "key string, chunk int, state int, after int, audit string, roles string, places binary")


def _pass_states(traces: DataFrame, costs: Costs, block: int) -> DataFrame:
    """The state in front of each chunk, and the inserts behind the last one."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        after = {(r.chunk, r.state): r.after for r in part.itertuples(index=False)}
        chunks, state, out = sorted(set(part.chunk)), 0, []
        for chunk in chunks:
            out.append([part.key.iloc[0], chunk, state, "", ""])
            state = after[chunk, state]
        out[-1][3:] = block_table(costs, block).close(state)
        return pd.DataFrame(out, columns=["key", "chunk", "state", "tail", "tail_roles"])

    schema = "key string, chunk int, state int, tail string, tail_roles string"
    return traces.select("key", "chunk", "state", "after").groupBy("key").applyInPandas(run, schema)


def _lines(chosen: DataFrame) -> DataFrame:
    """One row per message that stays or is inserted: ``(key, chunk, line, place, initial, to)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                places = np.frombuffer(r["places"], "<i8").tolist() + [-1] * len(r["tail"])
                edits = enumerate(zip(places, r["audit"] + r["tail"], r["roles"] + r["tail_roles"]))
                rows = [(line, place, initial, NAMES.get(to)) for line, (place, initial, to) in edits if initial != "D"]
                if rows:
                    line, place, initial, to = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r["key"]] * len(rows)), pa.array([r["chunk"]] * len(rows), pa.int32()), pa.array(line, pa.int64()),
                         pa.array(place, pa.int64()), pa.array(initial), pa.array(to, pa.string())],
                        ["key", "chunk", "line", "place", "initial", "to"])

    return chosen.mapInArrow(run, "key string, chunk int, line bigint, place bigint, initial string, to string")


def _hashes(lines: DataFrame) -> DataFrame:
    """SHA-256 of the lines of each conversation, read in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            done = []
            for now, role, text in zip(*(batch.column(c).to_pylist() for c in ("key", "role", "text"))):
                if now == key:
                    digest.update(f"\n{role}:{text}".encode())
                    continue
                if key is not None:
                    done.append((key, digest.hexdigest()))
                key, digest = now, hashlib.sha256(f"{role}:{text}".encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["key", "repaired_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([digest.hexdigest()])], ["key", "repaired_sha256"])

    ordered = lines.repartition("key").sortWithinPartitions("key", "chunk", "line")
    return ordered.select("key", "role", "text").mapInArrow(run, "key string, repaired_sha256 string")


def repair(
    turns: DataFrame, costs: Costs = Costs(), block: int = BLOCK, messages: bool = False
) -> tuple[DataFrame, DataFrame | None]:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)`` of every conversation in
    ``turns`` (``conv_id, turn, role, text``, and ``copies`` if rows stand for several), and, if wanted, the repaired
    ``(conv_id, chunk, line, role, text)``, whose order is that of chunk and line."""
    if "copies" not in turns.columns:
        turns = turns.withColumn("copies", F.lit(1))
    passed = stage(_finish_inside(_prepared(turns), costs, block, messages), "chunks")
    names = [f.split()[0] for f in SUMMARY.split(", ")]
    key = F.when(F.col("conv_id").isNull(), "n").otherwise(F.concat(F.lit("v"), F.col("conv_id").cast("string")))
    opened = passed.where("gaps is null and not message").withColumn("key", key)

    before = _seen_before(opened)
    marked = opened.join(before, ["key", "chunk", "place"], "left").withColumn("seen", F.col("seen") | F.coalesce("before", F.lit(False)))
    segments = stage(_segments(marked, costs, block), "segments")
    counts = stage(_pass_vectors(segments, BlockTable(costs, block).with_inserts(_END)), "vectors")
    behind = segments.join(counts.select("key", "chunk", "behind"), ["key", "chunk"])
    traces = stage(_traces(behind.select("key", "chunk", "signs", "owners", "behind"), costs, block), "traces")
    chosen = stage(traces.join(_pass_states(traces, costs, block), ["key", "chunk", "state"]), "edits")

    part = F.struct("chunk", F.concat("audit", "tail").alias("audit"))
    audits = chosen.groupBy("key").agg(F.array_join(F.transform(F.array_sort(F.collect_list(part)), lambda p: p["audit"]), "").alias("audit"))
    texts = opened.select("key", "chunk", "place", "role", "text")
    lines = _lines(chosen).join(texts, ["key", "chunk", "place"], "left").select(
        "key", "chunk", "line", F.when(F.col("initial") == "K", F.col("role")).otherwise(F.col("to")).alias("role"),
        F.when(F.col("initial") == "I", "").otherwise(F.col("text")).alias("text"))
    ids = opened.groupBy("key").agg(F.first("conv_id").alias("conv_id"))
    once = counts.groupBy("key").agg(*[F.first(n).alias(n) for n in names[:6]])
    at_borders = once.join(ids, "key").join(audits, "key").join(_hashes(lines), "key", "left").select(
        "conv_id", *names[:-1], F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
    summary = passed.where("gaps is not null").select("conv_id", *names).union(at_borders)
    if not messages:
        return summary, None
    inside = passed.where("message").select("conv_id", "chunk", F.col("place").alias("line"), "role", "text")
    return summary, inside.union(lines.join(ids, "key").select(*inside.columns))
