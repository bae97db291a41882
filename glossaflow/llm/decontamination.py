"""Benchmark decontamination by spaced seeds.

A seed is a window of tokens under a fixed mask; the mask leaves some positions out, so a window still hits if
tokens there were substituted. Hashes of all masked windows of the training texts are joined with those of the
test items. The masks are all triples within five tokens: if three of five tokens of an item stand in their places,
some window of five holds a triple, so no such item is missed, whatever was substituted.

Around the hits, the whole item is laid on the text along their diagonal and compared token by token; where hits lie on
diagonals at most ``SHIFT`` apart, the way may change between them, as it must where words were inserted or left out.
The pair counts if at least ``least`` of the item's tokens stand in their places, or if a passage of the item does: a
stretch in which ``least`` of the tokens do, and ``STRETCH_TOKENS`` or more.

The join is one against many: the items are taken in blocks of bounded size (``BLOCK_TOKENS``), a block's hashes
are sorted and sent to the tasks, and texts stay where they are. A benchmark of several blocks is several passes
over the texts; none is left out.

Tokens are lower-case runs of letters and digits. Items of fewer than ``SHORT_TOKENS`` tokens are sought whole;
items of fewer than ``LEAST_TOKENS`` tokens say nothing and are not sought.

Results: null and empty texts hit nothing; of an item that occurs several times in a text the best place is
given, the first on ties; equal items are reported each; repeated documents are reported each.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossaflow.llm.common import Sent, map_batches, quoted, worker_state

# Fixed masks: 1 is compared, 0 is ignored. All triples within five tokens; shares below 3/5 may be missed.
MASKS = ("111", "1101", "1011", "11001", "10101", "10011")
SPAN = 5
SHORT_TOKENS = 6
STRETCH_TOKENS = 13
SHIFT = 5
SWITCH_COST = 2
# Bounds of what is held at once: hits of seeds, compared tokens, diagonals side by side.
HITS_AT_ONCE = 2_000_000
TOKENS_AT_ONCE = 4_000_000
DIAGONALS_AT_ONCE = 1024
LEAST_TOKENS = 4
LEAST_SHARE = 0.6
BLOCK_TOKENS = 1_000_000
HITS_SCHEMA = "doc_id long, item_id long, start long, n_tokens int, n_equal int, share double"

_TOKEN = re.compile(r"[^\W_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def tokens_of(text: str | None) -> list[str]:
    return _TOKEN.findall(text.lower()) if text else []


def _masked(codes: np.ndarray, mask: tuple[int, ...], span: int) -> np.ndarray:
    """Hash of the window that starts at each place, from the codes at the places the mask keeps."""
    size = len(codes) - span + 1
    total = np.zeros(max(size, 0), np.uint64)
    with np.errstate(over="ignore"):
        for i in mask:
            total = total * _BASE + codes[i : i + size].astype(np.uint64)
    return total


@dataclass(frozen=True)
class Block:
    """Part of the benchmark: the codes of its words, its items as codes, and its seeds by mask."""

    words: dict[str, int]
    item_ids: list[int | None]
    items: list[np.ndarray]
    seeds: list[tuple[tuple[int, ...], int, np.ndarray, np.ndarray, np.ndarray]]  # mask, span, hash, item, place

    @classmethod
    def of(cls, rows: list[tuple[int | None, list[str]]]) -> Block:
        words: dict[str, int] = {}
        items = [np.array([words.setdefault(w, len(words) + 1) for w in tokens], np.int64) for _, tokens in rows]
        seeds = []
        for text in MASKS:
            mask, span = tuple(i for i, c in enumerate(text) if c == "1"), len(text)
            made = [_masked(item, mask, span) for item in items]
            flat = np.concatenate(made)
            owners = np.repeat(np.arange(len(items)), list(map(len, made)))
            places = np.concatenate([np.arange(len(m)) for m in made])
            order = np.argsort(flat, kind="stable")
            seeds.append((mask, span, flat[order], owners[order], places[order]))
        return cls(words, [i for i, _ in rows], items, seeds)

    def find(self, texts: list[str | None], least: float = LEAST_SHARE) -> list[tuple[int, int, int, int]]:
        """``(text number, item number, start, equal tokens)``: the best place of each item that counts in each text."""
        rows = [tokens_of(text) for text in texts]
        lengths = np.fromiter(map(len, rows), np.int64, len(rows))
        starts = np.cumsum(lengths) - lengths
        get = self.words.get
        codes = np.fromiter((get(w, 0) for row in rows for w in row), np.int64, int(lengths.sum()))
        sizes = np.fromiter(map(len, self.items), np.int64, len(self.items))
        needed = np.array([_least_hits(int(n), least) for n in sizes])
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for text, item, low, high in self._candidates(codes, lengths, starts, sizes, needed, least):
            wording = self.items[item]
            line = codes[starts[text] : starts[text] + lengths[text]]
            for first in range(low, high + 1, DIAGONALS_AT_ONCE // 2):
                begin, equal = _aligned(line, wording, first, min(high, first + DIAGONALS_AT_ONCE - 1))
                if _counts(equal, least):
                    place = -int(equal.sum()), begin
                    best[text, item] = min(place, best.get((text, item), place))
        return [(t, item, begin, -equal) for (t, item), (equal, begin) in sorted(best.items())]

    def _hits(self, codes: np.ndarray, lengths: np.ndarray, starts: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``(text and item, diagonal)`` as numbers, and how many seeds hit there."""
        owner = np.repeat(np.arange(len(lengths)), lengths)
        width = int(lengths.max(initial=0)) + longest + 1
        known = codes > 0
        for mask, span, hashes, items, places in self.seeds:
            size = len(codes) - span + 1
            if size <= 0:
                continue
            possible = known[mask[0] : mask[0] + size].copy()
            for i in mask[1:]:
                possible &= known[i : i + size]
            at = np.flatnonzero(possible)
            at = at[owner[at] == owner[at + span - 1]]
            wanted = np.zeros(len(at), np.uint64)
            with np.errstate(over="ignore"):
                for i in mask:
                    wanted = wanted * _BASE + codes[at + i].astype(np.uint64)
            low, high = np.searchsorted(hashes, wanted, "left"), np.searchsorted(hashes, wanted, "right")
            at, low, n = at[high > low], low[high > low], (high - low)[high > low]
            part = np.cumsum(n) // HITS_AT_ONCE
            for here in np.split(np.arange(len(at)), np.flatnonzero(np.diff(part)) + 1):
                some = n[here]
                hit = np.repeat(at[here], some)
                which = np.arange(len(hit)) + np.repeat(low[here] - (np.cumsum(some) - some), some)
                text = owner[hit]
                diagonal = hit - starts[text] - places[which]
                yield np.unique((text * len(self.items) + items[which]) * width + diagonal + longest, return_counts=True)

    def _candidates(self, codes: np.ndarray, lengths: np.ndarray, starts: np.ndarray, sizes: np.ndarray,
                    needed: np.ndarray, least: float) -> Iterator[tuple[int, int, int, int]]:
        """``(text, item, first diagonal, last diagonal)`` of neighbouring diagonals that may count together.

        That is, if they have as many hits as any counting pair, and as many places of the item have their token on one
        of them.
        """
        longest = int(sizes.max())
        width = int(lengths.max(initial=0)) + longest + 1
        keys, hits = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for more, n in self._hits(codes, lengths, starts, longest):
            keys, place = np.unique(np.concatenate([keys, more]), return_inverse=True)
            hits = np.bincount(place, np.concatenate([hits, n]), len(keys)).astype(np.int64)
        if not len(keys):
            return
        pair, diagonal = keys // width, keys % width - longest
        group = np.cumsum(np.r_[True, (np.diff(pair) != 0) | (np.diff(diagonal) > SHIFT)]) - 1
        enough = np.bincount(group, hits)[group] >= needed[(pair % len(self.items))]
        pair, diagonal, group = pair[enough], diagonal[enough], group[enough]
        if not len(pair):
            return
        flat, offsets = np.concatenate(self.items), np.cumsum(sizes) - sizes
        cuts = np.flatnonzero(np.r_[True, np.diff(group) != 0, True])
        total = np.cumsum(sizes[pair % len(self.items)])[cuts[1:] - 1] // TOKENS_AT_ONCE
        for groups in np.split(np.arange(len(cuts) - 1), np.flatnonzero(np.diff(total)) + 1):
            rows = np.arange(cuts[groups[0]], cuts[groups[-1] + 1])
            text, item = pair[rows] // len(self.items), pair[rows] % len(self.items)
            n = sizes[item]
            row = np.repeat(np.arange(len(rows)), n)
            at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            there = diagonal[rows][row] + at
            inside = (there >= 0) & (there < lengths[text][row])
            equal = np.zeros(len(row), bool)
            equal[inside] = codes[(starts[text][row] + there)[inside]] == flat[(offsets[item][row] + at)[inside]]
            leaders = cuts[groups] - rows[0]
            each = n[leaders]
            number = np.repeat(np.arange(len(groups)), np.diff(np.r_[leaders, len(rows)]))[row]
            held = np.zeros(int(each.sum()), bool)
            held[((np.cumsum(each) - each)[number] + at)[equal]] = True
            covered = np.add.reduceat(held.astype(np.int64), np.cumsum(each) - each)
            wanted = np.where(each < SHORT_TOKENS, each, np.minimum(np.ceil(least * each - 1e-9), STRETCH_TOKENS))
            ends = np.r_[leaders[1:], len(rows)] - 1
            for g in np.flatnonzero(covered >= wanted).tolist():
                first, last = rows[leaders[g]], rows[ends[g]]
                yield int(text[leaders[g]]), int(item[leaders[g]]), int(diagonal[first]), int(diagonal[last])


def _least_hits(n: int, least: float) -> int:
    """How many triples of an item of ``n`` tokens stand in the text at least, if it counts."""
    blocks, rest = divmod(n, SPAN)
    share = max(int(np.ceil(min(least, 1) * n - 1e-9)) - rest, 0)
    low, more = divmod(share, blocks) if blocks else (0, 0)
    whole = (blocks - more) * _triples(low) + more * _triples(low + 1)
    # A stretch of 13 tokens in place, at three of five, has at least four blocks with a triple.
    return max(1, min(whole, 4))


def _triples(n: int) -> int:
    return n * (n - 1) * (n - 2) // 6


def _aligned(line: np.ndarray, wording: np.ndarray, low: int, high: int) -> tuple[int, np.ndarray]:
    """Where an item begins, and which of its tokens have their place, on the best way over diagonals ``low..high``.

    A change of diagonal costs ``SWITCH_COST``, and one backwards also the tokens it skips, which do not count.
    """
    n, width = len(wording), high - low + 1
    padded = np.zeros(n + width - 1, np.int64)
    first, last = max(low, 0), min(high + n, len(line))
    if last > first:
        padded[first - low : last - low] = line[first:last]
    equal = np.lib.stride_tricks.sliding_window_view(padded, width) == wording[:, None]
    if width == 1:
        return low, equal[:, 0]
    steps = [0, *(d for s in range(1, min(SHIFT, width - 1) + 1) for d in (s, -s))]
    score, came = np.zeros(width), np.zeros((n, width), np.int8)
    for place in range(n):
        if place:
            ways = np.full((len(steps), width), -np.inf)
            for i, d in enumerate(steps):
                cost = (SWITCH_COST if d else 0) + max(-d, 0)
                ways[i, max(d, 0) : width + min(d, 0)] = score[max(-d, 0) : width - max(d, 0)] - cost
            choice = ways.argmax(0)
            score, came[place] = ways[choice, np.arange(width)], np.array(steps, np.int8)[choice]
        score = score + equal[place]
    where = int(score.argmax())
    way = np.zeros(n, np.int64)
    found = np.zeros(n, bool)
    for place in range(n - 1, -1, -1):
        way[place], found[place] = where, equal[place, where]
        where -= int(came[place, where])
    for place in np.flatnonzero(np.diff(way) < 0) + 1:
        found[place : place + way[place - 1] - way[place] - 1] = False
    start = int(way[found.argmax()])
    return low + start, found


def _counts(equal: np.ndarray, least: float) -> bool:
    """Whether an item of which these tokens have their place counts: by its share, or by a passage of it."""
    n, total = len(equal), int(equal.sum())
    if n < SHORT_TOKENS:
        return total == n
    if total >= least * n:
        return True
    if total < STRETCH_TOKENS:
        return False
    # From each end, the longest stretch before it of which the share is in place.
    surplus = np.round(np.r_[0.0, np.cumsum(equal - least)], 9)
    begin = np.searchsorted(-np.minimum.accumulate(surplus), -surplus)
    held = np.r_[0, np.cumsum(equal)]
    return bool((held - held[begin]).max() >= STRETCH_TOKENS)


def blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> list[Block]:
    """The benchmark in blocks of at most ``BLOCK_TOKENS`` tokens (or one item), by ranges of a hash of the id."""
    words = F.greatest(F.size(F.split(F.coalesce(quoted(text), F.lit("")), r"\W+")), F.lit(1))
    rows = benchmark.select(quoted(item_id).cast("long").alias("item_id"), quoted(text).alias("text"))
    total = benchmark.agg(F.sum(words.cast("long"))).first()[0] or 0
    parts = max(1, -(-2 * total // BLOCK_TOKENS))
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    made = []
    for part in range(parts):
        found = rows.where(number == part).orderBy("item_id", "text").toArrow().to_pylist()
        tokens = [(row["item_id"], tokens_of(row["text"])) for row in found]
        kept = [(i, t) for i, t in tokens if len(t) >= LEAST_TOKENS]
        if kept:
            made.append(Block.of(kept))
    return made


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text",
               least: float = LEAST_SHARE) -> DataFrame:
    """``(doc_id, item_id, start, n_tokens, n_equal, share)``: items of which ``least``, or a passage, stand in a document."""
    spark = docs.sparkSession
    rows = docs.select(quoted(id_column).cast("long").alias("doc_id"), quoted(text).alias("text"))
    result = None
    for block in blocks(benchmark):
        sent, key = Sent(spark, block), uuid.uuid4().hex

        def run(batch: pa.RecordBatch, sent=sent, key=key) -> pa.RecordBatch | None:
            block = worker_state("decontamination", key, sent.open)
            ids = batch.column("doc_id").to_pylist()
            made = [
                (ids[t], block.item_ids[i], begin, len(block.items[i]), equal, equal / len(block.items[i]))
                for t, i, begin, equal in block.find(batch.column("text").to_pylist(), least)
            ]
            if not made:
                return None
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(values, kind) for values, kind in zip(zip(*made), kinds)],
                ["doc_id", "item_id", "start", "n_tokens", "n_equal", "share"],
            )

        found = map_batches(rows, run, HITS_SCHEMA)
        result = found if result is None else result.unionByName(found)
    return spark.createDataFrame([], HITS_SCHEMA) if result is None else result


def drop_leaking(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text",
                 least: float = LEAST_SHARE) -> DataFrame:
    """``docs`` without those that hold a benchmark item. Filters where the texts lie; no shuffle."""
    spark = docs.sparkSession
    result = docs
    for block in blocks(benchmark):
        sent, key = Sent(spark, block), uuid.uuid4().hex

        def run(batch: pa.RecordBatch, sent=sent, key=key) -> pa.RecordBatch:
            block = worker_state("decontamination", key, sent.open)
            leaking = {t for t, *_ in block.find(batch.column(text).to_pylist(), least)}
            return batch.filter(pa.array([t not in leaking for t in range(batch.num_rows)], pa.bool_()))

        result = map_batches(result, run, result.schema, text)
    return result
