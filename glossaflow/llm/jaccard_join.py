"""Jaccard join of texts on word shingles, and the classes its links form.

Two texts link if their sets of shingles (words in a row) have a Jaccard similarity of at least ``num / den``.
Equal sets are one set from the start. Sets of n shingles are put in one global order, frequent shingles last, so
that linked sets share rare ones near its front: of the first n - ceil(n num/den) + k shingles of each, at least k.

The join is size-aware. *Small* sets enumerate all fixed-size subsets (pairs, k = 2) of that front: each subset is
a bucket, and a small-small link shares one. *Large* sets enter the inverted lists of the shingles in their front
(k = 1), and so do the small sets whose size could still match a large one: lists are scanned for every link with
a large set. The boundary is the size at which the rows written for subsets and the rows and pairs of scanning
lists, both measured over all texts, sum up to least.

No group is expanded into all its pairs. A round takes one hub per bucket; each set is compared with the hub it
shares most buckets with (the likest of four by their bitmaps), and verified links are contracted to components.
After a few rounds copies by the thousand are one component, and only pairs of different components are left: those
are all checked, first by what places in the fronts and bitmaps allow, then on the sets, so no link between
components is missed. What a bucket entry carries for that has a fixed size, however long its text is.

Frequencies come from all texts: tasks report shingles that occur in at least two of their sets, and the sums
decide the order (any order is right; a good one makes short lists). At most ``HEAVY_LIMIT`` shingles, the most
frequent, are told apart, which bounds what is sent to the tasks. Shingles and sets are named by 64-bit hashes.

Results: a null text, or one without words, has an empty set, links with nothing and is its own class. A text
with fewer words than a shingle has one shingle, all its words. Repeated rows link. Rows whose id is null keep a
class of their own unless they link; ids given twice with different texts are two nodes. An empty table gives an
empty table.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glossaflow.llm.common import give_back_memory, map_batches, quoted, small, text_slices, worker_state
from glossaflow.llm.components import as_edges, star_forest
from glossaflow.registry.languages import small_table
from glossaflow.scratch import brief_shuffles, discard, scratch_folder, small_batches, stage

HEAVY_LIMIT = 500_000
# Rounds of hubs at most; they end once a round links fewer than this share of the sets in buckets.
ROUNDS = 5
LEAST_PROGRESS = 0.005
# Fronts longer than this are never enumerated as subsets.
LONGEST_SMALL_FRONT = 64
# Longs of a set's bitmap, and hubs per set whose bitmaps are compared in a round.
BITMAP = 16
HUBS = 4
# Shared buckets of a set, the first ones in an order common to its kind, that tell in which bucket a pair is taken.
FIRST_KEYS = 16
# Rows of a file are numbered below two to this power.
FILE_ROWS_BITS = 40
_BUFFER = 1_000_000
# Rows of a task's report sent at once.
_REPORTED = 1 << 15
_REMEMBERED = 20_000
# Bytes of words that are hashed many at once (a multiple of eight), and how many.
_SHORT_WORD = 64
_WORDS_AT_ONCE = 1 << 16
# Bits by which a shingle is told from the frequent ones before it is sought among them.
_FIRST_BITS = 22
_LANE_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    """64-bit hash of a word longer than ``_SHORT_WORD``, worked out when first asked for."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > _REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _known(words: int) -> _Words:
    """The long words that this worker remembers; forgotten at the end of a task, as JVM stages follow that need the memory."""
    return worker_state("jaccard", words, _Words)


def _word_codes(data: np.ndarray, offsets: np.ndarray, known: _Words) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of texts that lie end to end in ``data``, and where each text's words begin.

    A-Z are lower-cased, words end at ASCII white space. Words are hashed eight bytes at a time, all words at once;
    only long ones are taken one by one.
    """
    size = len(data)
    lower = np.zeros(-(-size // 8) * 8 + 8, np.uint8)
    np.add(data, (data - np.uint8(65) < 26).view(np.uint8) << np.uint8(5), out=lower[:size])
    space = (data == 32) | (data - np.uint8(9) < 5)
    edge = np.zeros(size + 1, bool)  # where a text begins or the last one ends
    edge[offsets] = True
    before, after = edge[:-1].copy(), edge[1:].copy()
    before[1:] |= space[:-1]
    after[:-1] |= space[1:]
    starts, ends = np.flatnonzero(before & ~space), np.flatnonzero(after & ~space) + 1
    del space, edge, before, after
    lanes, codes = lower.view(np.uint64), np.empty(len(starts), np.uint64)
    with np.errstate(over="ignore"):
        for first in range(0, len(starts), _WORDS_AT_ONCE):
            begin, length = starts[first : first + _WORDS_AT_ONCE], ends[first : first + _WORDS_AT_ONCE]
            length = length - begin
            made = length.astype(np.uint64) * _BASE
            some, left = slice(None), length
            for lane in range(0, _SHORT_WORD, 8):
                if lane:
                    some = np.flatnonzero((length > lane) & (length <= _SHORT_WORD))
                    left = length[some] - lane
                if not len(left):
                    break
                at = begin[some] + lane
                shift = ((at & 7) << 3).astype(np.uint64)
                at >>= 3
                bits = (lanes[at] >> shift) | (lanes[np.minimum(at + 1, len(lanes) - 1)] << (np.uint64(63) - shift) << np.uint64(1))
                made[some] = _mixed(made[some] ^ (bits & _LANE_MASKS[np.minimum(left, 8)]))
            for i in np.flatnonzero(length > _SHORT_WORD).tolist():
                made[i] = known[lower[begin[i] : begin[i] + length[i]].tobytes()]
            codes[first : first + len(made)] = made
    return codes, np.searchsorted(starts, offsets)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = values * _BASE
    return values ^ (values >> np.uint64(29))


def _sets_of(texts: pa.Array, words: int, known: _Words) -> list[np.ndarray]:
    """Of each text the sorted distinct hashes of the runs of ``words`` words; a null text has none."""
    texts = texts.fill_null("").cast(pa.large_string())
    _, places, content = texts.buffers()
    offsets = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(content or b"", np.uint8)[offsets[0] : offsets[-1]]
    codes, begins = _word_codes(data, offsets - offsets[0], known)
    whole = _runs(codes, words)
    made = []
    for begin, end in zip(begins[:-1].tolist(), begins[1:].tolist()):
        runs = whole[begin : end - words + 1] if end - begin >= words else _runs(codes[begin:end], end - begin)
        runs = np.sort(runs)
        new = np.ones(len(runs), bool)
        np.not_equal(runs[1:], runs[:-1], out=new[1:])
        made.append(runs[new])
    return made


def _runs(codes: np.ndarray, span: int) -> np.ndarray:
    """Hash of the run of ``span`` words that starts at each place."""
    size = max(len(codes) - span + 1, 0) if span else 0
    total = np.full(size, span, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(span):
            total = _mixed(total ^ codes[i : i + size])
    return total


def shingles(text: str | None, words: int, known: _Words) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``words`` words of one text."""
    return _sets_of(pa.array([text], pa.string()), words, known)[0]


def _name(values: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(values.tobytes(), seed=1)).astype(np.int64))


def front_length(size: int, num: int, den: int) -> int:
    """How many of the first shingles of a set must be looked at so that linked sets share one."""
    return size + num * size // -den + 1


def boundary_size(front: int, num: int, den: int) -> int:
    """The largest set whose front is not longer than ``front``."""
    return -(-front * den // (den - num)) - 1


def _frequencies(rows: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """``(kind, key, n)``: shingles and their sets (0), list pairs by front length (1), sets by front length (2)."""

    def report(sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        sizes = [len(s) for s in sets]
        flat = np.concatenate(sets)
        sets.clear()
        order = np.argsort(flat)
        flat = flat[order]
        starts = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
        counts = np.diff(starts, append=len(flat)).astype(np.int32)
        often = counts >= 2
        shared, numbers = flat[starts[often]].view(np.int64), counts[often].astype(np.int64)
        del flat, starts, often
        held = np.empty(len(order), np.int32)  # how many sets hold the shingle, beside every shingle
        held[order] = np.repeat(counts, counts)
        del order, counts
        fronts: dict[int, list[int]] = {}
        at = 0
        for size in sizes:
            front = front_length(size, num, den)
            if front <= LONGEST_SMALL_FRONT:
                own = held[at : at + size]
                own = np.partition(own, front - 1)[:front] if front < size else own
                entry = fronts.setdefault(front, [0, 0])
                entry[0] += int((own - 1).sum())
                entry[1] += 1
            at += size
        few = [(1, f, e[0]) for f, e in fronts.items()] + [(2, f, e[1]) for f, e in fronts.items()] + [(3, -1, 1)]
        kinds, keys, sums = np.array(few, np.int64).T
        batch = pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([np.zeros(len(shared), np.int32), kinds.astype(np.int32)])),
             pa.array(np.concatenate([shared, keys])), pa.array(np.concatenate([numbers, sums]))],
            ["kind", "key", "n"],
        )
        for start in range(0, batch.num_rows, _REPORTED):
            yield batch.slice(start, _REPORTED)

    def run(batches):
        known = _known(words)
        sets, seen, gathered = [], set(), 0
        for batch in text_slices(batches):
            for made in _sets_of(batch.column("text"), words, known):
                name = _name(made)
                if len(made) and name not in seen:
                    seen.add(name)
                    sets.append(made)
                    gathered += len(made)
                if gathered >= _BUFFER:
                    yield from report(sets)
                    sets, seen, gathered = [], set(), 0
        if sets:
            yield from report(sets)
        del sets, seen
        known.clear()
        give_back_memory()

    found = rows.select("text").mapInArrow(run, "kind int, key long, n long")
    return found.groupBy("kind", "key").agg(F.sum("n").alias("n"))


def _heavy(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, sorted, with the class of their frequency (its number of bits)."""
    bits = F.ceil(F.log2(F.col("n") + 1)).cast("int")
    shared = counts.where("kind = 0").select("key", bits.alias("bits"))
    sizes = dict(shared.groupBy("bits").count().collect())
    total, least = 0, None
    for level in sorted(sizes, reverse=True):
        total += sizes[level]
        if total > HEAVY_LIMIT:
            break
        least = level
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int8)
    kept = shared.where(F.col("bits") >= least).toArrow()
    keys = kept.column("key").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return keys[order], kept.column("bits").to_numpy().astype(np.int8)[order]


def choose_front(counts: DataFrame) -> int:
    """The longest front that is enumerated as subsets: the one of least cost."""
    rows = {(r["kind"], r["key"]): r["n"] for r in counts.where("kind > 0").collect()}
    buffers = rows.get((3, -1), 0)
    fronts = sorted(key for kind, key in rows if kind == 2)
    cost = sum(rows[2, f] * f + rows[1, f] * buffers for f in fronts)
    best = (cost, 0)
    for f in fronts:
        cost += rows[2, f] * (f + 1) * f // 2 - rows[2, f] * f - rows[1, f] * buffers
        best = min(best, (cost, f))
    return best[1]


def _fronts(rows: DataFrame, words: int, num: int, den: int, heavy, small_front: int) -> DataFrame:
    """``(id, n, node, keys, bits0, ...)`` per text: its set's size and name, the buckets it enters in the global
    order, and its bitmap."""
    shared, key = rows.sparkSession.sparkContext.broadcast(heavy), uuid.uuid4().hex
    limit = boundary_size(small_front, num, den) if small_front else 0
    none = np.zeros(0, np.int64)

    def heavy_ones() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        table, classes = shared.value
        first_bits = np.zeros(1 << _FIRST_BITS, bool)
        first_bits[table >> np.uint64(64 - _FIRST_BITS)] = True
        return table, classes, first_bits

    def one(values: np.ndarray, table: np.ndarray, classes: np.ndarray, first_bits: np.ndarray) -> np.ndarray:
        size = len(values)
        front = front_length(size, num, den)
        ranks = np.zeros(size, np.int8)
        # Few of the other shingles begin with the same bits as one of the table; those need no search.
        maybe = np.flatnonzero(first_bits[values >> np.uint64(64 - _FIRST_BITS)])
        if len(maybe):
            at = np.searchsorted(table, values[maybe])
            at[at == len(table)] = 0
            hit = table[at] == values[maybe]
            ranks[maybe[hit]] = classes[at[hit]]
        # Values are sorted by hash already: a stable sort by class gives the global order.
        chosen = values[np.argsort(ranks, kind="stable")[: front + 1]]
        keys = chosen[:0]
        if size <= limit:
            a, b = np.triu_indices(len(chosen), 1)
            keys = chosen[a] ^ (chosen[b] << np.uint64(1))
        if size > limit or size * den > limit * num:
            keys = np.concatenate([keys, chosen[:front]])
        return keys.view(np.int64)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        known = _known(words)
        heavy = worker_state("jaccard-heavy", key, heavy_ones)
        sizes, names, keys, bitmaps = [], [], [], []
        for values in _sets_of(batch.column("text"), words, known):
            sizes.append(len(values))
            names.append(_name(values))
            keys.append(one(values, *heavy) if len(values) > 1 else none)
            bitmaps.append(_bitmap(values))
        return pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(names, pa.int64()),
             pa.array(keys, pa.list_(pa.int64())), *map(pa.array, np.array(bitmaps).reshape(-1, BITMAP).T)],
            ["id", "n", "node", "keys", *_bitmap_columns("")],
        )

    columns = ", ".join(f"{c} long" for c in _bitmap_columns(""))
    return map_batches(rows, run, f"id long, n long, node long, keys array<long>, {columns}",
                       finish=lambda: _known(words).clear())


def _bitmap(values: np.ndarray) -> np.ndarray:
    """``BITMAP`` longs with the bits set that the shingles hash to."""
    bits = np.zeros(64 * BITMAP, np.uint8)
    bits[(values >> np.uint64(7)) % np.uint64(len(bits))] = 1
    return np.packbits(bits).view(np.int64)


def _bitmap_columns(suffix: str) -> list[str]:
    return [f"bits{i}{suffix}" for i in range(BITMAP)]


def _wide(values: np.ndarray) -> np.ndarray:
    """A bitmap in longs that grows with the set: at least four bits a shingle, their number a power of two."""
    bits = np.zeros(max(64, 1 << (4 * len(values) - 1).bit_length()), np.uint8)
    bits[values & np.uint64(len(bits) - 1)] = 1
    return np.packbits(bits, bitorder="little").view(np.int64)


def _sets(rows: DataFrame, words: int) -> DataFrame:
    """``(node, n, wide, shingles)`` of texts, by the name of their set."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        known = _known(words)
        made = _sets_of(batch.column("text"), words, known)
        return pa.RecordBatch.from_arrays(
            [pa.array(map(_name, made), pa.int64()), pa.array(map(len, made), pa.int64()),
             pa.array([_wide(m) for m in made], pa.list_(pa.int64())),
             pa.array([m.view(np.int64) for m in made], pa.list_(pa.int64()))],
            ["node", "n", "wide", "shingles"],
        )

    return map_batches(rows.select("text"), run, "node long, n long, wide array<long>, shingles array<long>",
                       finish=lambda: _known(words).clear())


def _lacking(one: str, other: str):
    """Bits of one wide bitmap that the other lacks; the longer one is first folded to the shorter one's length."""
    size = F.least(F.size(one), F.size(other))

    def folded(name: str):
        upper = F.slice(name, size + 1, size)
        return F.when(F.size(name) == size, F.col(name)).otherwise(
            F.zip_with(F.slice(name, F.lit(1), size), upper, lambda low, high: low.bitwiseOR(high)))

    missing = F.zip_with(folded(one), folded(other), lambda x, y: F.bit_count(x.bitwiseAND(F.bitwise_not(y))))
    return F.aggregate(missing, F.lit(0), lambda total, n: total + n)


class _Verifier:
    """Checks pairs of sets on their shingles. Only sets that come up in a pair are ever read, each once."""

    def __init__(self, rows: DataFrame, named: DataFrame, words: int, num: int, den: int, folder: str):
        self.rows, self.named, self.words, self.num, self.den, self.folder = rows, named, words, num, den, folder
        self.sets: list[DataFrame] = []
        self.names: list[str] = []

    def links(self, pairs: DataFrame, name: str) -> DataFrame:
        """The pairs ``(a, b)`` that link, as written edges."""
        pairs = stage(pairs, f"pairs_{name}", self.folder)
        nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
        nodes = stage(nodes, f"nodes_{name}", self.folder)
        few = small(nodes, 16)
        self._read(nodes, name)
        sets = reduce(DataFrame.union, self.sets)

        def of(nodes: DataFrame, column: str) -> list[DataFrame]:
            mine = sets.join(F.broadcast(nodes) if few else nodes, "node", "left_semi")
            return [mine.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col(column).alias(f"{column}_{x}"))
                    for x in ("a", "b")]

        # A bitmap that fits the set's size leaves few pairs whose shingles have to be fetched.
        first, second = of(nodes, "wide")
        needed = F.ceil((F.col("n_a") + F.col("n_b")) * F.lit(self.num) / F.lit(self.num + self.den) - F.lit(1e-9))
        likely = pairs.join(first, "a").join(second, "b").where(
            (F.size("wide_a") <= 2 * F.size("wide_b")) & (F.size("wide_b") <= 2 * F.size("wide_a"))
            & (F.col("n_a") - _lacking("wide_a", "wide_b") >= needed)
            & (F.col("n_b") - _lacking("wide_b", "wide_a") >= needed)).select("a", "b")
        likely = stage(likely, f"likely_{name}", self.folder)
        ends = likely.select(F.col("a").alias("node")).union(likely.select(F.col("b").alias("node"))).distinct()
        first, second = of(ends, "shingles")
        shared = F.size(F.array_intersect("shingles_a", "shingles_b"))
        both = likely.join(first, "a").join(second, "b").select(
            "a", "b", shared.alias("shared"), (F.col("n_a") + F.col("n_b")).alias("sum"))
        linked = both.where(F.col("shared") * self.den >= (F.col("sum") - F.col("shared")) * self.num)
        links = stage(as_edges(linked.select("a", "b")), f"links_{name}", self.folder)
        discard(self.rows.sparkSession, self.folder, *(f"{x}_{name}" for x in ("pairs", "nodes", "wanted", "likely")))
        return links

    def tables(self) -> list[str]:
        """Names of the tables of sets; no pair can be checked once they are deleted."""
        return [f"{kind}_{name}" for name in self.names for kind in ("sets", "distinct")]

    def _read(self, nodes: DataFrame, name: str) -> None:
        for earlier in self.sets:
            nodes = nodes.join(earlier.select("node"), "node", "left_anti")
        wanted = stage(nodes.join(self.named, "node"), f"wanted_{name}", self.folder)
        few = small(wanted, 24)
        ids, names = wanted.select(F.col("chosen").alias("id")), wanted.select("node")
        if few:
            ids, names = F.broadcast(ids), F.broadcast(names)
        same_id = F.col("rows.id").eqNullSafe(F.col("ids.id"))
        texts = self.rows.alias("rows").join(ids.alias("ids"), same_id, "left_semi")
        sets = stage(_sets(texts, self.words).join(names, "node", "left_semi"), f"sets_{name}", self.folder)
        if not wanted.where("copies > 1").isEmpty():  # rows that are repeated with their id
            sets = stage(sets.dropDuplicates(["node"]), f"distinct_{name}", self.folder)
            discard(self.rows.sparkSession, self.folder, f"sets_{name}")
        self.sets.append(sets)
        self.names.append(name)


def jaccard_classes(docs: DataFrame, words: int = 5, num: int = 8, den: int = 10, id_column: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id, node)``: one row per row of ``docs``.

    ``component_id`` is the smallest id reachable by links, ``node`` names the row's set. ``num / den`` must be
    above a half.
    """
    if not den / 2 < num < den:
        raise ValueError("the similarity must lie between 1/2 and 1")
    with brief_shuffles(docs.sparkSession), small_batches(docs.sparkSession):
        return _classes(docs, words, num, den, id_column, text)


def _classes(docs: DataFrame, words: int, num: int, den: int, id_column: str, text: str) -> DataFrame:
    """Every step is written, and what no later step reads is deleted: the disk holds the tables in use and the shuffles of
    one step."""
    spark = docs.sparkSession
    folder = scratch_folder(spark)

    def keep(df: DataFrame, name: str) -> DataFrame:
        return stage(df, name, folder)

    rows = docs.select(quoted(id_column).cast("long").alias("id"), quoted(text).alias("text"))
    counts = keep(_frequencies(rows, words, num, den), "counts")
    small_front = choose_front(counts)
    fronts = keep(_fronts(rows, words, num, den, _heavy(counts), small_front), "fronts")
    members = keep(fronts.select("id", "n", "node"), "members")
    # The smallest id of each set, and a row to read it from: if it can be, one that has an id.
    alike = members.where("n > 0").groupBy("node", "id").agg(F.count("*").alias("copies"))
    row = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "copies")).alias("row")
    named = alike.groupBy("node").agg(row).select(
        "node", F.col("row.id").alias("chosen"), F.col("row.copies").alias("copies"))
    named = keep(named, "named")

    # Copies of a set become one before its buckets are written out; buckets with one set hold no link.
    placed = (
        fronts.where("size(keys) > 0").select("node", "n", "keys").dropDuplicates(["node"])
        .select("node", "n", F.posexplode("keys").alias("place", "key")).select("key", "node", "n", "place")
    )
    listed = keep(_repeated(placed, fronts.select(F.explode("keys").alias("key")), folder, "lists"), "listed")
    sized = _by_size(listed, num, den)
    entries = keep(_repeated(sized, sized, folder, "buckets"), "entries")
    nodes = keep(entries.select("node").distinct(), "nodes")
    marks = fronts.select("node", "n", *_bitmap_columns("")).join(
        F.broadcast(nodes) if small(nodes, 16) else nodes, "node", "left_semi").dropDuplicates(["node"])
    marks = keep(marks, "marks")
    discard(spark, folder, "counts", "fronts", "lists", "listed", "buckets")
    check = _Verifier(rows, named, words, num, den, folder)

    # Every set that is not the smallest of its component, and that smallest one.
    forest = None
    enough = LEAST_PROGRESS * nodes.count()
    for turn in range(ROUNDS):
        labelled = _labelled(entries, forest, folder, f"labels{turn}")
        found = check.links(_with_hubs(labelled, marks, turn, num, den, folder), f"hubs{turn}")
        discard(spark, folder, f"labels{turn}", f"offers{turn}")
        new = found.count()
        if new or forest is None:
            forest = star_forest(found if forest is None else forest.union(found))
        if new <= enough:
            break
    limit = boundary_size(small_front, num, den) if small_front else 0
    left = keep(_labelled(entries, forest, folder, "labels"), "left")
    found = check.links(_between(left, marks.drop("n"), num, den, limit), "rest")
    if found.count():
        forest = star_forest(forest.union(found))
    discard(spark, folder, "entries", "nodes", "marks", "labels", "left", *check.tables())
    labels = _components(forest)

    # The smallest id of each class, then of each set, then beside each row.
    classed = named.join(labels, "node", "left").withColumn("class", F.coalesce("component", "node"))
    smallest = keep(classed.groupBy("class").agg(F.min("chosen").alias("component_id")), "classes")
    of_set = keep(classed.join(smallest, "class").select("node", "component_id"), "of_set")
    joined = members.join(of_set, "node", "left")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return joined.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), own.alias("component_id"), "node"
    )


def _components(forest: DataFrame) -> DataFrame:
    return forest.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _shared(entries: DataFrame, of: str, folder: str, name: str) -> DataFrame:
    """``entries`` of the buckets that hold more than one ``of``. Buckets are counted before any of their rows meet,
    and joined with a written table, so that a bucket with very many rows can be split."""
    ends = entries.groupBy("key").agg(F.min(of).alias("low"), F.max(of).alias("high"))
    return entries.join(stage(ends.where("low != high").select("key"), name, folder), "key", "left_semi")


def _repeated(entries: DataFrame, counted: DataFrame, folder: str, name: str) -> DataFrame:
    """``entries`` of the buckets that ``counted`` has more than one row of. Counts are a fraction of what :func:`_shared`
    moves, but a bucket with copies of one set only stays until copies are one row."""
    often = counted.groupBy("key").agg(F.count("*").alias("rows")).where("rows > 1").select("key")
    return entries.join(stage(often, name, folder), "key", "left_semi")


def _by_size(entries: DataFrame, num: int, den: int) -> DataFrame:
    """``entries`` with buckets for sets of like size only. Sizes fall into bands as wide as linked sets can differ; a
    set enters the bucket of its band and of the next one, so linked sets share one of them."""
    band = F.floor(F.log("n") / F.lit(math.log(den / num) * 1.0001))
    return entries.withColumn("band", F.explode(F.array(band, band + 1))).select(
        F.xxhash64("key", "band").alias("key"), "node", "n", "place")


def _labelled(entries: DataFrame, forest: DataFrame | None, folder: str, name: str) -> DataFrame:
    """Bucket entries with the component of their set, without buckets that lie in one component."""
    if forest is None:
        return entries.withColumn("component", F.col("node"))
    labelled = entries.join(_components(forest), "node", "left").withColumn("component", F.coalesce("component", "node"))
    return _shared(labelled, "component", folder, name)


def _close(a: str, b: str, num: int, den: int):
    return (F.col(a) * den >= F.col(b) * num) & (F.col(b) * den >= F.col(a) * num)


def _may_link(num: int, den: int):
    """Whether the sets behind ``n_a, bits*_a`` and ``n_b, bits*_b`` can link.

    A bit that only one of the bitmaps has stands for at least one shingle that the other set lacks.
    """
    needed = F.ceil((F.col("n_a") + F.col("n_b")) * F.lit(num) / F.lit(num + den) - F.lit(1e-9))
    pairs = list(zip(_bitmap_columns("_a"), _bitmap_columns("_b")))
    only_a = sum((F.bit_count(F.col(a).bitwiseAND(F.bitwise_not(b))) for a, b in pairs), F.lit(0))
    only_b = sum((F.bit_count(F.col(b).bitwiseAND(F.bitwise_not(a))) for a, b in pairs), F.lit(0))
    return (F.col("n_a") - only_a >= needed) & (F.col("n_b") - only_b >= needed), F.col("n_a") - only_a, needed


def _suffixed(df: DataFrame, suffix: str) -> DataFrame:
    return df.select(*(F.col(c).alias(c + suffix) for c in df.columns))


def _with_hubs(entries: DataFrame, marks: DataFrame, turn: int, num: int, den: int, folder: str) -> DataFrame:
    """At most one pair ``(a, b)`` per set: with the likest of the hubs that it shares most buckets with."""
    dice = F.xxhash64("node", "key", F.lit(turn))
    hubs = entries.groupBy("key").agg(F.min(F.struct(dice.alias("dice"), "node", "n", "component")).alias("hub"))
    offers = (
        entries.join(stage(hubs, f"offers{turn}", folder), "key")
        .select("node", "n", "component", F.col("hub.node").alias("hub"), F.col("hub.n").alias("m"),
                F.col("hub.component").alias("other"))
        .where((F.col("component") != F.col("other")) & _close("n", "m", num, den))
    )
    weighed = offers.groupBy("node", "hub").agg(F.count("*").alias("shared"))
    order = Window.partitionBy("node").orderBy(F.desc("shared"), "hub")
    few = weighed.withColumn("place", F.row_number().over(order)).where(F.col("place") <= HUBS)
    both = few.select(F.col("node").alias("node_a"), F.col("hub").alias("node_b")).join(
        _suffixed(marks, "_a"), "node_a").join(_suffixed(marks, "_b"), "node_b")
    possible, most, _ = _may_link(num, den)
    best = both.where(possible).groupBy("node_a").agg(F.max(F.struct(most.alias("most"), "node_b")).alias("best"))
    return best.select(F.col("node_a").alias("a"), F.col("best.node_b").alias("b"))


def _between(entries: DataFrame, marks: DataFrame, num: int, den: int, limit: int) -> DataFrame:
    """All pairs ``(a, b)`` of sets of different components that share a bucket and may link by their bitmaps
    (``marks``) and places.

    A pair is taken from the first bucket it shares, as far as the first ``FIRST_KEYS`` buckets of its sets tell;
    if these have none in common, from every bucket it shares, and repeated pairs are dropped. What stands before
    the first common shingle in a front is not shared; that is asked of large sets only (above ``limit``), whose
    places are those of shingles and order their buckets. The buckets of small sets are ordered by their keys, which are
    hashes: near copies differ in the rare shingles at their fronts, but of equal shares the least hashes mostly agree.
    """
    order = Window.partitionBy("node").orderBy(F.when(F.col("n") > limit, F.col("place")), "key")
    ranked = entries.select("node", "n", "place", "key").withColumn("rank", F.row_number().over(order))
    listed = F.sort_array(F.collect_list(F.struct("rank", "key")))["key"]
    first = ranked.where(F.col("rank") <= FIRST_KEYS).groupBy("node").agg(listed.alias("first"))
    rows = entries.join(marks.join(first, "node"), "node")
    possible, _, needed = _may_link(num, den)
    earliest = F.get(F.array_intersect("first_a", "first_b"), F.lit(0))
    both_large = F.least("n_a", "n_b") > limit
    most = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
    joined = (
        (F.col("key_a") == F.col("key_b")) & (F.col("node_a") < F.col("node_b"))
        & (F.col("component_a") != F.col("component_b")) & _close("n_a", "n_b", num, den)
        & (~both_large | (most >= needed)) & possible & F.coalesce(earliest == F.col("key_a"), F.lit(True))
    )
    pairs = _suffixed(rows, "_a").join(_suffixed(rows, "_b"), joined)
    return pairs.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()


def one_per_class(docs: DataFrame, words: int = 5, num: int = 8, den: int = 10, id_column: str = "doc_id",
                  text: str = "text", scan: bool = False) -> DataFrame:
    """``docs`` with exactly one row of each class, the one of the smallest id; a null id is larger than all others,
    and of several rows with one id the first read stays. Every row without words stays.

    ``scan`` says that ``docs`` is a table read from files, at most with columns chosen: its rows are then known by
    file and place. Any other frame is written to the shared folder first.
    """
    spark = docs.sparkSession
    docs = docs if scan else stage(docs, "docs")
    place = docs.metadataColumn("_metadata")
    # Files are numbered, so that a row has a number: one entry per file is sent to the tasks.
    files = sorted(r[0] for r in docs.select(place["file_path"].alias("f")).distinct().collect())
    numbered = F.broadcast(small_table(spark, {"__file": files, "__number": list(range(len(files)))})) if files else None
    if numbered is None:
        return docs
    key = F.shiftleft(F.col("__number"), FILE_ROWS_BITS) + F.col("__row")
    rows = docs.select("*", place["file_path"].alias("__file"), place["row_index"].alias("__row")).join(numbered, "__file")
    rows = rows.withColumn("__key", key).drop("__file", "__number", "__row")

    classes = jaccard_classes(rows, words, num, den, "__key", text).select(
        F.col("doc_id").alias("__key"), F.col("component_id").alias("__class"), F.col("n_shingles").alias("__n"))
    ids = rows.select("__key", quoted(id_column).alias("__id"))
    least = F.min(F.struct(F.col("__id").isNull().alias("none"), "__id", "__key"))
    chosen = classes.where("__n > 0").join(ids, "__key").groupBy("__class").agg(least.alias("least"))
    kept = chosen.select("least.__key").union(classes.where("__n = 0").select("__key"))
    return rows.join(kept.hint("shuffle_hash"), "__key", "left_semi").drop("__key")
