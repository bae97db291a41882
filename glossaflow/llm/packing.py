"""Token-id output: texts packed into rows of a fixed length, written as binary matrices.

Texts are encoded, cut losslessly into pieces of at most ``row_length`` ids, and the pieces of a shard are packed
best-fit decreasing: from the longest on, each goes to the open row with the least room that still takes it. That
row is found in a segment tree over capacities: leaf c tells whether rows with c places left exist; the search for
the smallest such c not below the piece's length goes up and down the tree in O(log row_length).

A shard is what a task reads until ``SHARD_TOKENS`` ids are gathered, so memory is bounded, no row is moved and
no shuffle takes place; at this size the last rows of a shard waste far less than a thousandth.

A result row is a packed row: ``shard`` (file, offset, partition and number), ``row``, ``n_tokens``, ``input_ids`` (little-endian
uint16 or uint32, filled up with ``pad_id``), ``cu_seqlens`` (cumulative piece lengths, from 0), ``position_ids``
(same width as the ids; starts again at 0 with every piece and for the padding), and ``segments`` with document,
piece number and length in order of their place.

Results: texts that are null or give no ids take part in no row. Pieces of equal length are taken in the order in
which they were read; repeated documents are packed each. An empty table gives no rows.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossaflow.llm.common import quoted, text_slices, worker_state

ROW_LENGTH = 2048
SHARD_TOKENS = 4_000_000
SCHEMA = (
    "shard string, row int, n_tokens int, input_ids binary, position_ids binary, cu_seqlens array<int>, "
    "segments array<struct<doc_id: bigint, piece: int, length: int>>"
)
_SEGMENTS = pa.list_(pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("length", pa.int32())]))


class RoomTree:
    """Which capacities 1..size have open rows: a segment tree, stored as a heap."""

    def __init__(self, size: int):
        self.base = 1 << size.bit_length()
        self.some = bytearray(2 * self.base)

    def put(self, capacity: int, there: bool) -> None:
        node = self.base + capacity
        self.some[node] = there
        while node > 1:
            node >>= 1
            now = self.some[2 * node] or self.some[2 * node + 1]
            if self.some[node] == now:
                return
            self.some[node] = now

    def least(self, capacity: int) -> int | None:
        """The smallest capacity in use that is not below ``capacity``."""
        node = self.base + capacity
        if self.some[node]:
            return capacity
        while node > 1 and (node & 1 or not self.some[node + 1]):
            node >>= 1
        if node <= 1:
            return None
        node += 1
        while node < self.base:
            node = 2 * node if self.some[2 * node] else 2 * node + 1
        return node - self.base


def best_fit_decreasing(lengths: list[int], row_length: int) -> list[list[int]]:
    """Numbers of the pieces in each row. Every length is between 1 and ``row_length``."""
    order = np.argsort(-np.asarray(lengths, np.int64), kind="stable").tolist()
    rows: list[list[int]] = []
    room: list[list[int]] = [[] for _ in range(row_length + 1)]
    tree = RoomTree(row_length)
    for number in order:
        length = lengths[number]
        found = tree.least(length)
        if found is None:
            row, left = len(rows), row_length - length
            rows.append([number])
        else:
            row, left = room[found].pop(), found - length
            if not room[found]:
                tree.put(found, False)
            rows[row].append(number)
        if left:
            room[left].append(row)
            if len(room[left]) == 1:
                tree.put(left, True)
    return rows


def _encoder(content: bytes, pattern: str) -> Callable[[list[str]], list[list[int]]]:
    import tiktoken

    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines())}
    encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return lambda texts: [encoding.encode_ordinary(text) for text in texts]


def _packed(shard: str, pieces: list[tuple[int | None, int, np.ndarray]], row_length: int, pad: int, kind) -> Iterable:
    """Record batches of packed rows, some hundred rows each."""
    rows = best_fit_decreasing([len(ids) for _, _, ids in pieces], row_length)
    count = np.arange(row_length, dtype=kind)
    for start in range(0, len(rows), 512):
        part = rows[start : start + 512]
        matrix = np.full((len(part), row_length), pad, kind)
        places = np.zeros((len(part), row_length), kind)
        used, ends, segments = [], [], []
        for i, members in enumerate(part):
            at, bounds, inside = 0, [0], []
            for number in members:
                doc, piece, ids = pieces[number]
                matrix[i, at : at + len(ids)] = ids
                places[i, at : at + len(ids)] = count[: len(ids)]
                at += len(ids)
                bounds.append(at)
                inside.append({"doc_id": doc, "piece": piece, "length": len(ids)})
            places[i, at:] = count[: row_length - at]
            used.append(at)
            ends.append(bounds)
            segments.append(inside)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([shard] * len(part), pa.string()),
                pa.array(range(start, start + len(part)), pa.int32()),
                pa.array(used, pa.int32()),
                pa.array([row.tobytes() for row in matrix], pa.binary()),
                pa.array([row.tobytes() for row in places], pa.binary()),
                pa.array(ends, pa.list_(pa.int32())),
                pa.array(segments, _SEGMENTS),
            ],
            ["shard", "row", "n_tokens", "input_ids", "position_ids", "cu_seqlens", "segments"],
        )


def pack(docs: DataFrame, ranks_path: str, pattern: str, row_length: int = ROW_LENGTH, pad_id: int | None = None,
         id_column: str = "doc_id", text: str = "text", shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Packed rows of ``docs``. ``pad_id`` is the first id beyond the vocabulary if not given."""
    with open(ranks_path, "rb") as file:
        content = file.read()
    vocabulary = max((int(line.split()[1]) for line in content.splitlines()), default=-1) + 1
    pad = vocabulary if pad_id is None else pad_id
    kind = np.dtype("<u2") if max(vocabulary, pad, row_length) < 1 << 16 else np.dtype("<u4")
    shared = docs.sparkSession.sparkContext.broadcast(content)
    # The partition tells tasks apart that read no file, or files of one name.
    origin = F.concat_ws(":", F.regexp_extract(F.input_file_name(), "[^/]*$", 0), F.input_file_block_start(),
                         F.spark_partition_id())
    rows = docs.select(quoted(id_column).cast("long").alias("doc_id"), quoted(text).alias("text"), origin.alias("origin"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = worker_state("packing", pattern, lambda: _encoder(shared.value, pattern))
        pieces, gathered, shards, origin = [], 0, 0, ""
        for batch in text_slices(batches):
            origin = origin or batch.column("origin")[0].as_py()
            texts = [value or "" for value in batch.column("text").to_pylist()]
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encode(texts)):
                flat = np.array(ids, kind)
                pieces += [(doc, n, flat[at : at + row_length]) for n, at in enumerate(range(0, len(flat), row_length))]
                gathered += len(flat)
                if gathered >= shard_tokens:
                    yield from _packed(f"{origin}:{shards}", pieces, row_length, pad, kind)
                    pieces, gathered, shards = [], 0, shards + 1
        if pieces:
            yield from _packed(f"{origin}:{shards}", pieces, row_length, pad, kind)

    return rows.mapInArrow(run, SCHEMA)


def unpack(packed: DataFrame, row_length: int = ROW_LENGTH) -> DataFrame:
    """``(doc_id, piece, ids)``: the pieces again, from packed rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, pieces, ids = [], [], []
            for row in batch.to_pylist():
                kind = "<u2" if len(row["input_ids"]) == 2 * row_length else "<u4"
                flat = np.frombuffer(row["input_ids"], kind)
                for segment, start, end in zip(row["segments"], row["cu_seqlens"], row["cu_seqlens"][1:]):
                    docs.append(segment["doc_id"])
                    pieces.append(segment["piece"])
                    ids.append(flat[start:end].astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(pieces, pa.int32()), pa.array(ids, pa.list_(pa.int32()))],
                ["doc_id", "piece", "ids"],
            )

    return packed.select("input_ids", "cu_seqlens", "segments").mapInArrow(run, "doc_id long, piece int, ids array<int>")


def write_packed(packed: DataFrame, path: str) -> None:
    """Write packed rows as Parquet: matrices, cumulative lengths and resets side by side, a file per task."""
    packed.write.mode("overwrite").parquet(path)
