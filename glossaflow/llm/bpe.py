"""Byte-level BPE encoding and decoding with a rank queue under a hierarchical bitmap.

A pre-token starts as a linked list of bytes. Every neighbouring pair whose join is in the vocabulary stands in
the bucket of its merge rank, as the position of its left member. A bitmap of two levels over the ranks marks the
buckets in use: find-first-set on the root and then on a leaf gives the lowest rank in constant time, so a pre-token of n bytes costs O(n log n) at worst whatever it looks like. Entries whose pair has changed
meanwhile are stale and skipped. Ties within a rank go to the leftmost position.

Results: a null text encodes and decodes as an empty one; repeated rows are encoded each; an input column with
the name of a result column is replaced; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import heapq
import zlib
from collections.abc import Iterable
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from glossaflow.llm.common import map_batches, quoted, without, worker_state

# Pre-tokens remembered by a worker; the memory is emptied when full, which changes no result.
REMEMBERED = 800_000
_LONGEST_REMEMBERED = 64


_BIT = [1 << i for i in range(256)]


class RankQueue:
    """Positions by merge rank, under a bitmap of two levels: leaves of 256 ranks, and a root over the leaves.

    It is empty between pre-tokens, so one queue serves a worker for all of them. :meth:`Coder.encode_piece`
    works on the fields directly, since calls would cost more than the steps themselves.
    """

    def __init__(self, ranks: int):
        self.leaves = [0] * ((ranks >> 8) + 1)
        self.roots = [1 << i for i in range(len(self.leaves))]
        self.buckets: dict[int, list[int]] = {}


class Coder:
    """Encodes and decodes texts by a table of ranks (token bytes -> rank, which is also the id)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.queue = RankQueue(max(ranks.values(), default=0) + 1)
        self.split = regex.compile(pattern).findall
        self.known = _Remembered(self)

    def encode_piece(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one pre-token."""
        find = self.ranks.get
        whole = find(piece)
        if whole is not None:
            return (whole,)
        leaves, roots, buckets = self.queue.leaves, self.queue.roots, self.queue.buckets
        bit, push, pop = _BIT, heapq.heappush, heapq.heappop
        root = 0
        size = len(piece)
        after = list(range(1, size + 2))
        before = list(range(-1, size))
        pair = [find(piece[i : i + 2], -1) for i in range(size - 1)]
        pair.append(-1)
        for i, rank in enumerate(pair):
            if rank in buckets:
                push(buckets[rank], i)
            elif rank >= 0:
                buckets[rank] = [i]
                leaf = rank >> 8
                leaves[leaf] |= bit[rank & 255]
                root |= roots[leaf]
        while root:
            first = root & -root
            leaf = first.bit_length() - 1
            bits = leaves[leaf]
            lowest = bits & -bits
            rank = leaf << 8 | lowest.bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                i = pop(bucket)
            else:
                i = bucket[0]
                del buckets[rank]
                leaves[leaf] = bits = bits ^ lowest
                if not bits:
                    root ^= first
            if pair[i] != rank:  # stale
                continue
            middle = after[i]
            end = after[middle]
            after[i] = end
            before[end] = i
            pair[middle] = -1
            changed = ((i, after[end]),) if end < size else ()
            pair[i] = -1
            if i:
                changed += ((before[i], end),)
            for start, stop in changed:
                pair[start] = rank = find(piece[start:stop], -1)
                if rank in buckets:
                    push(buckets[rank], start)
                elif rank >= 0:
                    buckets[rank] = [start]
                    leaf = rank >> 8
                    leaves[leaf] |= bit[rank & 255]
                    root |= roots[leaf]
        ids, i = [], 0
        while i < size:
            end = after[i]
            ids.append(find(piece[i:end]))
            i = end
        return tuple(ids)

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        self.known.trim()
        return list(chain.from_iterable(map(self.known.__getitem__, self.split(text))))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class _Remembered(dict):
    """Ids by pre-token, worked out when first asked for."""

    def __init__(self, coder: Coder):
        super().__init__()
        self.coder = coder

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.coder.encode_piece(piece.encode())
        if len(piece) <= _LONGEST_REMEMBERED:
            self[piece] = ids
        return ids

    def trim(self) -> None:
        if len(self) > REMEMBERED:
            self.clear()


def read_ranks(path: str) -> bytes:
    """The rank file as it is; its size is that of a vocabulary, so it can be sent to every executor."""
    with open(path, "rb") as file:
        return file.read()


def parse_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines())}


def _coder(shared, pattern: str) -> Coder:
    content = shared.value
    key = pattern, len(content), zlib.crc32(content)
    return worker_state("bpe", key, lambda: Coder(parse_ranks(content), pattern))


def _id_lists(rows: list[list[int]]) -> pa.ListArray:
    offsets = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    flat = np.fromiter(chain.from_iterable(rows), np.int32, int(offsets[-1]))
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


_IDS = StructField("token_ids", ArrayType(IntegerType(), False), False)
_DECODED = StructField("decoded", BinaryType(), False)


def _with(docs: DataFrame, *fields: StructField) -> tuple[DataFrame, StructType]:
    kept = without(docs, *(f.name for f in fields))
    return kept, StructType([*kept.schema.fields, *fields])


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with the token ids of the column ``text`` as ``token_ids``. No shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    kept, schema = _with(docs, _IDS)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = _coder(shared, pattern)
        rows = [coder.encode(value) for value in batch.column(text).to_pylist()]
        return pa.RecordBatch.from_arrays([*batch.columns, _id_lists(rows)], [*batch.schema.names, "token_ids"])

    return map_batches(kept, run, schema, text)


def decode(docs: DataFrame, ranks_path: str, ids: str = "token_ids") -> DataFrame:
    """``docs`` with the bytes its ids stand for as ``decoded``. Null ids decode to no bytes; unknown ids fail."""
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    kept, schema = _with(docs, _DECODED)

    def run(batches):
        coder = _coder(shared, "")
        for batch in batches:
            rows = [coder.decode(value or ()) for value in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rows, pa.binary())], [*batch.schema.names, "decoded"]
            )

    return kept.mapInArrow(run, schema)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """Both steps in one pass: ``docs`` without ``text``, with ``token_ids`` and the ``decoded`` bytes of the ids."""
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    kept, _ = _with(docs, _IDS, _DECODED)
    names = [c for c in kept.columns if c != text]
    schema = StructType([*kept.select(*map(quoted, names)).schema.fields, _IDS, _DECODED])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = _coder(shared, pattern)
        rows = [coder.encode(value) for value in batch.column(text).to_pylist()]
        decoded = pa.array([coder.decode(ids) for ids in rows], pa.binary())
        return pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in names), _id_lists(rows), decoded], [*names, "token_ids", "decoded"]
        )

    return map_batches(kept, run, schema, text)
