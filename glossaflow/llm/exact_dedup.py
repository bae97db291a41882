"""Exact duplicates by an exchange of Golomb-coded fingerprints.

1. Every task takes a fingerprint of each of its texts: the leading bits of the SHA-256, just wide enough that few
   different texts share one. It sorts them, keeps each once and sends every owner (a range of fingerprints) one
   message: the gaps between its sorted fingerprints as a Golomb code, with the row each stands for. Rows whose
   fingerprint the task has already seen twice itself need no owner; they are marked at once.
2. An owner decodes its messages and finds the fingerprints that several of them hold. Each file gets back one bit
   per row: whether another row has the same fingerprint.
3. Rows without that bit have no copy, and their text never moved. The others are suspects: their texts are grouped
   by their bytes, which is the verification (copies are combined inside each task before the shuffle), and every
   suspect row is joined with the outcome of its group.

Rows are known by file and place in the file, so the table read must be files; other frames are written once first.
Bitmaps are one bit a row. They are broadcast in waves: a wave is a set of files whose bitmaps are below
``WAVE_BYTES``, and scans these files only. A file with more rows than that is a wave of its own.

Memory: a task holds 16 bytes per row it reads in step 1, and about 40 per fingerprint of its range in step 2. A text that
makes up a third of all rows is one fingerprint per task in step 1, one row per task in the grouping, and a key of a
join whose two sides adaptive execution can split in step 3. Every step can be repeated after a lost executor.

Results: one row per input row. Null counts as empty; texts are not changed before they are compared. Of equal texts
the row with the largest id stays, a null id being the smallest; of several rows with that id exactly one stays. An
empty table gives an empty table. Only the id and text columns are read, whatever the others are called.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossaflow.llm.common import quoted
from glossaflow.scratch import scratch_folder, stage

# Bits of a fingerprint beyond those that count the rows: one row in 2^10 is suspected wrongly.
SPARE_BITS = 10
# The leading hexadecimal digits of a SHA-256 that fit a positive long.
HEX_DIGITS = 15
# Fingerprints of one owner at most; there are at least as many owners as shuffle partitions.
OWNER_HASHES = 1 << 20
# Rows of one bitmap, which is what Spark's bitmap functions hold.
BITMAP_ROWS = 32_768
WAVE_BYTES = 32 << 20
MESSAGE = "owner int, file string, base bigint, n int, parameter int, high binary, rest binary, rows binary"
MARKS = "file string, rows array<bigint>"


def golomb_encode(values: np.ndarray, start: int) -> tuple[int, bytes, bytes]:
    """``(parameter, quotients, remainders)`` of the gaps between sorted distinct ``values``, the first from ``start``.

    A Golomb code whose divisor is the power of two ``2 ** parameter`` next to what suits the mean gap. Quotients
    are in unary, remainders in ``parameter`` bits each; they are kept apart, so that both decode as arrays.
    """
    gaps = np.diff(values, prepend=start)
    parameter = max(0, int(np.log2(max(1.0, float(gaps.mean()) * np.log(2)))))
    quotients, rest = gaps >> parameter, gaps & ((1 << parameter) - 1)
    ends = np.cumsum(quotients + 1) - 1
    unary = np.ones(int(ends[-1]) + 1, np.uint8)
    unary[ends] = 0
    places = np.arange(parameter - 1, -1, -1, dtype=np.int64)
    binary = (rest[:, None] >> places) & 1
    return parameter, np.packbits(unary).tobytes(), np.packbits(binary.astype(np.uint8)).tobytes()


def golomb_decode(n: int, start: int, parameter: int, high: bytes, rest: bytes) -> np.ndarray:
    """The ``n`` values that :func:`golomb_encode` was given."""
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(high, np.uint8)) == 0)[:n]
    gaps = (np.diff(ends, prepend=-1) - 1).astype(np.int64) << parameter
    if parameter:
        bits = np.unpackbits(np.frombuffer(rest, np.uint8), count=n * parameter).reshape(n, parameter)
        gaps += bits.astype(np.int64) @ (1 << np.arange(parameter - 1, -1, -1, dtype=np.int64))
    return start + np.cumsum(gaps)


def _messages(fingerprints: np.ndarray, rows: np.ndarray, file: str, width: int) -> Iterator[tuple]:
    """What one task has to say of one file: a message per owner, and the rows it knows to have copies."""
    order = np.argsort(fingerprints, kind="stable")
    values, rows = fingerprints[order], rows[order]
    first = np.flatnonzero(np.diff(values, prepend=-1))
    copies = np.diff(np.append(first, len(values))) > 1
    base = int(rows.min())
    known = np.repeat(copies, np.diff(np.append(first, len(values))))
    if known.any():
        # a number below 0 deals these marks out among the owners, who pass them on
        lot = -1 - zlib.crc32(f"{file}:{base}".encode()) // 2
        yield lot, file, base, 0, 0, b"", b"", (rows[known] - base).astype("<u4").tobytes()
    values, rows = values[first], rows[first] - base
    owners = values // width
    cuts = np.flatnonzero(np.diff(owners, prepend=-1))
    for begin, end in zip(cuts, np.append(cuts[1:], len(values))):
        owner = int(owners[begin])
        code = golomb_encode(values[begin:end], owner * width)
        yield owner, file, base, int(end - begin), *code, rows[begin:end].astype("<u4").tobytes()


def send_messages(rows: DataFrame, width: int) -> DataFrame:
    """The messages of all tasks about ``(file, row, fingerprint)``."""
    schema = pa.schema([("owner", pa.int32()), ("file", pa.string()), ("base", pa.int64()), ("n", pa.int32()),
                        ("parameter", pa.int32()), ("high", pa.binary()), ("rest", pa.binary()), ("rows", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        for batch in batches:
            files = batch.column("file").dictionary_encode()
            codes = files.indices.to_numpy(zero_copy_only=False)
            values = batch.column("fingerprint").to_numpy(zero_copy_only=False)
            places = batch.column("row").to_numpy(zero_copy_only=False)
            for code, name in enumerate(files.dictionary.to_pylist()):
                here = codes == code
                held.setdefault(name, []).append((values[here], places[here]))
        for name, parts in held.items():
            for message in _messages(*(np.concatenate(p) for p in zip(*parts)), name, width):
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(message, schema)], schema=schema)

    return rows.mapInArrow(run, MESSAGE)


def answer_messages(messages: DataFrame, width: int) -> DataFrame:
    """``(file, rows)``: the rows whose fingerprint other rows have too, in lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, values = [], []
        for batch in batches:
            for m in batch.to_pylist():
                places = np.frombuffer(m["rows"], "<u4").astype(np.int64) + m["base"]
                if m["owner"] < 0:
                    yield _marks(m["file"], places)
                    continue
                asked.append((m["file"], places))
                values.append(golomb_decode(m["n"], m["owner"] * width, m["parameter"], m["high"], m["rest"]))
        if not asked:
            return
        _, which, counts = np.unique(np.concatenate(values), return_inverse=True, return_counts=True)
        shared = counts[which] > 1
        at = 0
        for (file, places), found in zip(asked, values):
            bits = shared[at:at + len(found)]
            at += len(found)
            if bits.any():
                yield _marks(file, places[bits])

    return messages.repartition("owner").mapInArrow(run, MARKS)


def _marks(file: str, rows: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([file]), pa.array([rows], pa.list_(pa.int64()))], ["file", "rows"])


def _waves(sizes: list[tuple[str, int]]) -> list[list[str]]:
    """Files in order, cut where their bitmaps exceed ``WAVE_BYTES``."""
    waves, used = [[]], 0
    for file, n in sizes:
        if waves[-1] and used + n > WAVE_BYTES:
            waves.append([])
            used = 0
        waves[-1].append(file)
        used += n
    return waves


def suspects(rows: DataFrame, n: int) -> DataFrame:
    """``(file, bucket, bitmap)``: a bit per row whose fingerprint occurs again; written. ``n`` counts the rows."""
    spark = rows.sparkSession
    bits = min(4 * HEX_DIGITS, max(n, 2).bit_length() + SPARE_BITS)
    owners = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // OWNER_HASHES))
    width = -(-(1 << bits) // owners)
    lead = F.conv(F.substring("sha256", 1, HEX_DIGITS), 16, 10).cast("long")
    prints = rows.select("file", "row", F.shiftright(lead, 4 * HEX_DIGITS - bits).alias("fingerprint"))
    marked = answer_messages(send_messages(prints, width), width).select("file", F.explode("rows").alias("row"))
    bucket, place = F.expr(f"row div {BITMAP_ROWS}"), F.expr(f"row % {BITMAP_ROWS}")
    bitmaps = marked.groupBy("file", bucket.alias("bucket")).agg(F.bitmap_construct_agg(place).alias("bitmap"))
    return stage(bitmaps, "bitmaps")


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", scan: bool = False) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``, one row per row of ``docs``.

    ``scan`` says that ``docs`` is a table read from files, at most with columns chosen; any other frame is written
    to the shared folder first. Runs jobs at once; the result is a read of written tables.
    """
    spark = docs.sparkSession
    docs = docs.select(quoted(id_column).alias("doc_id"), F.coalesce(quoted(text), F.lit("")).alias("text"))
    if not scan:
        docs = stage(docs, "docs")
    place = docs.metadataColumn("_metadata")
    rows = docs.select(
        "doc_id", "text", F.sha2("text", 256).alias("sha256"),
        place["file_path"].alias("file"), place["row_index"].alias("row"),
    )
    bitmaps = suspects(rows, docs.count())
    sizes = bitmaps.groupBy("file").agg(F.count("*").alias("n")).orderBy("file")
    waves = _waves([(r["file"], r["n"] * BITMAP_ROWS // 8) for r in sizes.toLocalIterator()])

    folder = scratch_folder(spark)
    rows = rows.withColumn("bucket", F.expr(f"row div {BITMAP_ROWS}"))
    byte = F.conv(F.hex(F.expr(f"substring(bitmap, cast(row % {BITMAP_ROWS} div 8 as int) + 1, 1)")), 16, 10).cast("long")
    again = F.coalesce(F.getbit(byte, F.expr("cast(row % 8 as int)")) == 1, F.lit(False))
    narrow = ["doc_id", "file", "row", "sha256", "again"]
    verified = []
    for i, files in enumerate(waves):
        wave, bits = rows, bitmaps
        if len(waves) > 1:
            # files without a suspect are in no wave; the first scan takes them along
            later = [f for w in waves[1:] for f in w]
            wave = rows.where(~F.col("file").isin(later) if i == 0 else F.col("file").isin(files))
            bits = bitmaps.where(F.col("file").isin(files))
        marked = wave.join(F.broadcast(bits), ["file", "bucket"], "left").withColumn("again", again)
        marked.select(*narrow).write.mode("append").parquet(f"{folder}/rows")
        copies = marked.where("again").groupBy("sha256", "text").agg(
            F.max(F.struct("doc_id", "file", "row")).alias("top"), F.count("*").alias("n"))
        verified.append(copies if len(waves) == 1 else stage(copies, f"texts_{i}", folder))
    if len(waves) > 1:
        every = reduce(DataFrame.unionByName, verified)
        verified = [every.groupBy("sha256", "text").agg(F.max("top").alias("top"), F.sum("n").alias("n"))]
    groups = stage(verified[0].select("sha256", "top", "n"), "groups", folder)
    if not groups.groupBy("sha256").count().where("count > 1").isEmpty():
        raise ValueError("different texts share a SHA-256")

    kept = spark.read.schema(marked.select(*narrow).schema).parquet(f"{folder}/rows")
    alone = kept.where("not again").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), F.col("sha256").alias("text_sha256"))
    together = kept.where("again").join(groups, "sha256", "left").select(
        "doc_id", F.col("top.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
        ((F.col("top.file") == F.col("file")) & (F.col("top.row") == F.col("row"))).alias("kept"),
        F.col("sha256").alias("text_sha256"))
    return alone.union(together)
