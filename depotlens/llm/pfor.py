"""Operator 7: token-ID files of patched frame-of-reference blocks.

The documents are range partitioned and sorted by doc_id; each task encodes
its texts, appends the end id, and writes segments (rows of a Parquet table,
the only files that executors of any store can write and read). A segment
holds whole documents, its ids in blocks of 256:

    magic "PFR1" | n_ids u32 | n_blocks u32
    block minima u32[] | widths u8[] | exceptions per block u16[] | block starts u32[]
    packed words (each block from its start, ``width`` bits an id, lowest bit first)
    exception places u8[] | exception high parts u32[]

The width of a block is the one that holds a given percentile of its ids less
the minimum; the high parts of the others stand in the exception lists. Block
starts make any block readable without the ones before it.

* null and empty texts: the end id only. null doc_id: sorts first.
* ties and repeated rows: rows with one doc_id stand in text order.
* an empty table gives empty files; extra columns are not carried.
* a segment holds about ``SEGMENT_IDS`` ids, or one longer document.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from depotlens.llm.common import with_package
from depotlens.llm.tokens import library_encoder, slices, with_end

BLOCK = 256
SEGMENT_IDS = 1 << 18
PERCENTILE = 90
_MAGIC = b"PFR1"


def pack(ids: np.ndarray, percentile: int = PERCENTILE) -> bytes:
    """One segment."""
    n, blocks = len(ids), -(-len(ids) // BLOCK)
    filled = np.zeros(blocks * BLOCK, np.uint32)
    filled[:n] = ids
    if n:
        filled[n:] = ids[-1]
    rows = filled.reshape(blocks, BLOCK)
    low = rows.min(axis=1) if blocks else np.empty(0, np.uint32)
    rest = rows - low[:, None]
    limit = np.sort(rest, axis=1)[:, BLOCK * percentile // 100 - 1] if blocks else low
    widths = np.zeros(blocks, np.uint8)
    for w in range(32):
        widths += (limit >> np.uint32(w)) > 0
    high = rest >> widths[:, None].astype(np.uint32) if blocks else rest
    where, places = np.nonzero(high)
    sizes = widths.astype(np.int64) * (BLOCK // 8)
    starts = np.cumsum(sizes) - sizes
    packed = np.zeros(int(sizes.sum()), np.uint8)
    for w in np.unique(widths[widths > 0]).tolist():
        own = np.flatnonzero(widths == w)
        bits = ((rest[own][:, :, None] >> np.arange(w, dtype=np.uint32)) & np.uint32(1)).astype(np.uint8)
        words = np.packbits(bits.reshape(len(own), -1), axis=1, bitorder="little")
        packed[(starts[own][:, None] + np.arange(words.shape[1])).ravel()] = words.ravel()
    head = np.array([n, blocks], "<u4").tobytes()
    counts = np.bincount(where, minlength=blocks).astype("<u2")
    return b"".join((
        _MAGIC, head, low.astype("<u4").tobytes(), widths.tobytes(), counts.tobytes(), starts.astype("<u4").tobytes(),
        packed.tobytes(), places.astype(np.uint8).tobytes(), high[where, places].astype("<u4").tobytes()))


def unpack(segment: bytes) -> np.ndarray:
    """The ids of a segment."""
    if segment[:4] != _MAGIC:
        raise ValueError("not a segment of packed ids")
    n, blocks = np.frombuffer(segment, "<u4", 2, 4).tolist()
    at = 12
    parts = []
    for kind in ("<u4", "u1", "<u2", "<u4"):
        parts.append(np.frombuffer(segment, kind, blocks, at))
        at += parts[-1].nbytes
    low, widths, counts, starts = parts
    total = int(widths.astype(np.int64).sum()) * (BLOCK // 8)
    packed = np.frombuffer(segment, np.uint8, total, at)
    at += total
    exceptions = int(counts.sum())
    places = np.frombuffer(segment, np.uint8, exceptions, at)
    high = np.frombuffer(segment, "<u4", exceptions, at + exceptions)
    rest = np.zeros((blocks, BLOCK), np.uint32)
    for w in np.unique(widths[widths > 0]).tolist():
        own = np.flatnonzero(widths == w)
        words = packed[starts[own].astype(np.int64)[:, None] + np.arange(w * (BLOCK // 8))]
        bits = np.unpackbits(words, axis=1, bitorder="little").reshape(len(own), BLOCK, w)
        value = np.zeros((len(own), BLOCK), np.uint32)
        for b in range(w):
            value |= bits[:, :, b].astype(np.uint32) << np.uint32(b)
        rest[own] = value
    where = np.repeat(np.arange(blocks), counts)
    rest[where, places] |= high.astype(np.uint32) << widths[where].astype(np.uint32)
    return (rest + low[:, None]).ravel()[:n]


SEGMENTS = "file int, segment int, file_start long, doc_ids array<long>, doc_sizes array<long>, ids binary"
_SCHEMA = pa.schema([("file", pa.int32()), ("segment", pa.int32()), ("file_start", pa.int64()),
                     ("doc_ids", pa.list_(pa.int64())), ("doc_sizes", pa.list_(pa.int64())), ("ids", pa.binary())])


def write_files(df: DataFrame, path: str, tokenizer: str, end_id: int = 0) -> None:
    """The table's ids in ascending doc_id order as segments below ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = library_encoder(tokenizer)
        file, number, start = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            for part in slices(batch):
                ids, sizes = with_end(*pieces.texts(part.column(1)), end_id)
                ends = np.cumsum(sizes)
                cuts = [0, *(np.flatnonzero(np.diff(ends // SEGMENT_IDS)) + 1).tolist(), len(sizes)]
                for a, b in zip(cuts, cuts[1:]):
                    if b == a:
                        continue
                    first = int(ends[a] - sizes[a])
                    yield pa.RecordBatch.from_arrays([
                        pa.array([file], pa.int32()), pa.array([number], pa.int32()), pa.array([start + first], pa.int64()),
                        pa.array([part.column(0).slice(a, b - a).to_pylist()], pa.list_(pa.int64())),
                        pa.array([sizes[a:b].tolist()], pa.list_(pa.int64())),
                        pa.array([pack(ids[first:int(ends[b - 1])])], pa.binary())], schema=_SCHEMA)
                    number += 1
                start += int(ends[-1])

    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    (with_package(rows).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
     .mapInArrow(run, SEGMENTS).write.option("compression", "none").parquet(path))


def read_files(spark, path: str, end: str = "ids") -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files, read
    from the packed ids; with end="ids" also its ids, little-endian."""
    segments = spark.read.schema(SEGMENTS).parquet(path)
    fields = [("file", pa.int32()), ("doc_id", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    if end == "ids":
        fields.append(("ids", pa.binary()))
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                file, _, start, docs, sizes, packed = (batch.column(k)[i] for k in range(6))
                ids = unpack(packed.as_py()).astype("<u4")
                sizes = sizes.values.to_numpy(zero_copy_only=False)
                ends = np.cumsum(sizes)
                view = memoryview(ids).cast("B")
                held = [view[4 * (e - n):4 * e] for e, n in zip(ends.tolist(), sizes.tolist())]
                columns = [pa.repeat(pa.scalar(file.as_py(), pa.int32()), len(sizes)), docs.values,
                           pa.array(start.as_py() + ends - sizes), pa.array(sizes), pa.array(list(map(zlib.crc32, held)), pa.int64())]
                if end == "ids":
                    columns.append(pa.array([bytes(h) for h in held], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    kinds = {"file": "int", "doc_id": "long", "at": "long", "n_tokens": "long", "ids_crc32": "long", "ids": "binary"}
    docs = with_package(segments).mapInArrow(run, ", ".join(f"{n} {kinds[n]}" for n, _ in fields))
    # one row per file: ids of all files before it
    totals = segments.groupBy("file").agg(F.sum(F.expr("aggregate(doc_sizes, 0L, (a, n) -> a + n)")).alias("held"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("file", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("before"))
    out = docs.join(F.broadcast(offsets), "file")
    return out.select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32",
                      *(["ids"] if end == "ids" else []))
