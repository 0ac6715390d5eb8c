"""Operator 13: hard negatives by Hilbert-ordered blocks and zone maps.

Vectors become integers (floor(256 x)). A table's rows are sorted by (vector
length, label, Hilbert index of the dimensions that vary most) and written as
Parquet rows of ``BLOCK_ROWS`` vectors each; every block has a zone map (least
and largest value of every dimension, least and largest label). Anchors are
packed into chunks along the same order.

The score of anchor a with any row of a block lies between the sums over the
dimensions of min and max(a * low, a * high): two small matrix products per
chunk and page of zone maps. Two searches use these bounds:

* positives: the block that holds the anchor gives a first score to beat; only
  blocks whose upper bound reaches it and whose labels hold the anchor's are
  read, and the best ``positives`` rows of the same label are kept;
* negatives: each positive opens a window of scores; only blocks whose bounds
  meet a window and that hold another label are read, and the best
  ``negatives`` rows of each window are kept.

Chosen blocks meet their chunk in groups of (chunk, page of blocks), so every
group is bounded; what a group keeps is merged by window functions with a
group limit. No score of a pair leaves a task unless it may be among the best.

* rows with a null vec_id, label or vector, or a null or non-finite component
  take no part, nor do rows with a component of more than sqrt(2^62 / length)
  after scaling, whose scores might not fit a long.
* vectors of different lengths are never compared; empty vectors score 0.
* equal rows (vec_id, label, vector) count once. Rows that share only their
  vec_id all take part; a positive never has its anchor's vec_id.
* ties: smaller vec_id first. Anchors without a positive or negative give no
  row. Extra columns are not carried, whatever their names; an empty table
  gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depotlens.llm.common import with_package, written

SCALE = 256
BLOCK_ROWS = 512
CHUNK_ANCHORS = 256
CURVE_DIMS, CURVE_BITS = 10, 6
PAGE_ZONES = 256  # zone maps that one task bounds at a time
PAGE_BLOCKS = 16  # blocks that one group of a search reads at most, about
BUFFERED = 1 << 20

ROWS = "vec_id long, label long, dims int, anchor boolean, q binary"
BLOCKS = ("block long, dims int, n int, label_low long, label_high long, low binary, high binary, "
          "ids binary, labels binary, anchors binary, q binary")
CHUNKS = "chunk long, dims int, ids binary, labels binary, q binary, seeds binary"
NONE = -(1 << 63)  # no score to beat


def _matrix(data: bytes, dims: int, kind: str = "<i4") -> np.ndarray:
    n = dims * np.dtype(kind).itemsize
    return np.frombuffer(data, kind).reshape(len(data) // n if n else 0, dims)


def _values(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<i8")


def prepare(vectors: DataFrame, anchor: Column) -> DataFrame:
    """(vec_id, label, dims, anchor, q) of the rows that take part, each once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            x = pc.fill_null(lists.flatten().cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
            with np.errstate(over="ignore", invalid="ignore"):
                q = np.floor(SCALE * x)
                limit = np.minimum(np.sqrt(2.0 ** 62 / np.maximum(sizes, 1)), 2.0 ** 31 - 1)
                bad = ~(np.abs(q) <= np.repeat(limit, sizes))
            wrong = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[bad], minlength=len(sizes)) > 0
            q = np.where(bad, 0, q).astype("<i4")
            ends = np.cumsum(sizes)
            good = np.flatnonzero(~wrong)
            data = [q[ends[i] - sizes[i]:ends[i]].tobytes() for i in good.tolist()]
            take = pa.array(good)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(sizes[good], pa.int32()),
                 batch.column(2).take(take), pa.array(data, pa.binary())], names=["vec_id", "label", "dims", "anchor", "q"])

    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"), "embedding").where(
        "vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")
    return with_package(rows).mapInArrow(run, ROWS).distinct()


def spread(rows: DataFrame) -> list[tuple[int, float, float]]:
    """(dimension, low, high) of the dimensions that vary most, over all rows:
    the ranges that the curve's cells divide."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column(0).to_numpy()
            for d in np.unique(dims).tolist():
                data = batch.column(1).filter(pa.array(dims == d))
                m = _matrix(b"".join(data.to_pylist()), d).astype(np.float64)
                part = np.stack([np.full(d, len(m), np.float64), m.sum(0), (m * m).sum(0)])
                sums[d] = sums.get(d, 0) + part
        for d, part in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(d), pa.int32()), *map(pa.array, part)], names=["at", "n", "s", "ss"])

    one = with_package(rows.select("dims", "q").where("dims > 0")).mapInArrow(run, "at int, n double, s double, ss double")
    said = one.groupBy("at").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss")).select(
        "at", (F.col("s") / F.col("n")).alias("mean"),
        F.sqrt(F.greatest(F.col("ss") / F.col("n") - (F.col("s") / F.col("n")) ** 2, F.lit(0.0))).alias("dev"))
    top = said.orderBy(F.desc("dev"), "at").limit(CURVE_DIMS).collect()  # at most CURVE_DIMS rows
    return [(r["at"], r["mean"] - 2 * r["dev"], r["mean"] + 2 * r["dev"]) for r in top]


def hilbert_index(cells: np.ndarray, bits: int = CURVE_BITS) -> np.ndarray:
    """Place of every row of cells (each below 2^bits) on the Hilbert curve."""
    x = cells.astype(np.int64)
    dims = x.shape[1]
    if not dims:
        return np.zeros(len(x), np.int64)
    for level in range(bits - 1, 0, -1):  # undo the rotations, highest bit first
        low = (1 << level) - 1
        for i in range(dims):
            set_ = (x[:, i] >> level) & 1 == 1
            swap = np.where(set_, 0, (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(set_, low, swap)
            x[:, i] ^= swap
    for i in range(1, dims):  # Gray code of each level
        x[:, i] ^= x[:, i - 1]
    turn = np.zeros(len(x), np.int64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[:, -1] >> level) & 1 == 1, (1 << level) - 1, 0)
    x ^= turn[:, None]
    key = np.zeros(len(x), np.int64)
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            key = key << 1 | (x[:, i] >> level) & 1
    return key


def ordered(rows: DataFrame, ranges: list[tuple[int, float, float]]) -> DataFrame:
    """The rows range-partitioned and sorted by (dims, label, curve)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(2).to_numpy()
            key = np.zeros(len(batch), np.int64)
            for d in np.unique(dims).tolist():
                held = np.flatnonzero(dims == d)
                m = _matrix(b"".join(batch.column(4).take(pa.array(held)).to_pylist()), d)
                used = [r for r in ranges if r[0] < d]
                cells = np.empty((len(held), len(used)))
                for k, (at, low, high) in enumerate(used):
                    cells[:, k] = (m[:, at] - low) * ((1 << CURVE_BITS) / max(high - low, 1e-9))
                key[held] = hilbert_index(np.clip(cells, 0, (1 << CURVE_BITS) - 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key)], names=[*batch.schema.names, "curve"])

    keyed = with_package(rows).mapInArrow(run, f"{ROWS}, curve long")
    order = ["dims", "label", "curve", "vec_id"]
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order, "q")


def cut_blocks(rows: DataFrame, block_rows: int) -> DataFrame:
    """One row per block of consecutive rows of one vector length."""
    def block(number: int, batch: pa.RecordBatch) -> tuple:
        d = batch.column(2)[0].as_py()
        m = _matrix(b"".join(batch.column(4).to_pylist()), d) if d else np.empty((len(batch), 0), "<i4")
        labels = batch.column(1).to_numpy()
        return (number, d, len(batch), int(labels.min()), int(labels.max()), m.min(0).tobytes(), m.max(0).tobytes(),
                batch.column(0).to_numpy().astype("<i8").tobytes(), labels.astype("<i8").tobytes(),
                batch.column(3).to_numpy(zero_copy_only=False).tobytes(), m.tobytes())

    types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 6]
    names = [c.split()[0] for c in BLOCKS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        count = 0

        def flush():
            nonlocal number, held, count
            rows_ = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, count, number = [], 0, number + 1
            row = block(number - 1, rows_)
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)

        for batch in batches:
            dims = batch.column(2).to_numpy()
            at = 0
            while at < len(batch):
                if held and held[-1].column(2)[0].as_py() != dims[at]:
                    yield flush()
                same = int(np.searchsorted(dims[at:], dims[at], "right"))  # dims rise within the partition
                n = min(same, block_rows - count)
                held.append(batch.slice(at, n))
                at, count = at + n, count + n
                if count == block_rows:
                    yield flush()
        if held:
            yield flush()

    return with_package(rows.drop("curve")).mapInArrow(run, BLOCKS)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of a with those of b."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    most = int(np.abs(a.astype(np.int64)).max()) * int(np.abs(b.astype(np.int64)).max()) * a.shape[1]
    if most < 1 << 53:  # sums of whole numbers that a double holds exactly
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def cut_chunks(blocks: DataFrame, positives: int, chunk_anchors: int) -> DataFrame:
    """Anchors of consecutive blocks, with the score that the last of the
    ``positives`` best rows of the anchor's own block reaches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        dims = -1

        def flush(n: int):
            nonlocal number, held
            parts, held = held[:n], held[n:]
            number += 1
            columns = [number - 1, dims, *(b"".join(p[k] for p in parts) for k in range(4))]
            kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 4]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(columns, kinds)],
                                              names=[c.split()[0] for c in CHUNKS.split(", ")])

        for batch in batches:
            for r in batch.to_pylist():
                if r["dims"] != dims and held:
                    yield flush(len(held))
                dims = r["dims"]
                at = np.flatnonzero(np.frombuffer(r["anchors"], bool))
                if not len(at):
                    continue
                m = _matrix(r["q"], dims) if dims else np.empty((r["n"], 0), "<i4")
                ids, labels = _values(r["ids"]), _values(r["labels"])
                s = scores(m[at], m)
                s[(labels[at][:, None] != labels[None]) | (ids[at][:, None] == ids[None])] = NONE
                seeds = np.sort(s, 1)[:, -positives] if r["n"] >= positives else np.full(len(at), NONE)
                held += [(ids[i:i + 1].tobytes(), labels[i:i + 1].tobytes(), m[i].tobytes(), np.int64(seed).tobytes())
                         for i, seed in zip(at.tolist(), seeds.tolist())]
                while len(held) >= chunk_anchors:
                    yield flush(chunk_anchors)
        if held:
            yield flush(len(held))

    return with_package(blocks.select("dims", "n", "ids", "labels", "anchors", "q")).mapInArrow(run, CHUNKS)


def bounds(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score that each anchor can have with each zone, by
    interval arithmetic (widened by far more than the rounding)."""
    up, down = np.maximum(q, 0).astype(np.float64), np.minimum(q, 0).astype(np.float64)
    low, high = low.astype(np.float64), high.astype(np.float64)
    slack = 1e-10 * (np.abs(q).astype(np.float64) @ np.maximum(np.abs(low), np.abs(high)).T)
    return up @ low.T + down @ high.T - slack, up @ high.T + down @ low.T + slack


def _windows(row: dict, n: int, positives: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score of the window of each (anchor, positive); empty
    ones have the largest below the least."""
    least, most = np.full((n, positives), 1, np.int64), np.zeros((n, positives), np.int64)
    for p in row["found"]:
        least[p["slot"], p["place"] - 1] = -(-low * p["score"] // 100)
        most[p["slot"], p["place"] - 1] = high * p["score"] // 100
    return least, most


def _meets(row: dict, dims: int, zone: dict, search) -> np.ndarray:
    """Which zones of a page any anchor of the chunk must read."""
    q = _matrix(row["q"], dims) if dims else np.empty((len(row["ids"]) // 8, 0), "<i4")
    least, most = bounds(q, zone["low"], zone["high"])
    labels = _values(row["labels"])[:, None]
    if search is None:
        fits = (labels >= zone["label_low"]) & (labels <= zone["label_high"])
        return (fits & (most >= _values(row["seeds"])[:, None].astype(np.float64))).any(0)
    other = (labels != zone["label_low"]) | (labels != zone["label_high"])
    from_, to = _windows(row, len(q), *search)
    need = np.zeros(least.shape, bool)
    for k in range(from_.shape[1]):
        need |= (from_[:, k] <= to[:, k])[:, None] & (most >= from_[:, k, None]) & (least <= to[:, k, None])
    return (need & other).any(0)


def choose(chunks: DataFrame, blocks: DataFrame, pages: int, search=None) -> DataFrame:
    """(chunk, block): the blocks that the chunk's anchors must read."""
    zones = blocks.select(
        F.pmod(F.xxhash64("block"), F.lit(pages)).alias("page"),
        F.struct("block", "dims", "label_low", "label_high", "low", "high").alias("zone")).groupBy("page").agg(
        F.collect_list("zone").alias("zones"))  # about PAGE_ZONES each
    asked = chunks.withColumn("page", F.explode(F.sequence(F.lit(0), F.lit(pages - 1)).cast("array<long>")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1).to_pylist()[0]
                d = row["dims"]
                held = [z for z in row["zones"] if z["dims"] == d]
                if not held:
                    continue
                zone = {k: np.array([z[k] for z in held], np.int64) for k in ("block", "label_low", "label_high")}
                zone |= {k: np.frombuffer(b"".join(z[k] for z in held), "<i4").reshape(len(held), d) for k in ("low", "high")}
                need = zone["block"][_meets(row, d, zone, search)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(need), row["chunk"]), pa.int64()), pa.array(need)], names=["chunk", "block"])

    return with_package(asked.join(zones, "page")).mapInArrow(run, "chunk long, block long")


class Best:
    """The best rows of every window of a chunk, as sparse (window, score, id)."""

    def __init__(self, floor: np.ndarray, keep: int):
        self.floor, self.keep = floor.copy(), keep  # floor: a score that a row must reach, by window
        self.parts: list[np.ndarray] = []
        self.count = 0

    def add(self, window: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        self.parts.append(np.stack([window, score, ids]))
        self.count += len(window)
        if self.count > BUFFERED:
            self.prune()

    def prune(self) -> np.ndarray:
        m = np.concatenate(self.parts, 1) if self.parts else np.empty((3, 0), np.int64)
        m = m[:, np.lexsort((m[2], -m[1], m[0]))]
        first = np.flatnonzero(np.concatenate([[True], m[0, 1:] != m[0, :-1]])) if m.shape[1] else np.empty(0, np.int64)
        rank = np.arange(m.shape[1]) - np.repeat(first, np.diff(np.append(first, m.shape[1])))
        m, rank = m[:, rank < self.keep], rank[rank < self.keep]
        full = rank == self.keep - 1
        self.floor[m[0, full]] = np.maximum(self.floor[m[0, full]], m[1, full])
        self.parts, self.count = [m], m.shape[1]
        return m


def search(chunks: DataFrame, chosen: DataFrame, blocks: DataFrame, pages: int, keep: int, windows=None) -> DataFrame:
    """(chunk, slot, anchor_id, place, score, vec_id, rank): the best ``keep`` rows of every
    anchor (slot of its chunk), by window where there are any (place: the
    positive's), from the chosen blocks. One group (chunk, page) gives its own
    best; the best of all groups follow from a window with a group limit."""
    positives = windows[0] if windows else 1
    page = F.pmod(F.xxhash64("block"), F.lit(pages)).alias("page")
    pairs = chosen.select("chunk", page, "block")
    extra = ["found"] if windows else []
    none = [F.lit(None).cast(chunks.schema[c].dataType).alias(c) for c in ("seeds", *extra)]
    reads = pairs.join(blocks, "block").select("chunk", "page", F.lit(1).alias("part"), "dims", "ids", "labels", "q", *none)
    heads = pairs.select("chunk", "page").distinct().join(chunks, "chunk").select(
        "chunk", "page", F.lit(0).alias("part"), "dims", "ids", "labels", "q", "seeds", *extra)
    # part 0 (the chunk) comes before its blocks
    stream = heads.unionByName(reads).repartition("chunk", "page").sortWithinPartitions("chunk", "page", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = chunk = None

        def kept():
            m = best.prune()
            slot, place = m[0] // positives, m[0] % positives + 1
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(slot), chunk), pa.int64()), pa.array(slot, pa.int32()), pa.array(a_ids[slot, 0]),
                 pa.array(place, pa.int32()), pa.array(m[1]), pa.array(m[2])],
                names=["chunk", "slot", "anchor_id", "place", "score", "vec_id"])

        for batch in batches:
            for i in range(len(batch)):
                r = batch.slice(i, 1).to_pylist()[0]
                d, ids, labels = r["dims"], _values(r["ids"]), _values(r["labels"])
                q = _matrix(r["q"], d) if d else np.empty((len(ids), 0), "<i4")
                if r["part"] == 0:
                    if best is not None:
                        yield kept()
                    chunk, a, a_ids, a_labels = r["chunk"], q, ids[:, None], labels[:, None]
                    if windows:
                        least, most = _windows(r, len(ids), *windows)
                    best = Best(least.ravel() if windows else _values(r["seeds"]), keep)
                    continue
                s = scores(a, q)
                if not windows:
                    at, of = np.nonzero((a_labels == labels) & (a_ids != ids) & (s >= best.floor[:, None]))
                    best.add(at, s[at, of], ids[of])
                    continue
                other = a_labels != labels
                for k in range(positives):
                    floor = best.floor[k::positives][:, None]
                    at, of = np.nonzero(other & (s >= floor) & (s <= most[:, k, None]))
                    best.add(at * positives + k, s[at, of], ids[of])
                best.prune()
        if best is not None:
            yield kept()

    found = with_package(stream).mapInArrow(run, "chunk long, slot int, anchor_id long, place int, score long, vec_id long")
    first = Window.partitionBy("chunk", "slot", "place").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= keep)


def mine(vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         block_rows: int = BLOCK_ROWS, chunk_anchors: int = CHUNK_ANCHORS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score): for each row that ``anchor`` (a condition on the vectors'
    columns) names and each of its best rows of its label, the best rows of
    other labels whose score is ``low`` to ``high`` per cent of the positive's."""
    rows = written(prepare(vectors, anchor), "vectors")
    blocks = written(cut_blocks(ordered(rows, spread(rows)), block_rows), "vector-blocks")
    chunks = written(cut_chunks(blocks, positives, chunk_anchors), "anchor-chunks")
    n = blocks.count()
    zone_pages, block_pages = -(-n // PAGE_ZONES) or 1, -(-n // PAGE_BLOCKS) or 1
    chosen = choose(chunks, blocks, zone_pages)
    best = written(search(chunks, chosen, blocks, block_pages, positives).select(
        "chunk", "slot", F.col("rank").alias("place"), "score", F.col("vec_id").alias("positive_id")), "positives")
    found = best.groupBy("chunk").agg(F.collect_list(F.struct("slot", "place", "score")).alias("found"))
    opened = written(chunks.drop("seeds").join(found, "chunk").withColumn("seeds", F.lit(None).cast("binary")), "windows")
    span = (positives, low, high)
    chosen = choose(opened, blocks, zone_pages, span)
    kept = search(opened, chosen, blocks, block_pages, negatives, span)
    return kept.withColumnsRenamed({"score": "negative_score", "vec_id": "negative_id"}).join(
        best.withColumnRenamed("score", "positive_score"), ["chunk", "slot", "place"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
