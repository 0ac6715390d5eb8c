"""Operator 4: context-triggered piecewise hashes.

A rolling hash over the last 7 bytes ends a chunk wherever its lowest k bits
are all ones (block size 2^k); k is the smallest at which a text has at most
``CHUNKS`` such places (one less for a text that would be left with few). A chunk gives one 12-bit symbol (of its bytes and the
window at its end), a signature is the symbols in order, and a fingerprint
holds the signatures at k, k+1 and k+2:

    k:signature:signature:signature       (two base64 characters a symbol)

Two fingerprints are compared at every block size that both hold, by edit
distance over the symbols; their likeness is the best 1 - distance / length.
Without a common block size it is 0.

* empty and null texts: no symbols; two empty texts are alike (1), an empty
  and another one are not (0).
* rows with one doc_id are neighbours in text order; a null doc_id comes after
  all others; repeated rows give one result row each; a single row is its own
  neighbour. Extra columns are not carried; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlens.llm.common import slots, with_package
from depotlens.llm.tokens import slices

WINDOW = 7
CHUNKS = 64
FEW, MANY = 12, 512  # below so few symbols, the finer block size is taken if it gives at most so many
LEVELS = 3
_STEP = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse
_UNSTEP = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_LETTERS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
SLICE_BYTES = 2 << 20


@lru_cache(maxsize=2)
def _powers_to(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base), np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return _powers_to(int(base), 1 << max(16, n.bit_length()))[:n]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _MIX
    return x ^ (x >> np.uint64(29))


def fingerprints(texts: list[bytes]) -> list[str]:
    """The fingerprint of every text."""
    n = len(texts)
    sizes = np.fromiter(map(len, texts), np.int64, n)
    total = int(sizes.sum())
    if not total:
        return ["0" + ":" * LEVELS] * n
    data = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    # sums of byte * step^place, from which the hash of any run of bytes is cut out
    sums = np.empty(total + 1, np.uint64)
    sums[0] = 0
    np.cumsum((data + np.uint64(1)) * _powers(_STEP, total), out=sums[1:])
    unstep = _powers(_UNSTEP, total)
    window = np.maximum(np.arange(total) - (WINDOW - 1), np.repeat(starts, sizes))  # within its own text
    rolling = _mixed((sums[1:] - sums[window]) * unstep)
    # number of lowest ones of the rolling hash
    ones = np.bitwise_count((rolling ^ (rolling + np.uint64(1))) >> np.uint64(1))
    places, counts = [np.arange(total)], [sizes]
    while (counts[-1] > 0).any():
        k = len(places)
        places.append(places[-1][ones[places[-1]] >= k])
        counts.append(np.diff(np.searchsorted(places[-1], np.concatenate([starts, ends[-1:]]))))
    places += [places[-1]] * LEVELS
    counts = np.array(counts)
    level = (counts <= CHUNKS).argmax(axis=0)
    # texts that repeat themselves may have many places at one size and few at the next
    finer = np.maximum(level - 1, 0)
    level = np.where((counts[level, np.arange(n)] < FEW) & (counts[finer, np.arange(n)] <= MANY), finer, level)
    parts: list[list[str]] = [[] for _ in range(n)]
    last = ends - 1
    for k in range(int(level.max()) + LEVELS):
        wanted = (level <= k) & (level > k - LEVELS) & (sizes > 0)
        if not wanted.any():
            continue
        text = np.searchsorted(ends, places[k], side="right")
        cut = np.unique(np.concatenate([places[k][wanted[text]], last[wanted]]))  # the rest of a text is its last chunk
        text = np.searchsorted(ends, cut, side="right")
        begin = np.concatenate([[0], cut[:-1] + 1])
        first = np.concatenate([[True], text[1:] != text[:-1]])
        begin[first] = starts[text[first]]
        symbol = _mixed((sums[cut + 1] - sums[begin]) * unstep[begin] + rolling[cut]) >> np.uint64(52)
        symbol = symbol.astype(np.int64)
        letters = np.stack([_LETTERS[symbol >> 6], _LETTERS[symbol & 63]], axis=1).tobytes().decode()
        border = np.flatnonzero(first)
        for t, i, j in zip(text[border].tolist(), border.tolist(), [*border[1:].tolist(), len(cut)]):
            parts[t].append(letters[2 * i:2 * j])
    return [f"{k}:" + ":".join(p or [""] * LEVELS) for k, p in zip(level.tolist(), parts)]


def _distances(one: list[np.ndarray], two: list[np.ndarray]) -> np.ndarray:
    """Edit distances of pairs of symbol arrays."""
    n = len(one)
    size1, size2 = (np.fromiter(map(len, x), np.int64, n) for x in (one, two))
    wide = int(size2.max(initial=0))
    pad1 = np.zeros((n, int(size1.max(initial=0))), np.uint16)
    pad2 = np.ones((n, wide), np.uint16)  # neither 0 nor 1 is a symbol
    for i, (a, b) in enumerate(zip(one, two)):
        pad1[i, :len(a)], pad2[i, :len(b)] = a, b
    column = np.arange(wide + 1, dtype=np.int16)
    row = np.tile(column, (n, 1))
    out = np.where(size1 == 0, size2, 0)
    for i in range(pad1.shape[1]):
        best = np.empty_like(row)
        best[:, 0] = i + 1
        np.minimum(row[:, 1:] + 1, row[:, :-1] + (pad2 != pad1[:, i:i + 1]), out=best[:, 1:])
        row = np.minimum.accumulate(best - column, axis=1) + column
        done = np.flatnonzero(size1 == i + 1)
        out[done] = row[done, size2[done]]
    return out


def likeness(one: list[str], two: list[str]) -> np.ndarray:
    """Likeness of fingerprint pairs, 0 to 1."""
    score = np.zeros(len(one))
    pairs: list[tuple[int, np.ndarray, np.ndarray]] = []
    for i, (a, b) in enumerate(zip(one, two)):
        if a == b:
            score[i] = 1
            continue
        ka, *pa_ = a.split(":")
        kb, *pb = b.split(":")
        for la in range(LEVELS):
            lb = int(ka) + la - int(kb)
            if 0 <= lb < LEVELS and pa_[la] and pb[lb]:
                pairs.append((i, np.frombuffer(pa_[la].encode(), np.uint16), np.frombuffer(pb[lb].encode(), np.uint16)))
    pairs.sort(key=lambda p: (max(len(p[1]), len(p[2])) // 32, len(p[1])))  # pairs of a size together
    for at in range(0, len(pairs), 2000):
        some = pairs[at:at + 2000]
        far = _distances([p[1] for p in some], [p[2] for p in some])
        size = np.array([max(len(p[1]), len(p[2])) for p in some])
        np.maximum.at(score, [p[0] for p in some], 1 - far / size)
    return score


def fingerprint_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("fingerprint", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, size=SLICE_BYTES):
                texts = [(t or "").encode() for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fingerprints(texts))], schema=schema)

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return with_package(rows).mapInArrow(run, "doc_id long, fingerprint string")


def _longs(values: list) -> Column:
    """An array as one literal, whatever its length (nulls stay null)."""
    return F.split(F.lit(",".join("" if v is None else str(v) for v in values)), ",", -1).try_cast("array<bigint>")


def _place(key: Column, cuts: list[int]) -> Column:
    """How many of the ascending cuts lie above the key, in two short steps:
    which run of cuts, and where in it."""
    width = math.isqrt(max(1, len(cuts) - 1)) + 1
    tops = _longs([cuts[min(i + width, len(cuts)) - 1] for i in range(0, len(cuts), width)])
    run = F.least(F.size(F.filter(tops, lambda c: c <= key)) * width, F.lit(len(cuts)))  # the last run may be shorter
    inside = F.filter(F.slice(_longs(cuts), run + 1, F.lit(width)), lambda c: c <= key)
    return F.lit(len(cuts)) - run - F.size(inside) if cuts else F.lit(0)


def _followed(df: DataFrame) -> DataFrame:
    """Rows dealt out by descending doc_id (bucket), with the first rows of the
    next bucket once more at the end of each (look)."""
    least = F.lit(-(1 << 63)).cast("long")
    rows = df.select("doc_id", "text", F.coalesce(F.col("doc_id"), least).alias("_key"))
    count = slots(df.sparkSession)
    keys = df.select(F.coalesce(F.col("doc_id"), least).alias("_key"))
    cuts = keys.agg(F.percentile_approx("_key", [i / count for i in range(1, count)] or [0.5], 10000)).first()[0] or []
    bucket = _place(F.col("_key"), sorted(set(cuts)))
    # one row per bucket; the first row of each is looked at by the bucket before (of the first bucket: the last one)
    firsts = keys.select("_key", bucket.alias("b")).groupBy("b").agg(F.max("_key")).orderBy("b").collect()
    first, before = {}, {}
    for i, (b, key) in enumerate(firsts):
        first[b], before[b] = key, firsts[i - 1][0]
    every = range(max(first, default=-1) + 1)
    looked = F.when(F.get(_longs([first.get(b) for b in every]), bucket) == F.col("_key"),
                    F.get(_longs([before.get(b) for b in every]), bucket).cast("int"))
    places = F.array_compact(F.array(
        F.struct(bucket.alias("bucket"), F.lit(False).alias("look")),
        F.when(looked.isNotNull(), F.struct(looked.alias("bucket"), F.lit(True).alias("look")))))
    dealt = rows.select("doc_id", "text", "_key", F.explode(places).alias("p")).select("doc_id", "text", "_key", "p.*")
    return (dealt.repartitionById(max(1, count), F.col("bucket")).sortWithinPartitions("bucket", "look", F.desc("_key"), "text")
            .select("doc_id", "text", "bucket", "look"))


NEIGHBOURS = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")


def compare_neighbours(df: DataFrame) -> DataFrame:
    """Fingerprints of every text and of the text whose second half the next
    document (descending doc_id; after the last the first) has replaced."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # the last row, which waits for its next
        for batch in batches:
            for part in slices(batch, size=SLICE_BYTES):
                ids, texts, buckets, looks = (c.to_pylist() for c in part.columns)
                texts = [t or "" for t in texts]
                prints = fingerprints([t.encode() for t in texts])
                rows = held + list(zip(ids, texts, buckets, looks, prints))
                held = rows[-1:]
                pairs = [(a, b) for a, b in zip(rows, rows[1:]) if not a[3] and a[2] == b[2]]
                edited = [a[1][:len(a[1]) - len(a[1]) // 2] + b[1][:len(a[1]) // 2] for a, b in pairs]
                raw = [e.encode() for e in edited]
                own, new = [a[4] for a, _ in pairs], fingerprints(raw)
                yield pa.RecordBatch.from_arrays([
                    pa.array([a[0] for a, _ in pairs], pa.int64()), pa.array([len(a[1]) for a, _ in pairs], pa.int64()),
                    pa.array([hashlib.sha256(r).hexdigest() for r in raw], pa.string()), pa.array(own, pa.string()),
                    pa.array(new, pa.string()), pa.array(likeness(own, new)),
                    pa.array(likeness(own, [b[4] for _, b in pairs]))], schema=schema)

    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return with_package(_followed(rows)).mapInArrow(run, NEIGHBOURS)
