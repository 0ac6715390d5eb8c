"""Operator 11: fill-in-the-middle by memoised content-defined chunks.

A text's units are runs of A-Z and a-z and single other code points. A rolling
hash over the last ``WINDOW`` bytes cuts the texts into chunks, so a passage
that many texts share gives the same chunks wherever it stands. A cache maps a
chunk's content (not only its hash) to its boundary summary: units, code
points, and whether it begins and ends within a run of letters. Only chunks
that the cache lacks are counted. A text's number of units is the sum over its
chunks, less one where a run crosses a border; running sums give the chunk of
each cut, and only that chunk is searched for it. The cache is bounded and only
saves time.

The cuts and the form follow from the sha256 of ``seed`` and the document's
id. ``restore`` rebuilds the text from the output and the form alone.

* null and empty text: n = 0, form plain, the output is empty.
* null doc_id: hashed as ``1:`` with nothing behind it; it stays null.
* texts of any length are taken whole; a chunk holds ``MOST`` bytes at most.
* repeated rows give equal rows. Extra columns are not carried, whatever their
  names. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotlens.llm.common import with_package
from depotlens.llm.tokens import slices

# fixed values: the marks of the three parts
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
FORM_RATE, SPM_RATE, SEED = 90, 20, 1

WINDOW = 16
MASK = 0xFF  # a cut after one byte in 256 on average
MOST = 4096
CACHED_BYTES = 32 << 20
SLICE_BYTES = 4 << 20


def _letters(b: np.ndarray) -> np.ndarray:
    low = b | 0x20
    return (low >= 97) & (low <= 122)


def cut_points(b: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Ends of the chunks of texts that lie behind one another in the bytes
    ``b``; every text's end is one. A chunk never ends inside a code point."""
    h = (b.astype(np.uint32) + np.uint32(1)) * np.uint32(0x9E3779B1)
    h ^= h >> np.uint32(15)
    factor, width = np.uint32(0x85EBCA6B), 1
    while width < WINDOW:  # windows of twice the width from two of half
        wider = h.copy()
        wider[width:] += h[:-width] * factor
        h, factor, width = wider, np.uint32(int(factor) ** 2 & 0xFFFFFFFF), 2 * width
    begins = np.ones(len(b) + 1, bool)  # a code point (or a text's end) begins here
    begins[:-1] = (b & 0xC0) != 0x80
    cut = np.flatnonzero(((h >> np.uint32(11)) & np.uint32(MASK)) == 0) + 1
    cuts = np.union1d(cut[begins[cut]], ends[ends > 0])
    starts = np.concatenate([[0], cuts[:-1]])
    wide = np.flatnonzero(cuts - starts > MOST)
    if len(wide):
        more = [np.arange(starts[i] + MOST, cuts[i], MOST) for i in wide]
        more = np.concatenate(more)
        for _ in range(3):  # back to the code point's first byte
            more = more - ~begins[more]
        cuts = np.union1d(cuts, more)
    return cuts


class ChunkCache:
    """Content of a chunk to (units, code points, begins and ends with a letter)."""

    def __init__(self, most: int = CACHED_BYTES):
        self.most, self.held, self.rows, self.hits = most, 0, {}, 0

    def summaries(self, b: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        data, starts = b.tobytes(), np.concatenate([[0], cuts[:-1]])
        chunks = [data[i:j] for i, j in zip(starts.tolist(), cuts.tolist())]
        known = list(map(self.rows.get, chunks))
        missing = dict.fromkeys(c for c, k in zip(chunks, known) if k is None)
        self.hits += len(chunks) - len(missing)
        if missing:
            fresh = dict(zip(missing, self.count(list(missing))))
            known = [k or fresh[c] for c, k in zip(chunks, known)]
            if self.held > self.most:
                self.rows, self.held = {}, 0
            self.rows.update(fresh)
            self.held += sum(map(len, fresh))
        return np.array(known, np.int64).reshape(-1, 4)

    @staticmethod
    def count(chunks: list[bytes]) -> list[tuple[int, int, int, int]]:
        b = np.frombuffer(b"".join(chunks), np.uint8)
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        first = np.cumsum(sizes) - sizes
        letter = _letters(b)
        point = (b & 0xC0) != 0x80
        units = unit_starts(b, first)
        per = (np.add.reduceat(x.astype(np.int64), first) for x in (units, point))
        return list(zip(*(x.tolist() for x in (*per, letter[first].astype(int), letter[first + sizes - 1].astype(int)))))


def unit_starts(b: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Whether a unit starts at each byte; runs end before each of ``first``."""
    letter = _letters(b)
    inside = np.zeros(len(b), bool)
    inside[1:] = letter[:-1] & letter[1:]
    inside[first] = False
    return ((b & 0xC0) != 0x80) & ~inside


def choices(doc_id: int | None, n: int, seed: int = SEED) -> tuple[int, int, int, int]:
    """(first cut, second cut, h3 % 100, h4 % 100) of a document of n units."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    h = [int.from_bytes(digest[4 * k:4 * k + 4], "big") for k in range(4)]
    one, two = h[0] % (n + 1), h[1] % (n + 1)
    return min(one, two), max(one, two), h[2] % 100, h[3] % 100


def arrange(prefix: str, middle: str, suffix: str, form: str) -> str:
    if form == "psm":
        return PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle
    return SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle


def restore(output: str, form: str) -> str:
    """The text, from the output and its form (a marked text holds no mark of its own)."""
    if form == "plain":
        return output
    one, two = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    a, rest = output[len(one):].split(two, 1)
    b, middle = rest.split(MIDDLE, 1)
    return a + middle + b if form == "psm" else b + middle + a


def transform_texts(ids: list, texts: list[bytes], cache: ChunkCache, rate: int = FORM_RATE, spm: int = SPM_RATE,
                    seed: int = SEED) -> Iterator[tuple]:
    """(n, form, prefix_chars, middle_chars, output) of every text."""
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
    b = np.frombuffer(b"".join(texts), np.uint8)
    cuts = cut_points(b, ends) if len(b) else np.empty(0, np.int64)
    starts = np.concatenate([[0], cuts[:-1]]) if len(cuts) else cuts
    said = cache.summaries(b, cuts) if len(cuts) else np.empty((0, 4), np.int64)
    last = np.searchsorted(cuts, ends, "right")  # chunks before the end of each text
    joined = np.zeros(len(cuts), np.int64)
    joined[1:] = said[1:, 2] & said[:-1, 3]
    heads = np.concatenate([[0], last[:-1]]) if len(last) else last
    joined[heads[heads < last]] = 0
    units = np.concatenate([[0], np.cumsum(said[:, 0] - joined)])
    points = np.concatenate([[0], np.cumsum(said[:, 1])])

    def place(i: int, at: int) -> tuple[int, int]:
        """(byte, code points before it) where unit ``at`` of text i starts."""
        goal = units[heads[i]] + at
        if goal == units[last[i]]:
            return int(ends[i]), int(points[last[i]] - points[heads[i]])
        k = int(np.searchsorted(units, goal, "right")) - 1
        inside = b[starts[k]:cuts[k]]
        where = np.flatnonzero(unit_starts(inside, np.zeros(1, np.int64)))[goal - units[k] + joined[k]]
        before = np.count_nonzero((inside[:where] & 0xC0) != 0x80)
        return int(starts[k] + where), int(points[k] - points[heads[i]] + before)

    for i, (doc_id, text) in enumerate(zip(ids, texts)):
        n = int(units[last[i]] - units[heads[i]])
        one, two, h3, h4 = choices(doc_id, n, seed)
        if not text or h3 >= rate or any(m.encode() in text for m in (PREFIX, SUFFIX, MIDDLE)):
            yield n, "plain", None, None, text.decode()
            continue
        (x, chars), (y, more) = place(i, one), place(i, two)
        base = int(ends[i]) - len(text)
        x, y = x - base, y - base
        form = "spm" if h4 < spm else "psm"
        yield n, form, chars, more - chars, arrange(text[:x].decode(), text[x:y].decode(), text[y:].decode(), form)


def transform(docs: DataFrame, rate: int = FORM_RATE, spm: int = SPM_RATE, seed: int = SEED) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output, restored) of every document."""
    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string, restored string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = ChunkCache()
        for batch in batches:
            for part in slices(batch, size=SLICE_BYTES):
                ids = part.column(0).to_pylist()
                texts = part.column(1).cast(pa.binary()).to_pylist()
                rows = list(transform_texts(ids, texts, cache, rate, spm, seed))
                columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate(
                    (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()))]
                back = pa.array([restore(r[4], r[1]) for r in rows], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), *columns, back], names=[
                    "doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return with_package(rows).mapInArrow(run, schema)
