"""Operator 3: byte-level BPE encoding and decoding by merge replay.

The distinct words of a block of the corpus are held as one array of tokens.
An inverted index maps each merge (by the rank of the token it makes) to the
word positions where it applies; merges are applied in rank order to all their
positions at once, and only the touched neighbours enter the index again. A
merge that may open one of a lower rank is applied to one position per word at
a time, so every word sees the order of a word-by-word encoder.

The vocabulary is a rank file (one token in base64 and its rank per line) at a
path that every executor can read. Ids travel as binary, little-endian
unsigned 32-bit integers.

* null and empty texts: no ids, decoded to no bytes. A null id stays null.
* repeated rows: one result row each. Extra columns are not carried.
* an empty table gives no rows. A text is never cut; memory follows the
  longest text and a slice of some MB.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotlens.llm.common import with_package, worker_state
from depotlens.llm.tokens import Encoded, PieceEncoder, binary_ids, slices

NONE = np.int32(2**31 - 1)
CACHED_PIECES = 200_000
SLICE_BYTES = 4 << 20


class MergeReplay:
    def __init__(self, path: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.ranks, self.tokens = ranks, {r: t for t, r in ranks.items()}
        self.bytes_rank = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        keys, made, unsafe = [], [], set()
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    made.append(rank)
                    unsafe.update(x for x, part in ((left, token[:i]), (right, token[i:])) if x > rank and len(part) > 1)
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        self.pairs, self.made = np.array(keys, np.int64)[order], np.array(made, np.int32)[order]
        self.unsafe = unsafe

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.made[at], NONE)

    def encode(self, words: list[bytes]) -> Encoded:
        """Ids of all words and the number per word."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        n = int(sizes.sum())
        if not n:
            return np.empty(0, np.uint32), sizes
        token = self.bytes_rank[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), sizes)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        last = np.cumsum(sizes)[sizes > 0] - 1
        after[last] = -1
        before[np.concatenate([[0], last[:-1] + 1])] = -1
        alive = np.ones(n, bool)
        rank_at = np.full(n, NONE, np.int32)  # of the pair that starts there
        inner = np.flatnonzero(after >= 0)
        rank_at[inner] = self.pair_ranks(token[inner], token[inner + 1])
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def post(places: np.ndarray) -> None:
            ranks = rank_at[places]
            places, ranks = places[ranks != NONE], ranks[ranks != NONE]
            if not len(places):
                return
            order = np.argsort(ranks, kind="stable")
            places, ranks = places[order], ranks[order]
            cuts = np.flatnonzero(np.diff(ranks)) + 1
            for r, a, b in zip(ranks[np.concatenate([[0], cuts])].tolist(), [0, *cuts.tolist()], [*cuts.tolist(), len(places)]):
                if r in index:
                    index[r].append(places[a:b])
                else:
                    index[r] = [places[a:b]]
                    heapq.heappush(heap, r)

        post(inner)
        while heap:
            rank = heapq.heappop(heap)
            lists = index.pop(rank)
            at = lists[0] if len(lists) == 1 else np.concatenate(lists)
            at = np.unique(at[rank_at[at] == rank])
            if not len(at):
                continue
            if rank in self.unsafe:
                leftmost = np.concatenate([[True], word[at[1:]] != word[at[:-1]]])
                if not leftmost.all():
                    index[rank] = [at[~leftmost]]
                    heapq.heappush(heap, rank)
                    at = at[leftmost]
            elif len(at) > 1:
                touching = after[at[:-1]] == at[1:]
                if touching.any():  # of a run of overlapping pairs, every second one
                    run = np.concatenate([[0], np.where(touching, 0, np.arange(1, len(at)))])
                    at = at[(np.arange(len(at)) - np.maximum.accumulate(run)) % 2 == 0]
            right = after[at]
            beyond = after[right]
            token[at] = rank
            alive[right] = False
            rank_at[right] = NONE
            after[at] = beyond
            held = beyond >= 0
            before[beyond[held]] = at[held]
            rank_at[at] = NONE
            rank_at[at[held]] = self.pair_ranks(token[at[held]], token[beyond[held]])
            ahead = before[at]
            ahead, mine = ahead[ahead >= 0], at[ahead >= 0]
            rank_at[ahead] = self.pair_ranks(token[ahead], token[mine])
            post(np.concatenate([at, ahead]))
        return token[alive].astype(np.uint32), np.bincount(word[alive], minlength=len(words))

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


@worker_state("bpe", 2)
def replay(path: str) -> MergeReplay:
    return MergeReplay(path)


@worker_state("bpe", 2)
def encoder(path: str, pattern: str) -> PieceEncoder:
    import regex

    split = regex.compile(pattern).findall
    merges = replay(path)

    def encode(pieces: list[str]) -> Encoded:
        lists = [split(p) for p in pieces]
        distinct = {w: i for i, w in enumerate(dict.fromkeys(w for x in lists for w in x))}
        ids, sizes = merges.encode([w.encode() for w in distinct])
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        row = np.fromiter((distinct[w] for x in lists for w in x), np.int64, int(counts.sum()))
        size = sizes[row]
        ends = np.cumsum(size)
        begin = (np.cumsum(sizes) - sizes)[row]
        at = np.repeat(begin - (ends - size), size) + np.arange(int(size.sum()))
        owner = np.repeat(np.arange(len(lists)), counts)
        return ids[at], np.bincount(owner, weights=size, minlength=len(lists)).astype(np.int64)

    return PieceEncoder(encode, cached=CACHED_PIECES)


def encode_documents(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) with ids as little-endian unsigned 32-bit integers."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = encoder(path, pattern)
        for batch in batches:
            for part in slices(batch, size=SLICE_BYTES):
                yield pa.RecordBatch.from_arrays([part.column(0), binary_ids(*pieces.texts(part.column(1)))], schema=schema)

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return with_package(rows).mapInArrow(run, "doc_id long, ids binary")


def decode_ids(df: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, decoded): the bytes of the ids."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = replay(path)
        for batch in batches:
            for part in slices(batch, "ids", SLICE_BYTES):
                texts = [merges.decode(np.frombuffer(b.as_py(), "<u4")) for b in part.column(1)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary())], schema=schema)

    return with_package(df).select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, decoded binary")
