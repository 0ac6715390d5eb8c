"""Operator 10: best-fit packing by a grouping genetic algorithm on islands.

Every text is encoded, gets its end id and is cut only where it is longer
than a sequence. Full pieces are sequences of their own. All other pieces are
dealt to islands (hash of the piece, so many that an island stays small); each
island evolves its own population of packings of its pieces:

* an individual is a set of bins (sequences); fewer bins are better, then the
  larger mean of the squared fills (room gathers in few bins, which the next
  islands can use);
* crossover injects well-filled bins of one parent whole into the other,
  drops the bins that share a piece with them, and best-fits the displaced
  pieces, some of them by exchange for smaller ones of a bin;
* mutation dissolves the emptiest bins and some others and best-fits their
  pieces.

Then elites migrate, as rows through a shuffle: of an island's best packing,
one in ``MIGRANTS`` of the bins filled to ``ELITE`` and all bins below it go
on whole (all their pieces to one island, dealt by the hash of the bin); the
other elite bins are final. The bins that arrive are individuals of the new
island's population, once with all of them and once with the elite ones kept
and the rest best-fitted, so that crossover injects them into packings of
pieces from other islands. Rounds end with one island, or when a round makes
less than half of the pieces final. No task holds more than an island's pieces.

* null and empty texts: the end id only. Repeated rows are pieces of their
  own; ties in the fit are broken by the order of the bins.
* a null doc_id stays null. Extra columns are not carried; an empty table
  gives no rows.
"""

from __future__ import annotations

import bisect
import random
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotlens.llm.common import with_package, written
from depotlens.llm.tokens import library_encoder, slices, with_end

CAPACITY = 4096
ISLAND_PIECES = 3000
MOST_LEVELS = 12
ELITE = 0.995
MIGRANTS = 16
POPULATION = 4
GENERATIONS = 4
#: bins of more pieces take none in exchange (best fit fills them well anyway)
EXCHANGE_WIDTH = 8

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(df: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every text's pieces."""
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = library_encoder(tokenizer)
        for batch in batches:
            for part in slices(batch):
                ids, sizes = with_end(*pieces.texts(part.column(1)), end_id)
                view = memoryview(ids.astype("<u4")).cast("B")
                counts = -(-sizes // capacity)
                row = np.repeat(np.arange(len(sizes)), counts)
                number = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
                start = number * capacity
                length = np.minimum(capacity, sizes[row] - start)
                at = (np.cumsum(sizes) - sizes)[row] + start
                sums = [zlib.crc32(view[4 * a:4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist())]
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(row)), pa.array(number.astype(np.int32)), pa.array(start), pa.array(length),
                    pa.array(sums, pa.int64())], schema=schema)

    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return with_package(rows).mapInArrow(run, PIECES)


class _Bins:
    """Bins with free room, for best fit: sorted by (room, number)."""

    def __init__(self, bins: list[list[int]], lengths: list[int], capacity: int):
        self.bins, self.lengths = bins, lengths
        self.rooms = sorted((capacity - sum(lengths[p] for p in b), i) for i, b in enumerate(bins))
        self.capacity = capacity

    def fit(self, pieces: list[int]) -> None:
        """Each piece, longest first, into the fullest bin that holds it."""
        for p in sorted(pieces, key=lambda x: (-self.lengths[x], x)):
            n = self.lengths[p]
            k = bisect.bisect_left(self.rooms, (n, -1))
            if k == len(self.rooms):
                self.bins.append([p])
                bisect.insort(self.rooms, (self.capacity - n, len(self.bins) - 1))
            else:
                room, i = self.rooms.pop(k)
                self.bins[i].append(p)
                if room > n:
                    bisect.insort(self.rooms, (room - n, i))


def _fill(bins: list[list[int]], lengths: list[int]) -> list[int]:
    return [sum(lengths[p] for p in b) for b in bins]


def _fitness(bins: list[list[int]], lengths: list[int], capacity: int) -> float:
    return sum((f / capacity) ** 2 for f in _fill(bins, lengths)) / max(1, len(bins))


def _exchange(bins: list[list[int]], loose: list[int], lengths: list[int], capacity: int) -> list[int]:
    """Puts loose pieces into bins in place of one or two smaller ones where the
    bin gets fuller by it; gives the pieces that are loose then."""
    loose = sorted(loose, key=lambda p: -lengths[p])
    for b in bins:
        room = capacity - sum(lengths[p] for p in b)
        if not room or not loose or len(b) > EXCHANGE_WIDTH:
            continue
        sizes = [-lengths[p] for p in loose]
        best = (0, None, None)
        for k, p in enumerate(b):
            for out in [(p,)] + [(p, q) for q in b[k + 1:]]:
                space = room + sum(lengths[x] for x in out)
                at = bisect.bisect_left(sizes, -space)  # the longest loose piece that fits there
                if at < len(loose) and room - (space - lengths[loose[at]]) > best[0]:
                    best = (room - (space - lengths[loose[at]]), out, at)
        if best[1]:
            b[:] = [p for p in b if p not in best[1]] + [loose.pop(best[2])]
            loose = sorted(loose + list(best[1]), key=lambda p: -lengths[p])
    return loose


def evolve(lengths: list[int], capacity: int = CAPACITY, seed: int = 0, population: int = POPULATION,
           generations: int = GENERATIONS, arrived: list[list[int]] = ()) -> list[list[int]]:
    """The best packing that the island finds: bins of piece numbers.
    arrived: bins (of all pieces) that came from other islands."""
    chance = random.Random(seed)

    def packed(bins: list[list[int]], loose: list[int]) -> list[list[int]]:
        held = _Bins([list(b) for b in bins], lengths, capacity)
        held.fit(loose)
        return held.bins

    everything = range(len(lengths))

    def completed(bins: list[list[int]]) -> list[list[int]]:
        inside = {p for b in bins for p in b}
        bins = [list(b) for b in bins]
        return packed(bins, _exchange(bins, [p for p in everything if p not in inside], lengths, capacity))

    total = -(-sum(lengths) // capacity)
    most = sum(lengths) - (total - 1) * capacity  # left for the last bin when all others are full
    perfect = (-total, (total - 1 + (most / capacity) ** 2) / max(1, total))
    pool = [packed([], list(everything))]  # best fit of the pieces, longest first
    if arrived:
        pool.append([list(b) for b in arrived])
        pool.append(completed([b for b, f in zip(arrived, _fill(arrived, lengths)) if f >= ELITE * capacity]))
    while len(pool) < population:  # and, for variety, some pieces placed before the others
        early = chance.sample(everything, len(lengths) // 5)
        rest = set(everything).difference(early)
        pool.append(packed(packed([], early), sorted(rest)))
    rank = lambda bins: (-len(bins), _fitness(bins, lengths, capacity))
    pool = sorted(((rank(b), b) for b in pool), key=lambda r: r[0], reverse=True)
    for _ in range(generations):
        if pool[0][0] >= perfect:  # every bin but one is full: nothing can be better
            break
        for _ in range(population // 2):
            one, two = (b for _, b in chance.sample(pool, 2))
            fills = _fill(one, lengths)
            best = sorted(range(len(one)), key=lambda i: -fills[i])[:max(1, len(one) // 2)]
            given = [one[i] for i in chance.sample(best, max(1, 2 * len(best) // 3))]
            inside = {p for b in given for p in b}
            child = given + [b for b in two if inside.isdisjoint(b)]
            fills = _fill(child, lengths)
            order = sorted(range(len(child)), key=lambda i: fills[i])
            gone = set(order[:max(1, len(child) // 20)]).union(chance.sample(order, len(child) // 20))
            child = completed([b for i, b in enumerate(child) if i not in gone])
            pool.append((rank(child), child))
        # equal ranks once: copies of one packing would crowd out the others
        pool = sorted({r: (r, b) for r, b in pool}.values(), key=lambda r: r[0], reverse=True)[:population]
        if len(pool) < 2:
            pool.append((pool[0][0], packed([], chance.sample(everything, len(lengths)))))
    return pool[0][1]


def _island(capacity: int, last: bool):
    """One island's work: its pieces with bin number, offset and whether the bin is final."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_key", ignore_index=True)
        lengths = pdf["length"].tolist()
        arrived = {}
        for p, b in enumerate(pdf["bin"].tolist()):
            arrived.setdefault(b, []).append(p)
        arrived = list(arrived.values())
        bins = evolve(lengths, capacity, seed=int(pdf["island"].iat[0]), arrived=arrived if len(arrived) < len(pdf) else ())
        number, offset, final = [0] * len(pdf), [0] * len(pdf), [False] * len(pdf)
        elite = 0
        for i, b in enumerate(bins):
            at = 0
            for p in b:
                number[p], offset[p] = i, at
                at += lengths[p]
            elite += at >= ELITE * capacity
            stays = last or (at >= ELITE * capacity and elite % MIGRANTS != 0)
            for p in b:
                final[p] = stays
        return pdf.assign(number=number, offset=offset, final=final)[
            ["_key", "length", "island", "number", "offset", "final"]]

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, island_pieces: int = ISLAND_PIECES) -> DataFrame:
    """pieces with sequence_id and offset: no sequence longer than capacity."""
    pieces = written(pieces.withColumn("_key", F.monotonically_increasing_id()), "pieces")
    columns = [c for c in pieces.columns if c != "_key"]
    full = F.col("length") >= capacity
    loose = pieces.agg(F.count_if(~full)).first()[0]
    left = pieces.where(~full).select("_key", "length", F.col("_key").alias("bin"))
    # numbers of the sequences: below 0 for full pieces, else level, island and bin
    done = [pieces.where(full).select("_key", (-F.col("_key") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    level, stalled = 0, False
    while loose:
        islands = -(-loose // island_pieces)
        last = islands == 1 or stalled

        result = written(
            with_package(left).withColumn("island", F.pmod(F.xxhash64("bin", F.lit(level)), F.lit(islands)))
            .groupBy("island").applyInPandas(_island(capacity, last), "_key long, length long, island long, number long, offset long, final boolean"),
            f"islands-{level}")
        name = F.expr(f"shiftleft({level}L, 58) + shiftleft(island, 22) + number")
        done.append(result.where("final").select("_key", name.alias("sequence_id"), "offset"))
        left = result.where(~F.col("final")).select("_key", "length", name.alias("bin"))
        before, loose = loose, 0 if last else left.count()
        stalled = 2 * loose > before or level == MOST_LEVELS
        level += 1
    placed = done[0]
    for d in done[1:]:
        placed = placed.unionByName(d)
    return pieces.join(placed, "_key").select(*columns, "sequence_id", "offset")


def pack_documents(df: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    return pack(token_pieces(df, tokenizer, end_id, capacity), capacity)
