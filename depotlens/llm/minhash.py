"""Operator 6: MinHash near-duplicates.

A text's set holds its distinct word shingles as 64-bit hashes. Texts with
equal sets form a class, represented by its smallest doc_id. Each class has
the minima of many universal hash functions; equal bands of minima make
candidates. In every band bucket the member that shares most with others is
the hub that all others are compared with (linear in the bucket). Where a
hub's group is still in several components, its members may be linked past the
hub. That follows from how each differs from the hub's set
(``differences.py``): only pairs in different components whose differences
share one of their first tokens, in bands of like sizes, are made and verified
too. So every pair that shares a bucket is verified, connected or ruled out.

A candidate pair is first verified on the signatures (the share of equal
minima, five standard deviations below the threshold) and then on the full
sets. Components come from alternating large-star and small-star steps.

Words: A-Z lower-cased, runs without \\x20 and \\x09-\\x0D. A text with fewer
words than a shingle has its whole sequence as the one shingle.

* null or empty text, or no words: an empty set, linked with nothing.
* null doc_id: component_id is null, kept is true; such rows link nothing.
* repeated rows: equal results; rows of one doc_id with different texts are
  judged each by its own text. Extra columns are not carried by ``link``.
* ``keep_one`` drops a row only if its own text is a copy: rows of one doc_id
  with unlike texts all stay, of rows with equal doc_id and text one stays.
* very long texts are taken whole. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlens.llm.common import with_package, written
from depotlens.llm.differences import difference_pairs, sure_links
from depotlens.llm.tokens import slices

WORDS = 5
PERCENT = 80
HASHES = 156
MISSED = 1e-5  # largest chance that a pair at the threshold shares no band
SLICE_BYTES = 4 << 20
BLOCK = 1 << 16


def band_shape(percent: int, hashes: int = HASHES, missed: float = MISSED) -> tuple[int, int]:
    """(bands, rows): the longest rows at which a pair at the threshold is
    missed with a chance of at most ``missed``."""
    t = percent / 100
    best = (hashes, 1)
    for rows in range(1, 13):
        bands = hashes // rows
        if (1 - t ** rows) ** bands <= missed:
            best = (bands, rows)
    return best


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, sorted, and how many each has."""
    n = len(texts)
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    offsets = lists.offsets.to_numpy().astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    distinct = coded.dictionary.to_pylist()
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, distinct), np.uint64, len(distinct))
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    real = np.array([w != "" for w in distinct], bool)[code] if len(distinct) else np.empty(0, bool)
    doc = np.repeat(np.arange(n), np.diff(offsets))[real]
    h = hashed[code[real]]
    counts = np.bincount(doc, minlength=n)
    first = np.cumsum(counts) - counts
    shingles, owners = [], []
    for size in range(1, words + 1):  # shorter ones only for texts with no more words
        if size < words:
            start = first[counts == size]
        else:
            start = np.flatnonzero(doc[:len(doc) - words + 1] == doc[words - 1:]) if len(doc) >= words else np.empty(0, np.int64)
        if not len(start):
            continue
        s = h[start]
        for k in range(1, size):
            s = _mix(s * np.uint64(0x9E3779B97F4A7C15) + h[start + k])
        shingles.append(_mix(s))
        owners.append(doc[start])
    if not shingles:
        return np.empty(0, np.uint64), np.zeros(n, np.int64)
    s, owner = np.concatenate(shingles), np.concatenate(owners)
    order = np.lexsort((s, owner))
    s, owner = s[order], owner[order]
    new = np.concatenate([[True], (s[1:] != s[:-1]) | (owner[1:] != owner[:-1])])
    return s[new], np.bincount(owner[new], minlength=n)


def minima(sets: np.ndarray, sizes: np.ndarray, hashes: int) -> np.ndarray:
    """Minima of the hash functions (rows: texts; an empty text has none)."""
    out = np.full((len(sizes), hashes), 0xFFFFFFFF, np.uint32)
    rng = np.random.default_rng(20240607)
    a = rng.integers(0, 1 << 63, hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 1 << 63, hashes, dtype=np.uint64)
    held = np.flatnonzero(sizes)
    ends = np.cumsum(sizes[held])
    cuts = [0, *(np.flatnonzero(np.diff(ends // BLOCK)) + 1).tolist(), len(held)]
    for i, j in zip(cuts, cuts[1:]):
        if i == j:
            continue
        begin = ends[i] - sizes[held[i]]
        x = sets[begin:ends[j - 1]]
        starts = np.concatenate([[0], ends[i:j - 1] - begin])
        block = np.empty((hashes, j - i), np.uint32)
        for k in range(hashes):
            block[k] = np.minimum.reduceat(((x * a[k] + b[k]) >> np.uint64(32)).astype(np.uint32), starts)
        out[held[i:j]] = block.T
    return out


def _text_key() -> Column:
    """Tells the texts of one doc_id apart (null: as empty)."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def sketch(docs: DataFrame, words: int, percent: int, hashes: int = HASHES) -> DataFrame:
    """(doc_id, text_key, n_shingles, set_a, set_b, bands, signature) of every
    row: two 64-bit sums that name the set, band hashes, 16 bits of every minimum."""
    bands, rows = band_shape(percent, hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, size=SLICE_BYTES):
                sets, sizes = shingle_sets(part.column(1), words)
                low = minima(sets, sizes, bands * rows)
                owner = np.repeat(np.arange(len(sizes)), sizes)
                sums = []
                for salt in (0x1234567, 0x7654321):
                    total = np.zeros(len(sizes), np.uint64)
                    np.add.at(total, owner, _mix(sets + np.uint64(salt)))
                    sums.append(pa.array(total.view(np.int64)))
                keys = np.empty((len(sizes), bands), np.uint64)
                for k in range(bands):
                    key = np.full(len(sizes), k + 1, np.uint64)
                    for r in range(rows):
                        key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + low[:, k * rows + r])
                    keys[:, k] = key
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, keys.size + 1, bands, dtype=np.int32)), pa.array(keys.ravel().view(np.int64)))
                short = low.astype("<u2")
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(sizes), *sums, lists, pa.array([r.tobytes() for r in short], pa.binary())],
                    names=["doc_id", "text_key", "n_shingles", "set_a", "set_b", "bands", "signature"])

    rows_ = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _text_key().alias("text_key"))
    return with_package(rows_).mapInArrow(
        run, "doc_id long, text_key long, n_shingles long, set_a long, set_b long, bands array<long>, signature binary")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (u, v): the smallest node
    that it reaches."""
    u, v = F.col("u"), F.col("v")
    edges = written(edges.where(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct(), "edges")
    before = None
    while True:
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before:
            break
        before = state
        both = edges.unionByName(edges.select(v.alias("u"), u.alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where(v > u).select(v.alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where(v != F.col("m")).select(v.alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))))
        edges = written(small.where(u != v).distinct(), "edges")
    return edges.select(u.alias("node"), v.alias("component")).unionByName(
        edges.select(v.alias("node"), v.alias("component")).distinct())


def verified_signatures(pairs: DataFrame, signatures: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose signatures agree nearly as often as the threshold asks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            one, two = (np.frombuffer(b"".join(batch.column(k).to_pylist()), "<u2").reshape(len(batch), -1) for k in (2, 3))
            t, n = percent / 100, one.shape[1]
            least = t - 5 * (t * (1 - t) / n) ** 0.5
            good = (one == two).mean(axis=1) >= least
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(good)) for c in batch.columns[:2]], names=["u", "v"])

    one = signatures.select(F.col("node").alias("u"), F.col("signature").alias("one"))
    two = signatures.select(F.col("node").alias("v"), F.col("signature").alias("two"))
    both = pairs.join(two, "v").join(one, "u").select("u", "v", "one", "two")
    return with_package(both).mapInArrow(run, "u long, v long")


def _with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    one = texts.select(F.col("node").alias("u"), F.col("text").alias("one"))
    two = texts.select(F.col("node").alias("v"), F.col("text").alias("two"))
    return pairs.join(two, "v").join(one, "u").select("u", "v", "one", "two")


def _set_pairs(part: pa.RecordBatch, words: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The sets of both texts (columns 2 and 3) of every row."""
    ones = part.column(2).dictionary_encode()  # a hub's text stands in many rows
    sets, sizes = shingle_sets(pa.concat_arrays([ones.dictionary, part.column(3)]), words)
    ends = np.cumsum(sizes)
    held = [sets[e - n:e] for e, n in zip(ends.tolist(), sizes.tolist())]
    for i, c in enumerate(ones.indices.to_pylist()):
        yield held[c], held[len(ones.dictionary) + i]


def verified_sets(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (u, v) whose full sets are similar enough."""
    def similar(a: np.ndarray, b: np.ndarray) -> bool:
        if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
            return False
        shared = len(np.intersect1d(a, b, assume_unique=True))
        return 100 * shared >= percent * (len(a) + len(b) - shared) and shared > 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "one", SLICE_BYTES):
                good = pa.array([similar(a, b) for a, b in _set_pairs(part, words)], pa.bool_())
                yield pa.RecordBatch.from_arrays([c.filter(good) for c in part.columns[:2]], names=["u", "v"])

    return with_package(_with_texts(pairs, texts)).mapInArrow(run, "u long, v long")


def differences(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """(u, v, margin, tokens) of the pairs (hub u, member v): the shingles that
    only one of both sets holds, and the margin that these leave v."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "one", SLICE_BYTES):
                margins, tokens = [], []
                for a, b in _set_pairs(part, words):
                    apart = np.setxor1d(a, b, assume_unique=True)
                    margins.append((100 - percent) * len(b) - (100 + percent) * len(apart))
                    tokens.append(apart.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:2], pa.array(margins, pa.int64()), pa.array(tokens, pa.list_(pa.int64()))],
                    names=["u", "v", "margin", "tokens"])

    return with_package(_with_texts(pairs, texts)).mapInArrow(run, "u long, v long, margin long, tokens array<long>")


def _links(docs: DataFrame, words: int, percent: int, hashes: int) -> DataFrame:
    """(doc_id, text_key, n_shingles, component, component_id) of every row;
    the component (null for an empty set or a null doc_id) tells apart those
    that have one smallest doc_id in common."""
    sketches = written(sketch(docs, words, percent, hashes), "sketches")
    real = sketches.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = written(
        real.groupBy("set_a", "set_b").agg(F.min(F.struct("doc_id", "text_key")).alias("first"))
        .select("set_a", "set_b", F.xxhash64("set_a", "set_b").alias("node"), "first.*"), "classes")
    firsts = written(
        real.join(classes.select("node", "doc_id", "text_key"), ["doc_id", "text_key"])
        .select("node", "doc_id", "text_key", "signature", "bands").dropDuplicates(["node"]), "representatives")
    signatures = firsts.select("node", "signature")
    keys = firsts.select("node", F.explode("bands").alias("key"))
    sizes = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = written(keys.join(sizes, "key"), "bucket-members")
    # a text that shares many large buckets stands in the middle of its group
    weights = members.groupBy("node").agg(F.sum("n").alias("weight"))
    members = written(members.join(weights, "node").select("key", "node", "weight"), "weighted-members")
    asked = firsts.join(weights.select("node"), "node", "left_semi").select("node", "doc_id", "text_key")
    texts = written(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text_key().alias("text_key"),
                    F.coalesce("text", F.lit("")).alias("text"))
        .join(asked, ["doc_id", "text_key"]).groupBy("node").agg(F.min("text").alias("text")), "candidate-texts")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        ordered = pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
        near = written(verified_signatures(ordered, signatures, percent), f"{name}-near")
        return written(verified_sets(near, texts, words, percent), name)

    def mixed(links: DataFrame, groups: DataFrame) -> DataFrame:
        named = groups.select("hub", "node").join(components(links), "node", "left").select(
            "hub", "node", F.coalesce("component", "node").alias("component"))
        several = named.groupBy("hub").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a < b")
        return written(named.join(several.select("hub"), "hub", "left_semi"), "mixed-groups")

    middle = F.struct("weight", -F.col("node"))
    hubs = members.groupBy("key").agg(F.max_by("node", middle).alias("hub"))
    groups = written(members.join(hubs, "key").select("hub", "node").distinct(), "hub-groups")
    pairs = groups.select(F.col("hub").alias("u"), F.col("node").alias("v"))
    links = verified(pairs.where("u <> v"), "hub-links")
    groups = mixed(links, groups)
    apart = written(differences(
        groups.select(F.col("hub").alias("u"), F.col("node").alias("v")), texts, words, percent), "differences")
    links = written(links.unionByName(sure_links(apart)), "sure-links")
    found = verified(difference_pairs(mixed(links, groups), apart, percent), "cross-links")
    final = components(links.unionByName(found))
    named = classes.join(final, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = named.join(least, "component").select("set_a", "set_b", "component", "component_id")
    columns = ["doc_id", "text_key", "n_shingles", "component", "component_id"]
    linked = real.join(named, ["set_a", "set_b"]).select(*columns)
    alone = sketches.where((F.col("n_shingles") == 0) | F.col("doc_id").isNull()).select(
        "doc_id", "text_key", "n_shingles", F.lit(None).cast("long").alias("component"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)


def link(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, hashes: int = HASHES) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row."""
    return _links(docs, words, percent, hashes).select(
        "doc_id", "n_shingles", "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, hashes: int = HASHES) -> DataFrame:
    """One document of each group (the smallest doc_id), with all its columns.
    Rows without words or with a null doc_id are nobody's copies and stay; of
    rows with equal doc_id and text the one with the smallest columns stays."""
    decided = _links(docs, words, percent, hashes).where("doc_id IS NOT NULL")
    kept = decided.where("component IS NOT NULL").groupBy("component").agg(
        F.min(F.struct("doc_id", "text_key")).alias("first")).select("first.*")
    kept = kept.unionByName(decided.where("component IS NULL").select("doc_id", "text_key")).distinct()
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), _text_key().alias("_key"), F.struct("*").alias("row"))
    one = (rows.join(kept.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")), ["_id", "_key"], "left_semi")
           .groupBy("_id", "_key").agg(F.min("row").alias("row")))
    return one.select("row.*").unionByName(docs.where(F.col("doc_id").isNull()))
