"""Operator 12: word n-gram Jaccard join by several global token orders.

A text's set holds its distinct word shingles as 64-bit hashes; equal sets are
one node. If two sets are similar enough, the first tokens of both under any
order that all sets share have a token in common, where "first" means so many
that the rest alone could not reach the threshold. Tokens of one node come
first in every order used here (they can't be shared, so they need no rows),
then follow the others

* by document frequency, ties by a hash (rare tokens first),
* by the power of two of the frequency, ties by another hash,
* by a third hash alone.

Frequencies are exact: each task packs its tokens by bucket of the token, one
task per bucket counts them, and only tokens of two nodes or more travel on to
their nodes. A node with enough tokens of its own is ruled out at once.

Pairs are never made all with all. Each token's nodes are compared with one of
them, the hub (the node that shares most), if they also share a first token
under the other orders; full sets decide. What the hub does not connect is
searched by differences from the hub's set R: with D(x) = x without R and R
without x, two nodes link if and only if their differences D(x), D(y) share
enough tokens, and how many follows from their sizes. So the nodes of a hub
meet only where D(x) and D(y) have a token in common among their own first
ones, in bands of like sizes (the larger the differences, the fewer first
tokens). Nodes whose differences are so small that they link in any case are
joined to the smallest one. Pairs found this way pass the three orders and the
full sets, too. Components come from the links.

Words: A-Z lower-cased, runs without \\x20 and \\x09-\\x0D. A text with fewer
words than a shingle has its whole sequence as the one shingle.

* null or empty text, or no words: an empty set, linked with nothing.
* null doc_id: component_id is null, the row links nothing.
* repeated rows: equal results; rows of one doc_id with different texts are
  judged each by its own text.
* very long texts are taken whole. Extra columns are not carried, whatever
  their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotlens.llm.common import with_package, written
from depotlens.llm.differences import difference_pairs, sure_links
from depotlens.llm.minhash import components, shingle_sets
from depotlens.llm.tokens import slices

WORDS, PERCENT = 5, 80
BUCKET_BYTES = 16 << 20  # text per bucket of tokens and group of nodes
SLICE_BYTES = 4 << 20
HELD_KEYS = 8 << 20  # keys of a bucket held before frequent ones leave
FREQUENT = 65535  # frequencies from here on count as equal
SALTED = 500  # members of a hub that one task compares

#: kinds of rows that travel together: documents, sizes of nodes, tokens by bucket or node group, nodes
DOC, SIZE, TOKENS, NODE = range(4)
PACKED = "kind int, part long, doc_id long, n long, node long, nodes binary, counts binary, keys binary, freqs binary"
NAMES = [c.split()[0] for c in PACKED.split(", ")]
TYPES = [pa.int32(), *[pa.int64()] * 4, *[pa.binary()] * 4]
NODES = ("kind int, doc_id long, n long, node long, known binary, one array<long>, two array<long>, three array<long>")


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = x.view(np.uint64) + np.uint64(salt)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _runs(x: np.ndarray) -> np.ndarray:
    """Where runs of equal values start, and the end."""
    return np.concatenate([[0], np.flatnonzero(x[1:] != x[:-1]) + 1, [len(x)]]) if len(x) else np.zeros(1, np.int64)


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, TYPES)], names=NAMES)


def _by_part(kind: int, part: np.ndarray, node: np.ndarray, keys: np.ndarray, freqs: np.ndarray | None = None) -> pa.RecordBatch:
    """Tokens packed by part: its nodes, tokens per node, the tokens."""
    order = np.lexsort((node, part))
    part, node, keys = part[order], node[order], keys[order]
    freqs = freqs[order] if freqs is not None else None
    rows = []
    cuts = _runs(part)
    for a, b in zip(cuts, cuts[1:]):
        at = _runs(node[a:b])
        rows.append((kind, int(part[a]), None, None, None, node[a:b][at[:-1]].tobytes(), np.diff(at).astype("<i4").tobytes(),
                     keys[a:b].tobytes(), freqs[a:b].astype("<u2").tobytes() if freqs is not None else None))
    return _packed(rows)


def packed_sets(docs: DataFrame, words: int, parts: int) -> DataFrame:
    """Every document with its node, and its tokens packed by bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, size=SLICE_BYTES):
                sets, sizes = shingle_sets(part.column(1), words)
                owner = np.repeat(np.arange(len(sizes)), sizes)
                total = np.zeros(len(sizes), np.uint64)
                np.add.at(total, owner, _mix(sets, 0x1234567))
                node = total.view(np.int64)
                ids = part.column(0).to_pylist()
                yield _packed([(DOC, i % parts, d, n, v if n else None, *[None] * 4)
                               for i, (d, n, v) in enumerate(zip(ids, sizes.tolist(), node.tolist()))])
                real = np.array([d is not None for d in ids]) & (sizes > 0)
                held = np.flatnonzero(real)
                held = held[np.unique(node[held], return_index=True)[1]]  # a slice's copies count once
                yield _by_part(SIZE, node[held] % parts, node[held], sizes[held].astype(np.int64))
                first = np.zeros(len(sizes), bool)
                first[held] = True
                mine = first[owner]
                tokens = sets[mine].view(np.int64)
                yield _by_part(TOKENS, ((sets[mine] >> np.uint64(20)) % np.uint64(parts)).astype(np.int64), node[owner[mine]], tokens)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return with_package(rows).mapInArrow(run, PACKED)


class Bucket:
    """Tokens of one bucket: exact frequencies over distinct nodes. A token of
    more than ``FREQUENT`` nodes leaves early, so a few very frequent tokens
    never fill the memory; the orders treat all such tokens alike."""

    def __init__(self, part: int, parts: int):
        self.part, self.parts = part, parts
        self.nodes, self.counts, self.keys = [], [], []
        self.held, self.most = 0, HELD_KEYS
        self.frequent = np.empty(0, np.int64)

    def add(self, nodes: bytes, counts: bytes, keys: bytes) -> Iterator[pa.RecordBatch]:
        self.nodes.append(np.frombuffer(nodes, "<i8"))
        self.counts.append(np.frombuffer(counts, "<i4"))
        self.keys.append(np.frombuffer(keys, "<i8"))
        self.held += len(self.keys[-1])
        if self.held > self.most:
            yield from self.give(last=False)
            self.most = max(HELD_KEYS, 2 * self.held)

    def give(self, last: bool = True) -> Iterator[pa.RecordBatch]:
        if not self.nodes:
            return
        nodes, counts, keys = map(np.concatenate, (self.nodes, self.counts, self.keys))
        first = np.zeros(len(nodes), bool)  # a node of several slices has the same tokens in each
        first[np.unique(nodes, return_index=True)[1]] = True
        keys, nodes, counts = keys[np.repeat(first, counts)], nodes[first], counts[first]
        owner = np.repeat(nodes, counts)
        distinct, at, n = np.unique(keys, return_inverse=True, return_counts=True)
        n = np.where(np.isin(distinct, self.frequent), FREQUENT, np.minimum(n, FREQUENT))
        self.frequent = np.union1d(self.frequent, distinct[n == FREQUENT])
        freq = n[at]
        out = freq > 1 if last else freq == FREQUENT
        if out.any():
            yield _by_part(TOKENS, owner[out] % self.parts, owner[out], keys[out], freq[out])
        stay = np.flatnonzero(~out)
        runs = _runs(owner[stay])
        self.nodes, self.counts, self.keys = [owner[stay][runs[:-1]]], [np.diff(runs).astype(np.int32)], [keys[stay]]
        self.held = len(stay)


def counted(rows: DataFrame, parts: int) -> DataFrame:
    """Tokens of two nodes or more with their frequency, packed by node group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = None
        for batch in batches:
            kind = batch.column(0).to_numpy()
            through = batch.filter(pa.array(kind != TOKENS))
            if len(through):
                yield through
            tokens = batch.filter(pa.array(kind == TOKENS))
            for part, *packed in zip(*(tokens.column(k).to_pylist() for k in (1, 5, 6, 7))):
                if bucket is None or bucket.part != part:
                    if bucket is not None:
                        yield from bucket.give()
                    bucket = Bucket(part, parts)
                yield from bucket.add(*packed)
        if bucket is not None:
            yield from bucket.give()

    return with_package(rows.repartition("part").sortWithinPartitions("part")).mapInArrow(run, PACKED)


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    """First tokens of a set of n that a similar enough set must meet."""
    return n + (-percent * n) // 100 + 1


def first_tokens(node: np.ndarray, key: np.ndarray, freq: np.ndarray, need: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Under each order, the places of the first ``need`` (by node number)
    shared tokens, by node."""
    level = np.floor(np.log2(freq)).astype(np.int64)
    orders = [(_mix(key, 1), freq), (_mix(key, 2), level), (_mix(key, 3), np.zeros(len(key), np.int64))]
    out = []
    for hashed, rarity in orders:
        order = np.lexsort((hashed, rarity, node))
        begin = _runs(node[order])
        rank = np.arange(len(order)) - np.repeat(begin[:-1], np.diff(begin))
        out.append(order[rank < need[node[order]]])
    return out


def nodes_of(rows: DataFrame, percent: int) -> DataFrame:
    """Documents, and the nodes that may have a partner: size, shared tokens,
    first tokens under the three orders."""
    names = [c.split()[0] for c in NODES.split(", ")]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), *[pa.list_(pa.int64())] * 3]

    def lists(nodes: int, node: np.ndarray, key: np.ndarray, at: np.ndarray) -> pa.Array:
        offsets = np.concatenate([[0], np.cumsum(np.bincount(node[at], minlength=nodes))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(key[at]))

    def group(sizes: list[tuple], tokens: list[tuple]) -> Iterator[pa.RecordBatch]:
        ids, first = np.unique(np.concatenate([np.frombuffer(s[0], "<i8") for s in sizes]), return_index=True)
        n = np.concatenate([np.frombuffer(s[1], "<i8") for s in sizes])[first]
        node = np.concatenate([np.repeat(np.frombuffer(t[0], "<i8"), np.frombuffer(t[1], "<i4")) for t in tokens])
        key = np.concatenate([np.frombuffer(t[2], "<i8") for t in tokens])
        freq = np.concatenate([np.frombuffer(t[3], "<u2") for t in tokens]).astype(np.int64)
        node = np.searchsorted(ids, node)
        order = np.lexsort((key, node))
        node, key, freq = node[order], key[order], freq[order]
        new = np.concatenate([[True], (node[1:] != node[:-1]) | (key[1:] != key[:-1])])
        node, key, freq = node[new], key[new], freq[new]
        need = prefix_length(n, percent) - (n - np.bincount(node, minlength=len(ids)))
        live = need > 0
        number = np.cumsum(live) - 1
        mine = live[node]
        node, key, freq, ids, n, need = number[node[mine]], key[mine], freq[mine], ids[live], n[live], need[live]
        cuts = np.searchsorted(node, np.arange(len(ids) + 1))
        known = pa.array([key[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())
        orders = [lists(len(ids), node, key, at) for at in first_tokens(node, key, freq, need)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(ids), NODE), pa.int32()), pa.nulls(len(ids), pa.int64()), pa.array(n), pa.array(ids), known, *orders],
            names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, sizes, tokens = None, [], []
        for batch in batches:
            kind = batch.column(0).to_numpy()
            docs = batch.filter(pa.array(kind == DOC))
            if len(docs):
                yield pa.RecordBatch.from_arrays(
                    [docs.column(0), *docs.columns[2:5], *(pa.nulls(len(docs), t) for t in types[4:])], names=names)
            rest = batch.filter(pa.array(kind != DOC))
            for k, p, nodes, counts, keys, freqs in zip(*(rest.column(c).to_pylist() for c in (0, 1, 5, 6, 7, 8))):
                if p != part:
                    if tokens:
                        yield from group(sizes, tokens)
                    part, sizes, tokens = p, [], []
                if k == SIZE:
                    sizes.append((nodes, keys))
                else:
                    tokens.append((nodes, counts, keys, freqs))
        if tokens:
            yield from group(sizes, tokens)

    return with_package(rows.repartition("part").sortWithinPartitions("part", "kind")).mapInArrow(run, NODES)


def compared(pairs: DataFrame, nodes: DataFrame, percent: int, differences: bool = False) -> DataFrame:
    """The pairs (u, v) that are similar enough by their full sets; or, with
    ``differences``, of every pair (hub u, v) v's margin and the tokens in
    which its shared tokens differ from the hub's. A hub's pairs are salted."""
    schema = "u long, v long, margin long, tokens array<long>" if differences else "u long, v long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            u, v, n, m, a, b = (batch.column(k).to_pylist() for k in range(6))
            good, margins, tokens, last, first = [], [], [], None, None
            for i in range(len(batch)):
                if u[i] != last:
                    last, first = u[i], np.frombuffer(a[i], "<i8")
                other = np.frombuffer(b[i], "<i8")
                if differences:
                    apart = np.setxor1d(first, other, assume_unique=True)
                    own = m[i] - len(other)  # tokens of no other node
                    margins.append((100 - percent) * m[i] - (100 + percent) * (len(apart) + own))
                    tokens.append(apart)
                    good.append(True)
                else:
                    shared = len(np.intersect1d(first, other, assume_unique=True))
                    good.append(100 * shared >= percent * (n[i] + m[i] - shared))
            columns = [batch.column(k).filter(pa.array(good)) for k in (0, 1)]
            if differences:
                columns += [pa.array(margins, pa.int64()), pa.array(tokens, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in schema.split(", ")])

    load = pairs.groupBy("u").agg((F.count("*") / SALTED).cast("int").alias("last"))
    salted = pairs.withColumn("h", F.pmod(F.xxhash64("v"), F.lit(1 << 40))).join(load, "u").withColumn(
        "salt", (F.col("h") % (F.col("last") + 1)).cast("int")).drop("h", "last")
    left = nodes.join(load, nodes["node"] == load["u"]).select(
        "u", F.explode(F.sequence(F.lit(0), "last")).alias("salt"), F.col("n").alias("n_u"), F.col("known").alias("known_u"))
    right = nodes.select(F.col("node").alias("v"), F.col("n").alias("n_v"), F.col("known").alias("known_v"))
    both = salted.join(right, "v").join(left, ["u", "salt"]).select("u", "v", "n_u", "n_v", "known_u", "known_v")
    return with_package(both).mapInArrow(run, schema)


def filtered(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs that meet under all three orders, whose sizes are close
    enough, and whose shared tokens could suffice."""
    def side(k: str) -> DataFrame:
        return nodes.select(F.col("node").alias(k), F.col("n").alias(f"n_{k}"), (F.length("known") / 8).alias(f"most_{k}"),
                            *[F.col(c).alias(f"{c}_{k}") for c in ("one", "two", "three")])

    both = F.col("n_u") + F.col("n_v")
    enough = (100 + percent) * F.least("most_u", "most_v") >= percent * both
    near = 100 * F.least("n_u", "n_v") >= percent * F.greatest("n_u", "n_v")
    meet = [F.arrays_overlap(f"{c}_u", f"{c}_v") for c in ("one", "two", "three")]
    return pairs.join(side("v"), "v").join(side("u"), "u").where(near & enough & meet[0] & meet[1] & meet[2]).select("u", "v")


def _linked(pairs: DataFrame, nodes: DataFrame, percent: int, name: str) -> DataFrame:
    candidates = written(filtered(pairs, nodes, percent), f"{name}-candidates")
    return written(compared(candidates, nodes, percent), f"{name}-links")


def node_links(nodes: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) that connect the same nodes as all links do."""
    tokens = nodes.select("node", F.explode("one").alias("token"))
    sizes = tokens.groupBy("token").agg(F.count("*").alias("n")).where("n > 1")
    members = written(tokens.join(sizes, "token"), "token-members")
    weights = members.groupBy("node").agg(F.sum("n").alias("weight"))
    members = members.join(weights, "node")
    hubs = members.groupBy("token").agg(F.max_by("node", F.struct("weight", -F.col("node"))).alias("hub"))
    stars = written(members.join(hubs, "token").select("hub", "node").distinct(), "stars")
    pairs = stars.where("hub <> node").select(F.col("hub").alias("u"), F.col("node").alias("v"))
    links = _linked(pairs, nodes, percent, "hub")

    def mixed(links: DataFrame, stars: DataFrame) -> DataFrame:
        named = stars.select("hub", "node").join(components(links), "node", "left").select(
            "hub", "node", F.coalesce("component", "node").alias("component"))
        several = named.groupBy("hub").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a < b")
        return written(named.join(several.select("hub"), "hub", "left_semi"), "mixed-stars")

    stars = mixed(links, stars)
    pairs = stars.select(F.col("hub").alias("u"), F.col("node").alias("v"))
    apart = written(compared(pairs, nodes, percent, differences=True), "differences")
    links = written(links.unionByName(sure_links(apart)), "sure-links")
    stars = mixed(links, stars)
    found = _linked(difference_pairs(stars, apart, percent), nodes, percent, "difference")
    return links.unionByName(found)


def join(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(8, -(-size // BUCKET_BYTES))
    rows = written(nodes_of(counted(packed_sets(docs, words, parts), parts), percent), "join-nodes")
    nodes = rows.where(F.col("kind") == NODE)
    every = rows.where(F.col("kind") == DOC).select("doc_id", F.col("n").alias("n_shingles"), "node")
    final = components(node_links(nodes, percent))
    firsts = every.where("node IS NOT NULL AND doc_id IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("first"))
    named = firsts.join(final, "node", "left").select("node", "first", F.coalesce("component", "node").alias("component"))
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    named = written(named.join(least, "component").select("node", "component_id"), "join-components")
    linked = every.where("node IS NOT NULL AND doc_id IS NOT NULL").join(named, "node").select(
        "doc_id", "n_shingles", "component_id")
    alone = every.where("node IS NULL OR doc_id IS NULL").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)
