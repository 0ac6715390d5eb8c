"""Operator 9: toxicity by a subsequence kernel with Nyström landmarks.

The kernel of two words counts their common subsequences of three letters
within a span of five, each weighted by DECAY to the power of its span, and is
normalised: gaps and inserted characters weaken a match but do not break it.
Landmarks are the words of the training texts that tell toxic from other texts
best, as far as they differ from each other. A text's feature for a landmark
is the sum of its words' kernel values, each smoothly raised or lowered
around HALF (no value is cut to zero), so that repetition and
density count: once as it is (its logarithm, which keeps the order and tames
long texts) and once divided by the square root of the text's number of words,
which is how the kernel norm of a text of unlike words grows. The Nyström map
(inverse square root of the landmarks' kernel matrix) turns both into features
of the kernel, and a linear support vector machine with Platt's scaling is
fitted on them.

Words are the letters of what stands between white space, lower-cased, without
accents; those with other characters inside are read joined and in their parts,
and the larger counts. Three or more single letters in a row are also read as
one word. A word's value for a landmark is the best of the word as a whole and of
its windows of the landmark's length and two and four letters more, at every
letter; a window is normalised by its subsequences of the landmark's letters, so
that neither the rest of a long word nor inserted letters enter the norm of the
matched part. Long words are read in blocks, each with the windows that start in
it, and add up (a match at the border of two blocks counts up to twice).

The fit uses at most ``train_rows`` labelled rows (a documented bound: their
ids are broadcast, their features of at most ``LANDMARKS`` numbers collected).
Scores cover every text whole.

* null or empty text: the score of a text without toxic words.
* no usable labels (none, or one class): every score is 0.
* conflicting labels of one doc_id: toxic wins. A null doc_id is never
  trained on and counts as not held out; repeated rows give one row each.
* extra columns are not carried by ``score``; ``reject`` keeps all columns.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlens.llm.common import with_package, worker_state, written
from depotlens.llm.tokens import slices

DECAY = 0.8
SPAN = 5
LANDMARKS = 64
HALF = 0.7  # the kernel value that counts about half
GAPS = (0, 2, 4)  # letters that a window has more than its landmark
COVER = 0.2  # windows that hold less of a landmark count by their word's value only
CANDIDATES = 400
TRAIN_ROWS = 20_000
WIDEST, STRIDE = 24, 16  # letters of the widest landmark in windows, window starts in a block of a long word
CACHED_WORDS = 60_000
WORDS_AT_ONCE = 20_000
BLOCKS_AT_ONCE = 2_000
PAIRS_AT_ONCE = 20_000
LETTERS_AT_ONCE = 100_000
SLICE_BYTES = 2 << 20

_SHAPES = [(a, b, DECAY ** (b + 1)) for a in range(1, SPAN - 1) for b in range(a + 1, SPAN)]


@lru_cache(maxsize=1)
def _letter_codes() -> np.ndarray:
    """1 to 26 for letters (without accents), 27 to 31 for other scripts, 0 else."""
    out = np.zeros(0x3000, np.uint8)
    for c in range(len(out)):
        base = unicodedata.normalize("NFKD", chr(c))[0].lower()
        if "a" <= base <= "z":
            out[c] = ord(base) - 96
        elif chr(c).isalpha():
            out[c] = 27 + c % 5
    return out


def _characters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the characters of all words, and whose they are."""
    codes = _letter_codes()
    points = np.frombuffer("".join(words).lower().encode("utf-32-le"), np.uint32)
    sizes = np.fromiter((len(w) for w in words), np.int64, len(words))
    if len(points) != sizes.sum():  # a letter whose lower case has another length
        words = [w.lower() for w in words]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    code = np.where(points < len(codes), codes[np.minimum(points, len(codes) - 1)], 27).astype(np.int64)
    return code, np.repeat(np.arange(len(words)), sizes)


def letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the letters of all words, and how many each word has."""
    code, owner = _characters(words)
    return code[code > 0], np.bincount(owner[code > 0], minlength=len(words))


def subsequences(code: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, subsequence, weight) of every occurrence, words of any order."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    out = []
    for a, b, weight in _SHAPES:
        n = len(code) - b
        if n <= 0:
            continue
        inside = np.flatnonzero(owner[:n] == owner[b:])
        out.append((owner[inside], code[inside] << 10 | code[inside + a] << 5 | code[inside + b], np.full(len(inside), weight)))
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    return tuple(np.concatenate(x) for x in zip(*out))


def norms(word: np.ndarray, sub: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """Square roots of the words' kernel values with themselves."""
    key, at = np.unique(word << 15 | sub, return_inverse=True)
    total = np.bincount(at, weights=weight, minlength=len(key))
    return np.sqrt(np.bincount(key >> 15, weights=total * total, minlength=n))


class Kernel:
    """Normalised kernel values of words with the landmarks."""

    def __init__(self, landmarks: list[str]):
        n = len(landmarks)
        code, sizes = letters(landmarks)
        word, sub, weight = subsequences(code, sizes)
        own = norms(word, sub, weight, n)
        table = np.zeros((1 << 15, n), np.float32)
        np.add.at(table, (sub, word), weight / np.maximum(own[word], 1e-9))
        self.used = table.any(axis=1)
        self.n, self.table, self.sizes = n, table, np.clip(sizes, 3, WIDEST)
        self.reach = int(self.sizes.max(initial=3)) + max(GAPS)
        self.own = own
        self.letters = np.zeros((n, 32), bool)
        self.letters[np.repeat(np.arange(n), sizes), code] = True

    def products(self, code: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(words, products, norms) of the words that share a subsequence with a landmark."""
        word, sub, weight = subsequences(code, sizes)
        n = len(sizes)
        hits = np.flatnonzero(self.used[sub])
        if not len(hits):
            return np.empty(0, np.int64), np.empty((0, self.n), np.float32), np.empty(0)
        hits = hits[np.argsort(word[hits], kind="stable")]
        border = np.flatnonzero(np.concatenate([[True], np.diff(word[hits]) != 0]))
        words = word[hits[border]]
        products = np.empty((len(words), self.n), np.float32)
        for at in range(0, len(border), BLOCKS_AT_ONCE):
            first = border[at:at + BLOCKS_AT_ONCE]
            end = border[at + BLOCKS_AT_ONCE] if at + BLOCKS_AT_ONCE < len(border) else len(hits)
            some = hits[first[0]:end]
            products[at:at + len(first)] = np.add.reduceat(
                self.table[sub[some]] * weight[some, None].astype(np.float32), first - first[0], axis=0)
        place = np.full(n, -1)
        place[words] = np.arange(len(words))
        mine = place[word] >= 0
        return words, products, np.maximum(norms(place[word[mine]], sub[mine], weight[mine], len(words)), 1e-9)

    def __call__(self, code: np.ndarray, sizes: np.ndarray, floor: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
        """(words, values) of the words with a value of at least the floor."""
        words, products, own = self.products(code, sizes)
        values = np.minimum(products / own[:, None], 1).astype(np.float32)
        good = values.max(axis=1, initial=0) >= floor
        return words[good], np.where(values[good] >= floor, values[good], 0)

    def best(self, code: np.ndarray, sizes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(words, values): the best of a whole word and of its windows that
        begin at one of its first ``starts`` letters."""
        words, products, own = self.products(code, sizes)
        values = np.minimum(products / own[:, None], 1).astype(np.float32)
        begin = (np.cumsum(sizes) - sizes)[words]
        size, starts = sizes[words], starts[words]
        # a window's product is at most its word's
        row, mark = np.nonzero((products >= COVER * self.own) & (values < 0.999))
        longest = np.minimum(size[row, None], self.sizes[mark, None] + np.array(GAPS))
        for wide in range(3, self.reach + 1):
            held = (longest == wide).any(axis=1)
            r, m = row[held], mark[held]
            count = np.minimum(size[r] - wide + 1, starts[r])
            ends = np.cumsum(count)
            at = 0
            while at < len(r):
                to = max(int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS_AT_ONCE)), at + 1)
                self._windows(code, begin, r[at:to], m[at:to], count[at:to], wide, values)
                at = to
        return words, values

    def _windows(self, code, begin, r, m, count, wide, values) -> None:
        """Raise values[r, m] to the best of ``count`` windows of ``wide`` letters."""
        pair = np.repeat(np.arange(len(r)), count)
        start = begin[r[pair]] + np.arange(len(pair)) - np.repeat(np.cumsum(count) - count, count)
        mark = m[pair]
        product = np.zeros(len(pair))
        for a, b, weight in _SHAPES:
            for i in range(wide - b):
                product += weight * self.table[code[start + i] << 10 | code[start + i + a] << 5 | code[start + i + b], mark]
        good = product >= COVER * self.own[mark]
        if good.any():
            start, pair, mark = start[good], pair[good], mark[good]
            word, sub, weight = subsequences(code[start[:, None] + np.arange(wide)].ravel(), np.full(len(start), wide))
            of = mark[word]  # other letters than the landmark's stand for gaps
            kept = self.letters[of, sub >> 10] & self.letters[of, sub >> 5 & 31] & self.letters[of, sub & 31]
            value = np.minimum(product[good] / norms(word[kept], sub[kept], weight[kept], len(start)), 1)
            np.maximum.at(values, (r[pair], mark), value.astype(np.float32))


def raised(values: np.ndarray) -> np.ndarray:
    """0 to 1, increasing: strong matches count nearly whole, chance ones little."""
    power = np.square(np.square(np.square(values)))
    return (1 + HALF ** 8) * power / (power + HALF ** 8)


class Pooled:
    """Features of whole texts: per landmark the sum of the words' kernel
    values, raw (as log1p) and normalised by the number of words."""

    def __init__(self, landmarks: list[str]):
        self.kernel = Kernel(landmarks)
        self.rows: dict[str, int] = {}  # 0: no match
        self.values = np.zeros((1, self.kernel.n), np.float32)
        self.single: dict[str, str] = {}

    def _pieces(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Letters, sizes, words and kinds (0: joined, 1: part between other
        characters) of all readings of the words."""
        code, owner = _characters(words)
        letter = code > 0
        code, owner = code[letter], owner[letter]
        joined = np.bincount(owner, minlength=len(words))
        gap = np.cumsum(~letter)[letter]
        cut = np.concatenate([[True], (np.diff(owner) != 0) | (np.diff(gap) != 0)])[:len(code)]
        run = np.cumsum(cut) - 1
        whose = owner[cut]
        several = np.bincount(whose, minlength=len(words))[whose] > 1
        parts = np.bincount(run, minlength=len(whose))[several]
        return (np.concatenate([code, code[several[run]]]), np.concatenate([joined, parts]),
                np.concatenate([np.arange(len(words)), whose[several]]),
                np.repeat([0, 1], [len(words), len(parts)]))

    def _evaluate(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Row per word, and the values of the rows (row 0: nothing)."""
        code, sizes, owner, kind = self._pieces(words)
        long, reach = STRIDE + self.kernel.reach - 1, self.kernel.reach
        # blocks: one per piece, or one per STRIDE window starts of a long piece
        blocks = np.where(sizes > long, -(-(sizes - reach + 1) // STRIDE), 1)
        piece = np.repeat(np.arange(len(sizes)), blocks)
        number = np.arange(len(piece)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        size = np.minimum(sizes[piece] - number * STRIDE, long)
        starts = np.where(number + 1 < blocks[piece], STRIDE, size)
        if len(piece) > len(sizes):
            begin = (np.cumsum(sizes) - sizes)[piece] + number * STRIDE
            code = code[np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]
        out = np.zeros((2, len(words), self.kernel.n), np.float32)
        ends, at = np.cumsum(size), 0
        while at < len(size):  # bounds the arrays of subsequences
            before = int(ends[at - 1]) if at else 0
            to = max(int(np.searchsorted(ends, before + LETTERS_AT_ONCE)), at + 1)
            found, values = self.kernel.best(code[before:int(ends[to - 1])], size[at:to], starts[at:to])
            of = piece[at + found]
            np.add.at(out, (kind[of], owner[of]), raised(values))
            at = to
        out = out.max(axis=0)
        some = np.flatnonzero(out.any(axis=1))
        rows = np.zeros(len(words), np.int64)
        rows[some] = 1 + np.arange(len(some))
        return rows, out[some]

    def _rows(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        rows = self.rows
        known = np.fromiter((rows.get(w, -1) for w in words), np.int64, len(words))
        missing = np.flatnonzero(known < 0)
        if not len(missing):
            return known, self.values
        fresh = [words[i] for i in missing]
        tables, held = [self.values], len(self.values)
        for at in range(0, len(fresh), WORDS_AT_ONCE):
            row, values = self._evaluate(fresh[at:at + WORDS_AT_ONCE])
            known[missing[at:at + WORDS_AT_ONCE]] = np.where(row > 0, row + held - 1, 0)
            tables.append(values)
            held += len(values)
        table = np.concatenate(tables)
        keep = max(min(len(fresh), CACHED_WORDS - len(rows)), 0)
        if keep:
            kept = known[missing[:keep]]
            rows.update(zip(fresh, kept.tolist()))
            self.values = table[:max(len(self.values), int(kept.max()) + 1)].copy()
        return known, table

    def __call__(self, texts: pa.Array) -> np.ndarray:
        texts = pc.fill_null(texts, "")
        out = np.zeros((len(texts), self.kernel.n), np.float64)
        lists = pc.utf8_split_whitespace(texts)
        offsets = lists.offsets.to_numpy().astype(np.int64)
        offsets = offsets - offsets[0]
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        code = coded.indices.to_numpy(zero_copy_only=False)
        rows, table = self._rows(words)
        row = rows[code]
        doc = np.repeat(np.arange(len(texts)), np.diff(offsets))
        hits = np.flatnonzero(row)
        for at in range(0, len(hits), WORDS_AT_ONCE):
            some = hits[at:at + WORDS_AT_ONCE]
            first = np.flatnonzero(np.concatenate([[True], np.diff(doc[some]) != 0]))
            out[doc[some[first]]] += np.add.reduceat(table[row[some]], first, axis=0, dtype=np.float64)
        # letters with spaces between them
        alone = np.fromiter((len(w) == 1 and w.isalpha() for w in words), bool, len(words))[code]
        if alone.any():
            step = np.flatnonzero(np.diff(np.concatenate([[0], alone.astype(np.int8), [0]])) | np.concatenate(
                [[0], (np.diff(doc) != 0) & alone[1:] & alone[:-1], [0]]))
            runs = [(a, b) for a, b in zip(step.tolist(), step[1:].tolist()) if b - a >= 3 and alone[a]]
            if runs:
                spelt = ["".join(words[c] for c in code[a:b].tolist()) for a, b in runs]
                row, values = self._evaluate(spelt)
                for (a, _), r in zip(runs, row.tolist()):
                    if r:
                        out[doc[a]] += values[r - 1]
        return np.hstack([np.log1p(out), out / np.sqrt(np.maximum(np.diff(offsets), 1))[:, None]]).astype(np.float32)


@worker_state("toxicity")
def pooled(landmarks: tuple[str, ...]) -> Pooled:
    return Pooled(list(landmarks))


@dataclass(frozen=True)
class Model:
    landmarks: tuple[str, ...]
    weights: tuple[float, ...]  # of the pooled features, Nyström map included
    slope: float
    shift: float

    def scores(self, features: np.ndarray) -> np.ndarray:
        margin = features @ np.array(self.weights) if len(self.weights) else np.zeros(len(features))
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _training(docs: DataFrame, labels: DataFrame, train_rows: int) -> DataFrame:
    known = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows))
    return written(docs.select("doc_id", "text").join(F.broadcast(known), "doc_id"), "toxicity-training")  # train_rows at most


def _landmarks(training: DataFrame, most: int) -> list[str]:
    """Words by how much more often toxic texts hold them than others."""
    word = F.array_distinct(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}]+"))
    sums = training.agg(F.sum("toxic"), F.count("*")).first()
    toxic, total = sums[0] or 0, sums[1]
    if not 0 < toxic < total:
        return []
    t, n = F.col("t"), F.col("n")
    share = n / total
    counted = (training.select("toxic", F.explode_outer(word).alias("word")).where(F.length("word") >= 4)
               .groupBy("word").agg(F.sum("toxic").alias("t"), F.count("*").alias("n")).where(t >= 2))
    score = (t / toxic - (n - t) / (total - toxic)) / F.sqrt(share * (1 - share) * (1 / toxic + 1 / (total - toxic)) + 1e-9)
    rows = counted.select("word", score.alias("s")).where("s > 4").orderBy(F.desc("s"), "word").limit(CANDIDATES).collect()
    words = [r["word"] for r in rows]
    chosen: list[str] = []
    if words:
        word_, sub, weight = subsequences(*letters(words))
        dense = np.zeros((len(words), 1 << 15), np.float32)
        np.add.at(dense, (word_, sub), weight)
        size = np.linalg.norm(dense, axis=1)
        held: list[int] = []
        for i in range(len(words)):
            if len(held) == most:
                break
            if size[i] and all(dense[i] @ dense[j] < 0.75 * size[i] * size[j] for j in held):
                held.append(i)
        chosen = [words[i] for i in held]
    return chosen


def _svm(x: np.ndarray, y: np.ndarray, count: np.ndarray, cost: float = 10.0, rounds: int = 50) -> np.ndarray:
    """Linear SVM (squared hinge loss, classes weighted equally, bias as last
    weight) by Newton's method; row i stands for count[i] equal texts."""
    x = np.hstack([x, np.ones((len(x), 1))])
    sign = np.where(y > 0, 1.0, -1.0)
    total, toxic = count.sum(), (count * y).sum()
    most = cost * count * np.where(y > 0, total / (2 * toxic), total / (2 * (total - toxic)))
    ridge = np.ones(x.shape[1])
    ridge[-1] = 1e-6

    def loss(w: np.ndarray) -> float:
        return (ridge * w) @ w / 2 + most @ np.maximum(0, 1 - sign * (x @ w)) ** 2

    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        short = 1 - sign * (x @ w)
        on = short > 0
        slope = ridge * w - 2 * x[on].T @ (most * sign * short)[on]
        step = np.linalg.solve(np.diag(ridge) + 2 * x[on].T @ (x[on] * most[on, None]), -slope)
        now = loss(w)
        while loss(w + step) > now and np.abs(step).max() > 1e-9:
            step /= 2
        w = w + step
        if np.abs(step).max() < 1e-7:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, landmarks: int = LANDMARKS) -> Model:
    training = _training(docs, labels, train_rows)
    words = _landmarks(training, landmarks)
    if not words:
        return Model((), (), 0.0, -30.0)
    # texts with the same features are alike: one row per distinct features and class
    rows = (features(training, tuple(words), "toxic").groupBy("features", "toxic").agg(F.count("*").alias("n")).collect())
    x = np.array([np.frombuffer(r["features"], np.float32) for r in rows], np.float64)
    y, count = np.array([r["toxic"] for r in rows], float), np.array([r["n"] for r in rows], float)
    if not 0 < y.sum() < len(y):
        return Model((), (), 0.0, -30.0)
    word, sub, weight = subsequences(*letters(words))
    dense = np.zeros((len(words), 1 << 15))
    np.add.at(dense, (word, sub), weight)
    dense /= np.linalg.norm(dense, axis=1)[:, None]
    value, vector = np.linalg.eigh(dense @ dense.T)
    root = vector @ np.diag(1 / np.sqrt(np.maximum(value, 1e-3))) @ vector.T
    root = np.kron(np.eye(2), root)  # raw and normalised sums
    w = _svm(x @ root, y, count)
    margin = x @ root @ w[:-1] + w[-1]
    slope, shift = 1.0, 0.0
    for _ in range(500):  # Platt's scaling, classes weighted as they are
        p = 1 / (1 + np.exp(-np.clip(slope * margin + shift, -30, 30)))
        slope, shift = slope - 0.5 * np.average((p - y) * margin, weights=count), shift - 0.5 * np.average(p - y, weights=count)
    return Model(tuple(words), tuple((root @ w[:-1]).tolist()), float(max(slope, 1e-3)), float(slope * w[-1] + shift))


def features(df: DataFrame, landmarks: tuple[str, ...], *keep: str) -> DataFrame:
    """keep columns and the pooled features as binary (32-bit floats)."""
    columns = df.select(*keep, "text")
    held = columns.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool = pooled(landmarks)
        for batch in batches:
            for part in slices(batch, size=SLICE_BYTES):
                x = pool(part.column(len(keep)))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array([r.tobytes() for r in x], pa.binary())], names=[*keep, "features"])

    return with_package(columns).mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in held[:-1]), "features binary"]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool = pooled(model.landmarks)
        for batch in batches:
            for part in slices(batch, size=SLICE_BYTES):
                s = model.scores(pool(part.column(1))) if model.landmarks else np.zeros(len(part))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(s)], names=["doc_id", "score"])

    rows = with_package(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                       (F.col("score") >= 0.5).cast("int").alias("predicted"))


def reject(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns."""
    if not model.landmarks:
        return docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool = pooled(model.landmarks)
        for batch in batches:
            for part in slices(batch, size=SLICE_BYTES):
                text = part.column(part.schema.get_field_index("text"))
                yield part.filter(pa.array(model.scores(pool(text)) < 0.5))

    return with_package(docs).mapInArrow(run, docs.schema)
