"""Whole texts to token ids, one encoding per distinct piece.

A text is cut at single spaces that stand between other characters; for the
tokenizers used here such a cut never changes the ids (a space between words
starts the next piece, or is dropped). Each task encodes the distinct pieces
of a slice of its texts and gathers the ids of all texts with array
operations. Texts with runs of white space that hold a space are encoded
whole. The cache of pieces is bounded and only saves time.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from depotlens.llm.common import worker_state

SLICE_BYTES = 8 << 20
CACHED_PIECES = 400_000
# fixed values: the white space of Unicode, as a class of the matcher
_WHITE = r"[\t\n\v\f\r \x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_IRREGULAR = f"{_WHITE} | {_WHITE}"

Encoded = tuple[np.ndarray, np.ndarray]  # all ids, ids per entry


def _strings(array: pa.Array) -> list[str]:
    return array.to_numpy(zero_copy_only=False).tolist()


def _cut(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> pa.Array:
    """The strings of the bytes at ``begin``."""
    ends = np.cumsum(size)
    at = np.repeat((begin - (ends - size)).astype(np.int32), size) + np.arange(int(size.sum()), dtype=np.int32)
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(data[at])])


# kinds of ASCII bytes
_LETTER, _OTHER, _SHOWN = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_SHOWN[33:127] = True
_OTHER[[10, *range(33, 127)]] = True
_OTHER &= ~_LETTER


def parts_of(pieces: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """(heads, middles, lasts) of pieces without spaces: a piece is its
    head, middle and last in a row, middle and last are empty where it is not cut.

    A piece is cut before its first ASCII character that is no letter, if an ASCII
    letter stands before it, and then after its first line feed, if that stands
    between a visible ASCII character and an ASCII letter. The tokenizers used
    here always end a word at both places. No special token is cut that begins with
    such a character and holds no line feed."""
    pieces = pieces.cast(pa.string())
    offsets = np.frombuffer(pieces.buffers()[1], np.int32, len(pieces) + 1, 4 * pieces.offset).astype(np.int64)
    begin, end = offsets[:-1], offsets[1:]
    data = np.frombuffer(pieces.buffers()[2] or b"", np.uint8, int(offsets[-1]))

    def first(places: np.ndarray) -> np.ndarray:
        """The first of the places in each piece, or its end."""
        at = np.searchsorted(places, begin)
        return np.minimum(np.append(places, offsets[-1])[at], end)

    one, line = first(np.flatnonzero(_OTHER[data])), first(np.flatnonzero(data == 10))
    padded = np.append(data, 0)  # what a place past the end reads
    held = (one > begin) & (one < end) & _LETTER[padded[one - 1]]
    one = np.where(held, one, end)
    held &= (line < end) & _SHOWN[padded[line - 1]] & (line + 1 < end) & _LETTER[padded[np.minimum(line + 1, len(data))]]
    two = np.where(held, line + 1, end)
    return _cut(data, begin, one - begin), _cut(data, one, two - one), _cut(data, two, end - two)


class PieceEncoder:
    """encode: list of strings to (ids, ids per string). ``parts``: whether pieces
    are encoded in their parts (``parts_of``), which are far fewer."""

    def __init__(self, encode: Callable[[list[str]], Encoded], whole: Callable[[list[str]], Encoded] | None = None,
                 cached: int = CACHED_PIECES, parts: bool = False):
        self.encode, self.whole, self.cached, self.parts = encode, whole or encode, cached, parts
        self.spaced: dict[str, int] = {}  # rows of what follows a space
        self.rows: dict[str, int] = {}  # and of all else
        self.ids, self.sizes = np.empty(0, np.uint32), np.empty(0, np.int64)

    def _table(self, spaced: list[str], plain: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of the pieces after a space and of the others, and the ids and
        sizes that the rows index."""
        known = np.fromiter(chain(map(self.spaced.get, spaced, repeat(-1)), map(self.rows.get, plain, repeat(-1))),
                            np.int64, len(spaced) + len(plain))
        missing = np.flatnonzero(known < 0)
        if not len(missing):
            return known, self.ids, self.sizes
        after = int(np.searchsorted(missing, len(spaced)))
        keys = [spaced[i] for i in missing[:after].tolist()], [plain[i - len(spaced)] for i in missing[after:].tolist()]
        ids, sizes = self.encode([" " + p for p in keys[0]] + keys[1])
        known[missing] = len(self.sizes) + np.arange(len(missing))
        all_ids, all_sizes = np.concatenate([self.ids, ids]), np.concatenate([self.sizes, sizes])
        keep = min(len(missing), self.cached - len(self.sizes))
        if keep > 0:
            rows = known[missing[:keep]].tolist()
            self.spaced.update(zip(keys[0], rows))
            self.rows.update(zip(keys[1], rows[after:]))
            self.sizes = np.concatenate([self.sizes, sizes[:keep]])
            self.ids = np.concatenate([self.ids, ids[:int(sizes[:keep].sum())]])
        return known, all_ids, all_sizes

    def _pieces(self, dictionary: pa.Array, plain: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Rows of the dictionary's pieces (after a space), rows of the plain
        ones, and the ids and sizes that the rows index."""
        if not self.parts:
            rows, ids, sizes = self._table(_strings(dictionary), plain)
            return rows[:len(dictionary)], rows[len(dictionary):], ids, sizes
        heads, *others = (p.dictionary_encode() for p in parts_of(dictionary))
        lists = [_strings(p.dictionary) for p in others]
        distinct = list(dict.fromkeys(chain(*lists, plain)))
        spaced = _strings(heads.dictionary)
        rows, ids, sizes = self._table(spaced, distinct)
        place = dict(zip(distinct, rows[len(spaced):].tolist()))
        columns = [rows[heads.indices.to_numpy()]]
        for coded, values in zip(others, lists):
            columns.append(np.array([place[v] for v in values], np.int64)[coded.indices.to_numpy()])
        part = np.stack(columns, axis=1)
        own = np.array([place[p] for p in plain], np.int64)
        # the ids of all parts piece by piece, then those of the plain ones
        table = _gather(ids, sizes, np.concatenate([part.ravel(), own]))
        sizes = np.concatenate([sizes[part].sum(axis=1), sizes[own]])
        row = np.arange(len(sizes))
        return row[:len(part)], row[len(part):], table, sizes

    def texts(self, texts: pa.Array) -> Encoded:
        """Ids of all texts (null: empty), and the number per text."""
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, _IRREGULAR).to_numpy(zero_copy_only=False)
        if not odd.any():
            return self._regular(texts)
        plain = self._regular(texts.filter(pa.array(~odd))) if not odd.all() else (np.empty(0, np.uint32), np.empty(0, np.int64))
        other = self.whole(texts.filter(pa.array(odd)).to_pylist())
        sizes = np.empty(len(texts), np.int64)
        sizes[~odd], sizes[odd] = plain[1], other[1]
        ids = np.empty(int(sizes.sum()), np.uint32)
        taken = np.repeat(odd, sizes)
        ids[taken], ids[~taken] = other[0], plain[0]
        return ids, sizes

    def _regular(self, texts: pa.Array) -> Encoded:
        if not len(texts):
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        lists = pc.split_pattern(texts, " ")
        offsets = lists.offsets.to_numpy().astype(np.int64)
        offsets = offsets - offsets[0]
        values = lists.flatten()
        coded = values.dictionary_encode()
        first = offsets[:-1]
        heads = values.take(pa.array(first)).to_pylist()
        unique_heads = list(dict.fromkeys(heads))
        rows, plain, ids, sizes = self._pieces(coded.dictionary, unique_heads)
        place = dict(zip(unique_heads, plain.tolist()))
        row = rows[coded.indices.to_numpy()]
        row[first] = [place[h] for h in heads]
        return _gather(ids, sizes, row), np.add.reduceat(sizes[row], first)


def _gather(ids: np.ndarray, sizes: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The ids of the rows, one after the other."""
    size = sizes[row]
    begin = np.cumsum(sizes) - sizes
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    # a slice holds far fewer ids than 32 bits count: half the memory to move
    kind = np.int32 if max(total, len(ids)) < 1 << 31 else np.int64
    at = np.arange(total, dtype=kind)
    at += np.repeat((begin[row] - (ends - size)).astype(kind), size)
    return ids.take(at)


def slices(batch: pa.RecordBatch, text: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``size`` bytes of text (a longer text alone)."""
    column = batch.column(batch.schema.get_field_index(text))
    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    number = np.cumsum(lengths) // size
    cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(batch)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def with_end(ids: np.ndarray, sizes: np.ndarray, end: int) -> Encoded:
    """The ids with ``end`` after each text's."""
    return np.insert(ids, np.cumsum(sizes), end).astype(np.uint32), sizes + 1


def binary_ids(ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Ids per text as little-endian unsigned 32-bit integers."""
    offsets = np.concatenate([[0], np.cumsum(sizes) * 4]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [
        None, pa.py_buffer(offsets), pa.py_buffer(ids.astype("<u4").tobytes())]).cast(pa.binary())


def _lists(encodings) -> Encoded:
    lists = [e.ids for e in encodings]
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.uint32, int(sizes.sum())), sizes


JOINED = 400


@worker_state("tokens")
def library_encoder(path: str) -> PieceEncoder:
    """Pieces encoded by the tokenizers library, from its file at ``path``.

    Many pieces go to the library as one text, where the ids show the borders:
    in a vocabulary with a mark for the leading space, every piece that follows a
    space has one mark, and the others stand between single line feeds; in a
    vocabulary with a mark for the word end, every piece of letters only has
    one. All others are encoded singly."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    names = t.get_vocab()
    special = [str(a.content) for a in t.get_added_tokens_decoder().values()]
    ends = sum(n.endswith("</w>") for n in names) > len(names) // 10
    mark = np.zeros(max(names.values()) + 1, bool)
    mark[[i for n, i in names.items() if (n.endswith("</w>") if ends else n.startswith("Ġ"))]] = True

    def singly(texts: list[str]) -> Encoded:
        return _lists(t.encode_batch_fast(texts, add_special_tokens=False))

    feed, drops = singly(["\n"])[0], np.array_equal(singly(["a"])[0], singly([" a"])[0])
    # letters of Latin-1 stay single letters under normal forms and lower case
    simple = f"^ {'?' if drops else ''}[A-Za-zÀ-ÖØ-öø-ÿ]+$" if ends else "(?s)^ [^ ]+$"

    def together(pieces: list[str]) -> Encoded:
        """Pieces that show their borders."""
        glue = " " if ends and drops else ""
        texts = [glue + glue.join(pieces[i:i + JOINED]) for i in range(0, len(pieces), JOINED)]
        ids, _ = singly(texts) if texts else (np.empty(0, np.uint32), None)
        borders = np.flatnonzero(mark[ids])
        if len(borders) != len(pieces):  # not as expected: each piece on its own
            return singly(pieces)
        return ids, np.diff(np.concatenate([[-1], borders]) if ends else np.concatenate([borders, [len(ids)]]))

    def between_feeds(pieces: list[str]) -> Encoded:
        """Pieces without white space."""
        texts = ["\n".join(pieces[i:i + JOINED]) + "\n" for i in range(0, len(pieces), JOINED)]
        ids, _ = singly(texts) if texts else (np.empty(0, np.uint32), None)
        border = ids == feed[0]
        if np.count_nonzero(border) != len(pieces):
            return singly(pieces)
        return ids[~border], np.diff(np.concatenate([[-1], np.flatnonzero(border)])) - 1

    def encode(pieces: list[str]) -> Encoded:
        array = pa.array(pieces, pa.string())
        ways = [(pc.match_substring_regex(array, simple), together)]
        if not ends and len(feed) == 1:
            ways.append((pc.match_substring_regex(array, r"^[!-~]+$"), between_feeds))
        left, done = np.ones(len(pieces), bool), []
        for fits, way in ways:
            for s in special:  # their strings in a piece would end it
                fits = pc.and_(fits, pc.invert(pc.match_substring(array, s[:2])))
            fits = fits.to_numpy(zero_copy_only=False) & left
            left &= ~fits
            done.append((fits, way))
        sizes, parts = np.empty(len(pieces), np.int64), []
        for fits, way in [*done, (left, singly)]:
            ids, sizes[fits] = way(_strings(array.filter(pa.array(fits)))) if fits.any() else (np.empty(0, np.uint32), 0)
            parts.append((fits, ids))
        out = np.empty(int(sizes.sum()), np.uint32)
        for fits, ids in parts:
            out[np.repeat(fits, sizes)] = ids
        return out, sizes

    # a special token that begins with a letter or holds a line feed could be cut
    whole = all(s[:1].isascii() and not s[:1].isalpha() and "\n" not in s for s in special)
    return PieceEncoder(encode, singly, parts=whole)
