import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from depotlens.llm import bpe, pfor
from depotlens.llm.tokens import PieceEncoder, library_encoder, parts_of

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def split(ids, sizes):
    return [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]


def noise(n, seed=1):
    rnd = random.Random(seed)
    return ["".join(rnd.choice("ab e  \n\t'.,1é ßЖ日🙂AZ_-s\x85\x1c") for _ in range(rnd.randrange(0, 40))) for _ in range(n)]


def test_replay_equals_reference_library(spark, odd, documents, reference):
    for df in (odd, documents(noise(500))):
        got = bpe.decode_ids(bpe.encode_documents(df, RANKS, public_tokenizers.PATTERN), RANKS).collect()
        want = sorted((str(r["doc_id"]), tuple(reference.encode_ordinary(r["text"] or "")), (r["text"] or "").encode()) for r in df.collect())
        assert sorted((str(r["doc_id"]), tuple(np.frombuffer(r["ids"], "<u4").tolist()), bytes(r["decoded"])) for r in got) == want
    assert bpe.encode_documents(documents([]), RANKS, public_tokenizers.PATTERN).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=30), min_size=1, max_size=8))
def test_replay_of_any_text(texts):
    merges = bpe.replay(RANKS)
    single = [merges.encode([t.encode()])[0].tolist() for t in texts]
    assert split(*merges.encode([t.encode() for t in texts])) == single
    assert [merges.decode(np.array(s)) for s in single] == [t.encode() for t in texts]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_equal_whole_texts(name):
    import pyarrow as pa

    texts = [*noise(800, 2), "plain words only here", "", "<|endoftext|> x<|endoftext|>y <|startoftext|>", "ŉ İ ǆ ﬁ", "a" * 3000]
    t = Tokenizer.from_file(public_tokenizers.path(name))
    want = [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]
    encoder = library_encoder(public_tokenizers.path(name))
    small = PieceEncoder(encoder.encode, encoder.whole, cached=5)  # a full cache changes nothing
    for e in (encoder, encoder, small, small):
        assert split(*e.texts(pa.array(texts))) == want


def test_parts_join_to_the_piece():
    import pyarrow as pa

    pieces = ["end.", "end.\nNext", "end\nNext,", "it's", "'s", ".\nNext", "a.\n\nB", "é.", "aé", "x<|endoftext|>y", "", "a.\nÉ", "\n", "a1.\nb2\nc"]
    parts = [p.to_pylist() for p in parts_of(pa.array(["skipped", *pieces])[1:])]
    assert ["".join(p) for p in zip(*parts)] == pieces
    assert [p for p in zip(*parts)][:4] == [("end", ".", ""), ("end", ".\n", "Next"), ("end", "\n", "Next,"), ("it", "'s", "")]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_words_are_encoded_once_whatever_follows_them(name):
    import pyarrow as pa

    words, tails = ["alpha", "betas", "Gamma", "dañt", "it"], [".", ",", "!!", "'s", "***", ".\nAnd", "\nAnd", ".\n\nAnd", "9", "-x"]
    texts = [" ".join(w + t for w in words for t in tails), "It's. It's It's.\nIt's"]
    library_encoder.cache_clear()
    encoder = library_encoder(public_tokenizers.path(name))
    t = Tokenizer.from_file(public_tokenizers.path(name))
    assert split(*encoder.texts(pa.array(texts))) == [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]
    assert len(encoder.sizes) <= len(words) + len(tails) + 12  # 50 pieces and more otherwise


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=900), st.integers(1, 100))
def test_packed_blocks_round_trip(ids, percentile):
    a = np.array(ids, np.uint32)
    assert pfor.unpack(pfor.pack(a, max(1, percentile))).tolist() == ids


def test_outliers_go_to_exception_lists():
    a = np.arange(256, dtype=np.uint32) % 16
    a[7] = 2**31
    assert len(pfor.pack(a)) < 12 + 11 + 128 + 5 + 1
    with pytest.raises(ValueError):
        pfor.unpack(b"none" + bytes(20))


def test_files_hold_all_ids_in_order(spark, odd, documents, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    for k, df in enumerate((odd, documents([f"text number {i} " * (i % 50) for i in range(300)], list(range(300, 0, -1))))):
        where = str(tmp_path / f"f{k}")
        pfor.write_files(df, where, path)
        got = pfor.read_files(spark, where).collect()
        docs = sorted(df.collect(), key=lambda r: (-1 if r["doc_id"] is None else r["doc_id"], r["text"] or ""))
        want, start = [], 0
        for r in docs:
            ids = [*t.encode(r["text"] or "", add_special_tokens=False).ids, 0]
            raw = np.array(ids, "<u4").tobytes()
            want.append((r["doc_id"], start, len(ids), zlib.crc32(raw), raw))
            start += len(ids)
        assert sorted(((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"], bytes(r["ids"])) for r in got), key=lambda x: x[1]) == want
    pfor.write_files(documents([]), str(tmp_path / "none"), path)
    assert pfor.read_files(spark, str(tmp_path / "none")).count() == 0


def test_sha_of_no_ids():
    assert hashlib.sha256(np.array([], "<u4").tobytes()).hexdigest() == hashlib.sha256(b"").hexdigest()
