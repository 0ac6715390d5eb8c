"""Fill-in-middle, the n-gram join and hard negatives, against brute force."""

import random
import re

import numpy as np
import pytest

from depotlens.llm import fim, hard_negatives, ngram_join

MARKS = ("<P>", "<S>", "<M>")


# ------------------------------------------------------------ fill in the middle
def brute_fim(doc_id, text):
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    a, b, h3, h4 = fim.choices(doc_id, len(units))
    if not text or h3 >= 90 or any(m in text for m in MARKS):
        return len(units), "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def fim_texts():
    r = random.Random(4)
    passages = ["".join(r.choice("abcdeé 日.\n<PSM>\U0001F600") for _ in range(3000)) for _ in range(3)] + ["x" * 9000, "é" * 5000]
    texts = ["", "a", "é", " ", "<P>", "a<", "<S", "abc", "A1b", "word " * 9000]
    for _ in range(300):
        parts = [r.choice(passages)[:r.randint(0, 9000)] if r.random() < 0.4 else
                 "".join(r.choice("ab é\U0001F600Z9") for _ in range(r.randint(0, 60))) for _ in range(r.randint(0, 4))]
        texts.append("".join(parts))
    return texts


def test_fim_follows_brute_force_with_a_small_and_a_full_cache():
    texts = fim_texts()
    for cache in (fim.ChunkCache(most=20_000), fim.ChunkCache()):
        for at in range(0, len(texts), 50):
            part = texts[at:at + 50]
            got = list(fim.transform_texts(list(range(at, at + len(part))), [t.encode() for t in part], cache))
            for i, (row, text) in enumerate(zip(got, part)):
                assert row == brute_fim(at + i, text)
                assert fim.restore(row[4], row[1]) == text
    assert cache.hits > 500  # shared passages are counted once


def test_chunks_of_a_shared_passage_are_the_same_wherever_it_stands():
    r = random.Random(1)
    passage = "".join(r.choice("abcdefgh ") for _ in range(6000))
    held = []
    for head in ("", "x" * 777, "öä " * 100):
        b = np.frombuffer((head + passage).encode(), np.uint8)
        cuts = fim.cut_points(b, np.array([len(b)]))
        data = b.tobytes()
        held.append({data[i:j] for i, j in zip([0, *cuts[:-1].tolist()], cuts.tolist())})
    assert len(held[0] & held[1] & held[2]) >= len(held[0]) - 2


def test_no_chunk_ends_inside_a_code_point_or_grows_past_the_bound():
    for text in ("é" * 20_000, "日" * 9000, "a" * 30_000, "\U0001F600" * 5000):
        b = np.frombuffer(text.encode(), np.uint8)
        cuts = fim.cut_points(b, np.array([len(b)]))
        assert cuts[-1] == len(b) and np.diff([0, *cuts]).max() <= fim.MOST + 3
        for c in cuts[:-1]:
            assert (b[c] & 0xC0) != 0x80


def test_fim_query_rows(spark):
    rows = [(i, t, i) for i, t in enumerate(fim_texts()[:60])] + [(None, "null id here", 0), (7, None, 1), (3, "twice", 2), (3, "twice", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long")  # an extra column named as a result's
    got = sorted(map(tuple, fim.transform(docs).collect()), key=str)
    expected = []
    for doc_id, text, _ in rows:
        n, form, p, m, out = brute_fim(doc_id, text or "")
        expected.append((doc_id, n, form, p, m, out, text or ""))
    assert got == sorted(expected, key=str)
    assert fim.transform(docs.limit(0)).count() == 0


# ------------------------------------------------------------------- n-gram join
def shingle_set(text, words):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) if x]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1)))


def brute_join(rows, words, percent):
    sets = [(d, shingle_set(t, words)) for d, t in rows]
    nodes = sorted({s for d, s in sets if s and d is not None}, key=sorted)
    parent = list(range(len(nodes)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i, a in enumerate(nodes):
        for j in range(i):
            shared = len(a & nodes[j])
            if 100 * shared >= percent * (len(a) + len(nodes[j]) - shared):
                parent[find(i)] = find(j)
    at, least = {s: i for i, s in enumerate(nodes)}, {}
    for d, s in sets:
        if s and d is not None:
            least[find(at[s])] = min(least.get(find(at[s]), d), d)
    return sorted(((d, len(s), least[find(at[s])] if s and d is not None else d) for d, s in sets), key=str)


def joined(docs, words, percent):
    return sorted(map(tuple, ngram_join.join(docs, words, percent).collect()), key=str)


def near_copies(seed, bases, copies):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for _ in range(bases):
        base = [r.choice(vocabulary) for _ in range(r.choice([12, 40, 60, 150]))]
        for _ in range(copies):
            words = list(base)
            for _ in range(r.choice([0, 1, 1, 2, 2, 3, 4])):
                words[r.randrange(len(words))] = r.choice(vocabulary) if r.random() < 0.7 else f"e{r.randrange(10**6)}"
            rows.append((len(rows), " ".join(words)))
    return rows


@pytest.mark.parametrize("words, percent", [(3, 90), (5, 80)])
def test_join_follows_brute_force(spark, words, percent):
    rows = near_copies(words, 5, 60)
    rows += [(900, None), (901, ""), (902, " \t\n"), (None, rows[0][1]), (3, rows[3][1]), (3, "another text of the same id here"),
             (903, "One two"), (904, "one  TWO"), (905, "Ä b c d"), (906, "ä b c d"), (907, "z" * 100_000 + " a b c " * 3000)]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, node long")
    assert joined(docs, words, percent) == brute_join(rows, words, percent)


def test_difference_search_finds_links_past_the_hub(spark):
    """A chain: every text is near its neighbours only, all share the tokens of
    one passage, so no hub connects them all."""
    base = [f"p{i}" for i in range(120)]
    rows = []
    for k in range(30):
        words = list(base)
        for i in range(k):
            words[4 * i] = f"x{i}"  # one more word differs with every step
        rows.append((100 - k, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = joined(docs, 3, 90)
    assert got == brute_join(rows, 3, 90)
    assert len({c for _, _, c in got}) == 1


def test_join_of_an_empty_table(spark):
    assert joined(spark.createDataFrame([], "doc_id long, text string"), 3, 90) == []


def test_prefix_length_is_the_shortest_exact_one():
    for n in range(1, 60):
        for percent in (70, 80, 90, 100):
            least = -(-percent * n // 100)  # tokens that a partner must share
            assert ngram_join.prefix_length(np.array([n]), percent)[0] == n - least + 1


def test_very_frequent_tokens_leave_a_bucket_early(monkeypatch):
    monkeypatch.setattr(ngram_join, "HELD_KEYS", 500)
    monkeypatch.setattr(ngram_join, "FREQUENT", 50)
    bucket = ngram_join.Bucket(0, 4)
    out, r = [], random.Random(2)
    truth = {}
    for part in range(40):
        nodes = np.arange(part * 20, part * 20 + 20, dtype=np.int64)
        keys = [sorted({7, 8, *(r.randrange(100, 2000) for _ in range(5))}) for _ in nodes]
        for n, ks in zip(nodes.tolist(), keys):
            for k in ks:
                truth.setdefault(k, set()).add(n)
        out += bucket.add(nodes.tobytes(), np.array([len(k) for k in keys], "<i4").tobytes(), np.array(sum(keys, []), "<i8").tobytes())
    out += bucket.give()
    got = {}
    for batch in out:
        for nodes, counts, keys, freqs in zip(*(batch.column(c).to_pylist() for c in (5, 6, 7, 8))):
            owner = np.repeat(np.frombuffer(nodes, "<i8"), np.frombuffer(counts, "<i4"))
            for n, k, f in zip(owner.tolist(), np.frombuffer(keys, "<i8").tolist(), np.frombuffer(freqs, "<u2").tolist()):
                got.setdefault(k, (f, set()))[1].add(n)
                assert got[k][0] == f
    assert {k: v[1] for k, v in got.items()} == {k: v for k, v in truth.items() if len(v) > 1}
    assert all(f == min(len(truth[k]), 50) for k, (f, _) in got.items())


# ---------------------------------------------------------------- hard negatives
def brute_negatives(rows, every=10, positives=5, negatives=3, low=50, high=95):
    held = set()
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        held.add((vec_id, label, tuple(int(np.floor(256 * float(np.float32(x)))) for x in vector)))
    out = []
    for a in held:
        if a[0] % every:
            continue
        scored = [(-sum(x * y for x, y in zip(a[2], b[2])), b[0], b[1]) for b in held if len(b[2]) == len(a[2])]
        same = sorted((s, i) for s, i, k in scored if k == a[1] and i != a[0])[:positives]
        for s, i in same:
            fits = sorted((t, j) for t, j, k in scored if k != a[1] and low * -s <= 100 * -t <= high * -s)[:negatives]
            out += [(a[0], i, rank + 1, j, -s, -t) for rank, (t, j) in enumerate(fits)]
    return sorted(out)


def mined(spark, rows, **options):
    df = spark.createDataFrame([(i, v, k, 0) for i, v, k in rows], "vec_id long, embedding array<float>, label int, q int")
    return sorted(tuple(r) for r in hard_negatives.mine(df, df["vec_id"] % 10 == 0, **options).collect())


def clustered(n=600, dims=8, labels=4, seed=0):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(12, dims))
    x = centres[r.integers(0, 12, n)] + 0.05 * r.normal(size=(n, dims))
    x /= np.linalg.norm(x, axis=1)[:, None]
    return [(i, [float(v) for v in row], int(k)) for i, (row, k) in enumerate(zip(x, r.integers(0, labels, n)))]


def test_negatives_follow_brute_force(spark):
    rows = clustered()
    x = rows[0][1]
    rows += [rows[5], rows[10], (10, x, 1), (601, x, 0), (602, x, 1), (None, x, 1), (603, None, 1), (604, x, None), (605, [None, *x[1:]], 1),
             (606, [float("nan"), *x[1:]], 1), (607, [float("inf"), *x[1:]], 1), (610, [], 1), (611, [], 1), (612, [], 2),
             (620, [0.5, 0.5], 1), (621, [0.5, 0.4], 1), (622, [0.5, 0.1], 2), (630, [1e30, *x[1:]], 1)]
    expected = brute_negatives([r for r in rows if r[0] != 630])  # too large for a long: takes no part
    assert mined(spark, rows, block_rows=40, chunk_anchors=16) == expected
    assert mined(spark, rows) == expected
    assert len(expected) > 500


def test_negatives_with_ties_and_large_values(spark):
    r = random.Random(3)
    rows = [(i, [float(r.choice([-2, -1, 0, 1, 2])) * r.choice([1, 500_000]) for _ in range(4)], r.randrange(3)) for i in range(200)]
    assert mined(spark, rows, block_rows=16, chunk_anchors=4) == brute_negatives(rows)


def test_zone_maps_leave_out_most_blocks_of_clustered_vectors(spark):
    from pyspark.sql import functions as F

    rows = clustered(n=4000, dims=6, labels=1)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    held = hard_negatives.prepare(df, F.col("vec_id") % 200 == 0)
    ordered = hard_negatives.ordered(held, hard_negatives.spread(held))
    blocks = hard_negatives.cut_blocks(ordered, 50).cache()
    chunks = hard_negatives.cut_chunks(blocks, 5, 1).cache()  # one anchor per chunk
    chosen = hard_negatives.choose(chunks, blocks, 2).count()
    every = chunks.count() * blocks.count()
    assert 0 < chosen < 0.35 * every


def test_bounds_hold_every_score():
    r = np.random.default_rng(5)
    q, rows = r.integers(-300, 300, (20, 16)), r.integers(-300, 300, (400, 16))
    low, high = rows.reshape(20, 20, 16).min(1), rows.reshape(20, 20, 16).max(1)
    least, most = hard_negatives.bounds(q, low, high)
    s = hard_negatives.scores(q, rows).reshape(20, 20, 20)
    assert (least <= s.min(2)).all() and (most >= s.max(2)).all()


def test_hilbert_index_walks_a_grid_in_unit_steps():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    key = hard_negatives.hilbert_index(grid, 3)
    assert sorted(key.tolist()) == list(range(512))
    assert (np.abs(np.diff(grid[np.argsort(key)], axis=0)).sum(1) == 1).all()


def test_no_vectors_give_no_negatives(spark):
    assert mined(spark, []) == []
