import hashlib
import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from depotlens.llm import ctph, minhash


def words(rnd, n):
    return " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randrange(2, 8))) for _ in range(n))


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row = row, [i + 1]
        for j, y in enumerate(b):
            row.append(min(last[j + 1] + 1, row[j] + 1, last[j] + (x != y)))
    return row[-1]


def brute_likeness(a, b):
    if a == b:
        return 1.0
    ka, *sa = a.split(":")
    kb, *sb = b.split(":")
    best = 0.0
    for i, x in enumerate(sa):
        for j, y in enumerate(sb):
            if int(ka) + i == int(kb) + j and x and y:
                x2, y2 = (["".join(p) for p in zip(s[::2], s[1::2])] for s in (x, y))
                best = max(best, 1 - distance(x2, y2) / max(len(x2), len(y2)))
    return best


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(max_size=300), min_size=1, max_size=6))
def test_fingerprints_do_not_depend_on_neighbours(texts):
    raw = [t.encode() for t in texts]
    assert ctph.fingerprints(raw) == [ctph.fingerprints([r])[0] for r in raw]


def test_neighbours_equal_brute_force(documents, odd):
    rnd = random.Random(2)
    texts = [words(rnd, rnd.randrange(0, 400)) for _ in range(150)] + ["ab " * 900, "ab " * 900, None, ""]
    ids = rnd.sample(range(-500, 10_000), len(texts))
    for df in (documents(texts, ids), odd):
        docs = sorted(df.collect(), key=lambda r: (-(1 << 64) if r["doc_id"] is None else r["doc_id"]), reverse=True)
        want = []
        for r, follow in zip(docs, docs[1:] + docs[:1]):
            t, n = r["text"] or "", follow["text"] or ""
            edited = t[:len(t) - len(t) // 2] + n[:len(t) // 2]
            f, e, g = ctph.fingerprints([x.encode() for x in (t, edited, n)])
            want.append((str(r["doc_id"]), len(t), hashlib.sha256(edited.encode()).hexdigest(), f, e,
                         round(brute_likeness(f, e), 9), round(brute_likeness(f, g), 9)))
        got = [(str(r[0]), *r[1:5], round(r[5], 9), round(r[6], 9)) for r in ctph.compare_neighbours(df).collect()]
        assert sorted(got) == sorted(want)
    assert ctph.compare_neighbours(documents([])).count() == 0
    single = ctph.compare_neighbours(documents(["only one text"])).collect()
    assert len(single) == 1 and single[0]["near_next"] == 1


def test_halves_are_near_and_others_far():
    rnd = random.Random(8)
    texts = [words(rnd, 300) for _ in range(60)]
    edited = [a[:len(a) - len(a) // 2] + b[:len(a) // 2] for a, b in zip(texts, texts[1:] + texts[:1])]
    own, new = (ctph.fingerprints([t.encode() for t in x]) for x in (texts, edited))
    assert np.quantile(ctph.likeness(own, new), 0.05) > 0.3
    assert ctph.likeness(own, own[1:] + own[:1]).max() < 0.2


def test_fingerprint_documents(odd):
    rows = ctph.fingerprint_documents(odd).collect()
    assert len(rows) == odd.count()
    same = [r["fingerprint"] for r in rows if r["doc_id"] == 900]
    assert len(same) == 2 and len(set(same)) == 1


def shingles(text, k):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute_components(rows, k, percent):
    sets = {i: shingles(t, k) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((root(a), root(b)))
                    parent[y] = x
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def near_copies():
    rnd = random.Random(6)
    texts = []
    for _ in range(12):
        base = words(rnd, rnd.randrange(1, 120)).split()
        for _ in range(rnd.randrange(1, 25)):
            copy = list(base)
            for _ in range(rnd.randrange(0, 4)):
                copy[rnd.randrange(len(copy))] = words(rnd, 1)
            texts.append(" ".join(copy))
            if rnd.random() < 0.3:
                base = copy  # chains of copies
    return [*texts, *texts[:20], "", None, "One TWO", "one two", "one", "É é", "é É", " \n"]


def test_components_equal_brute_force(documents):
    texts = near_copies()
    rnd = random.Random(1)
    ids = rnd.sample(range(10_000), len(texts))
    for k, percent in ((3, 85), (5, 80)):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.link(documents(texts, ids), k, percent).collect()}
        assert got == brute_components(list(zip(ids, texts)), k, percent)


def test_star_steps_find_long_chains(spark):
    n = 60
    chain = spark.range(n - 1).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    other = spark.createDataFrame([(100, 105), (105, 101), (103, 103)], "u long, v long")
    got = {r["node"]: r["component"] for r in minhash.components(chain.unionByName(other)).collect()}
    assert got == {**{i: 0 for i in range(n)}, 100: 100, 101: 100, 105: 100}


def test_band_shape_misses_little():
    for percent in (70, 80, 85, 95):
        bands, rows = minhash.band_shape(percent)
        assert bands * rows <= minhash.HASHES and (1 - (percent / 100) ** rows) ** bands <= 1e-5


def test_odd_rows(odd, documents):
    rows = minhash.link(odd).collect()
    assert len(rows) == odd.count()
    null = next(r for r in rows if r["doc_id"] is None)
    assert (null["component_id"], null["kept"]) == (None, True)
    empty = [r for r in rows if r["n_shingles"] == 0]
    assert all(r["kept"] for r in empty)
    assert minhash.link(documents([])).count() == 0
    kept = minhash.keep_one(odd.withColumn("node", F.lit("own")))
    assert kept.columns == [*odd.columns, "node"]
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted({str(r["doc_id"]) for r in rows if r["kept"]})


def sentence(seed, n=40):
    return words(random.Random(seed), n)


def test_keep_one_loses_no_unlike_text_of_a_repeated_id(documents):
    a, b = sentence(1), sentence(2)
    cases = [
        ([(3, a), (5, a), (5, b)], [(3, a), (5, b)]),  # the copy goes, the unlike text of its id stays
        ([(5, a), (5, b)], [(5, a), (5, b)]),
        ([(5, a), (5, b), (7, a), (9, b)], [(5, a), (5, b)]),  # two groups whose smallest id is the same
        ([(5, a), (5, a), (5, a.upper())], None),  # one group: one row stays
        ([(4, ""), (4, ""), (4, a), (None, a), (None, a)], [(4, ""), (4, a), (None, a), (None, a)]),
    ]
    for rows, expected in cases:
        docs = documents([t for _, t in rows], [i for i, _ in rows])
        got = sorted(((r["doc_id"], r["text"]) for r in minhash.keep_one(docs).collect()), key=str)
        if expected is None:
            assert len(got) == 1 and got[0][0] == 5
        else:
            assert got == sorted(expected, key=str)


def test_kept_row_of_repeated_rows_is_the_smallest(spark):
    docs = spark.createDataFrame([(1, "some text", "b"), (1, "some text", "a"), (2, "other words", "z")], "doc_id long, text string, row string")
    assert sorted(map(tuple, minhash.keep_one(docs).collect())) == [(1, "some text", "a"), (2, "other words", "z")]


def test_pairs_past_the_hub_grow_with_the_group_not_its_square(documents, monkeypatch):
    """Texts that share a passage of half their words: no two are similar."""
    made = []
    verify = minhash.difference_pairs
    monkeypatch.setattr(minhash, "difference_pairs", lambda *a: [made.append(verify(*a).cache()), made[-1]][1])
    passage = sentence(3, 60)
    for n in (100, 200):
        docs = documents([f"{passage} {sentence(1000 + i, 40)}" for i in range(n)])
        assert minhash.link(docs, 3, 85).where("not kept").count() == 0
        assert made[-1].count() <= n
