import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from depotlens.llm import packing, toxicity

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def brute_kernel(s, t):
    def subs(word):
        out = {}
        for i in range(len(word)):
            for j in range(i + 1, len(word)):
                for k in range(j + 1, min(len(word), i + toxicity.SPAN)):
                    key = word[i] + word[j] + word[k]
                    out[key] = out.get(key, 0) + toxicity.DECAY ** (k - i + 1)
        return out

    a, b = subs(s), subs(t)
    dot = lambda x, y: sum(v * y.get(u, 0) for u, v in x.items())
    return dot(a, b) / (dot(a, a) * dot(b, b)) ** 0.5 if a and b else 0.0


def test_kernel_equals_brute_force():
    landmarks = ["idiot", "worthless", "aaaa", "banana"]
    words = ["idiot", "idiots", "idxiot", "iddiiot", "idot", "worth", "a", "", "banan", "nanaba", "aaaaaa", "tree"]
    kernel = toxicity.Kernel(landmarks)
    found, values = kernel(*toxicity.letters(words), floor=0.2)
    for i, w in enumerate(words):
        want = [brute_kernel(w, t) for t in landmarks]
        if max(want) >= 0.2 + 1e-6:
            got = values[list(found).index(i)]
            assert np.allclose(got, [v if v >= 0.2 else 0 for v in want], atol=1e-5), w
        else:
            assert i not in found


@pytest.fixture(scope="module")
def corpus():
    rnd = random.Random(1)
    plain = ["".join(rnd.choice("aeioubcdlmnprst") for _ in range(rnd.randrange(2, 9))) for _ in range(500)]
    insults = ["idiot", "worthless", "scumbag", "moron", "pathetic"]
    texts, toxic = [], []
    for i in range(600):
        w = [rnd.choice(plain) for _ in range(rnd.randrange(5, 80))]
        if i % 6 == 0:
            w[rnd.randrange(len(w))] = rnd.choice(insults) + rnd.choice(["", ".", "!", ","])
        texts.append(" ".join(w))
        toxic.append(int(i % 6 == 0))
    return texts, toxic


def test_toxic_texts_are_told_with_gaps_and_insertions(spark, documents, corpus):
    texts, toxic = corpus
    docs = documents(texts)
    labels = spark.createDataFrame([(i, 1, t) for i, t in enumerate(toxic)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    rows = toxicity.score(docs, model).collect()
    assert {r["doc_id"]: r["held_out"] for r in rows} == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(600)}
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["predicted"] == toxic[r["doc_id"]] for r in held]) > 0.97
    hidden = ["you i.d.i.o.t there", "such an idxiot", "w-o-r-t-h-l-e-s-s thing", "m o r o n you are", "a PATHÉTIC thing", "x" * 40 + "scumbag" + "y" * 40]
    found = toxicity.score(documents([*hidden, "", None, texts[1]]), model).orderBy("doc_id").collect()
    assert [r["predicted"] for r in found] == [1, 1, 1, 1, 1, 0, 0, 0, 0] or [r["predicted"] for r in found] == [1, 1, 1, 1, 1, 1, 0, 0, 0]
    assert all(0 <= r["score"] <= 1 for r in found)
    kept = toxicity.reject(docs.withColumn("score", F.lit("own")), model)
    assert kept.columns == [*docs.columns, "score"] and 480 <= kept.count() <= 520


def test_no_usable_labels(spark, documents, odd):
    docs = documents(["some text"] * 3)
    for rows in ([], [(0, 1, 1), (1, 1, 1)], [(0, 1, None), (None, 1, 1)]):
        labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
        model = toxicity.fit(docs, labels)
        assert [r["predicted"] for r in toxicity.score(docs, model).collect()] == [0, 0, 0]
        assert toxicity.score(odd, model).count() == odd.count()
    assert toxicity.score(documents([]), model).count() == 0


def test_pooled_features_do_not_depend_on_the_slice(corpus):
    texts, _ = corpus
    whole = toxicity.Pooled(["idiot", "moron"])(pa.array(texts))
    parts = [toxicity.Pooled(["idiot", "moron"])(pa.array([t])) for t in texts]
    assert np.allclose(whole, np.concatenate(parts), atol=1e-6)


def test_embedded_and_twice_inserted_insults_are_found(spark, documents, corpus):
    texts, toxic = corpus
    labels = spark.createDataFrame([(i, 1, t) for i, t in enumerate(toxic)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(documents(texts), labels)
    hidden = ["such an idxioxt", "a scuxmbxag here", "youareamoron", "so theidiotsaid it", "the\u2014idiot\u2014said", "a/moron/b",
              "stupidpatheticloser", "x" * 9 + "scumbag" + "y" * 9, "x" * 40 + "scumbag" + "y" * 40, "tree " * 20 + "id-xio-xt"]
    clean = ["tree bird house", "x" * 200, "so thetreesaid it", "a/bird/b"]
    found = toxicity.score(documents([*hidden, *clean]), model).orderBy("doc_id").collect()
    assert [r["predicted"] for r in found] == [1] * len(hidden) + [0] * len(clean)


def test_long_words_are_read_whole():
    pool = toxicity.Pooled(["idiot", "worthless"])
    for at in range(60):  # whatever block the match falls into
        value = pool(pa.array(["q" * at + "idiot" + "q" * (59 - at)]))[0]
        assert 0.95 < np.expm1(value[0]) < 2.01, at  # at a border both blocks see it


def test_features_add_up_over_the_words():
    one, three, long = toxicity.Pooled(["idiot", "moron"])(pa.array(
        ["idiot tree bird house", "idiot idiot tree idiot", "idiot " + "bird " * 99]))
    assert np.allclose(np.expm1([one[0], three[0], long[0]]), [1, 3, 1], atol=0.1)  # raw
    assert np.allclose([one[2], three[2], long[2]], [1 / 2, 3 / 2, 1 / 10], atol=0.1)  # by the text's length


def test_repetition_tells_toxic_texts(spark, documents):
    rnd = random.Random(5)
    plain = ["".join(rnd.choice("aeioubcdlmnprst") for _ in range(rnd.randrange(2, 9))) for _ in range(500)]
    texts, toxic = [], []
    for i in range(600):
        w = [rnd.choice(plain) for _ in range(rnd.randrange(20, 60))]
        for at in rnd.sample(range(len(w)), 5 if i % 6 == 0 else int(i % 3 == 1)):  # a chance hit is not a mark
            w[at] = "scumbag"
        texts.append(" ".join(w))
        toxic.append(int(i % 6 == 0))
    labels = spark.createDataFrame([(i, 1, t) for i, t in enumerate(toxic)], "doc_id long, quality int, toxic int")
    docs = documents(texts)
    held = toxicity.score(docs, toxicity.fit(docs, labels)).where("held_out").collect()
    assert np.mean([r["predicted"] == toxic[r["doc_id"]] for r in held]) > 0.97


def check_packing(rows, want, capacity=4096):
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == sorted(want)
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n
        assert at <= capacity
    return len(bins)


def test_documents_are_packed_whole(odd, documents):
    t = Tokenizer.from_file(TOKENIZER)
    for df in (odd, documents(["word " * n for n in (0, 4095, 4096, 4097, 9000, 50, 3000, 1094)])):
        want = []
        for r in df.collect():
            ids = [*t.encode(r["text"] or "", add_special_tokens=False).ids, 1]
            for k in range(0, len(ids), 4096):
                part = np.array(ids[k:k + 4096], "<u4")
                want.append((str(r["doc_id"]), k // 4096, k, len(part), zlib.crc32(part.tobytes())))
        check_packing(packing.pack_documents(df, TOKENIZER).collect(), want)
    assert packing.pack_documents(documents([]), TOKENIZER).count() == 0


def pieces(spark, lengths):
    return spark.createDataFrame([(i, 0, 0, n, i) for i, n in enumerate(lengths)], packing.PIECES)


@pytest.mark.parametrize("kind", ["mixed", "halves", "long", "equal"])
def test_islands_pack_close_to_the_bound(spark, kind):
    rnd = random.Random(3)
    lengths = {"mixed": [rnd.randrange(1, 1500) for _ in range(3000)], "halves": [rnd.choice([2048, 1024, 3072]) for _ in range(900)],
               "long": [rnd.randrange(2500, 4000) for _ in range(700)], "equal": [4096] * 50 + [1365] * 300}[kind]
    df = pieces(spark, lengths)
    rows = packing.pack(df, island_pieces=200).collect()
    n = check_packing(rows, [(str(i), 0, 0, x, i) for i, x in enumerate(lengths)])
    bound = -(-sum(lengths) // 4096)
    assert n <= {"mixed": 1.004 * bound, "halves": 1.03 * bound, "long": 700, "equal": 150}[kind] + 1


def best_fit(lengths):
    start = packing._Bins([], lengths, 4096)
    start.fit(list(range(len(lengths))))
    return start.bins


def triplets(n, rnd):
    """n sequences' worth of pieces, three to each, that fill them to the last token."""
    out = []
    for _ in range(n):
        a = rnd.randrange(1560, 2040)
        b = rnd.randrange((4096 - a) // 2 - 400, (4096 - a) // 2)
        out += [a, b, 4096 - a - b]
    return out


def test_evolution_beats_best_fit():
    rnd = random.Random(11)
    for seed in range(5):
        lengths = [rnd.randrange(700, 2600) for _ in range(120)]
        best = packing.evolve(lengths, seed=seed, generations=12)
        assert sorted(p for b in best for p in b) == list(range(120))
        assert len(best) <= len(best_fit(lengths))
    lengths = triplets(200, random.Random(2))
    best = packing.evolve(lengths, generations=20)
    assert sorted(p for b in best for p in b) == list(range(600))
    assert 200 <= len(best) <= len(best_fit(lengths)) - 3


def test_crossover_runs_where_best_fit_meets_the_bound():
    lengths = [random.Random(4).randrange(20, 900) for _ in range(800)]
    start, best = best_fit(lengths), packing.evolve(lengths)
    assert len(best) <= len(start)
    assert packing._fitness(best, lengths, 4096) >= packing._fitness(start, lengths, 4096)
    assert packing.evolve([]) == [] and packing.evolve([5]) == [[0]]
    assert packing.evolve([4096, 4096]) == [[0], [1]]


def test_arrived_elite_bins_enter_the_population():
    lengths = triplets(60, random.Random(3))
    planted = [[3 * i, 3 * i + 1, 3 * i + 2] for i in range(60)]
    split = [b for i, b in enumerate(planted) if i < 50] + [[p] for b in planted[50:] for p in b]
    best = packing.evolve(lengths, arrived=split)
    assert len(best) < len(packing.evolve(lengths))  # the full bins of other islands stay together
    assert sum(sorted(b) in planted for b in best) >= 40
    assert sorted(p for b in best for p in b) == list(range(180))


def test_islands_beat_best_fit_on_hard_pieces(spark):
    lengths = triplets(300, random.Random(7))
    rows = packing.pack(pieces(spark, lengths), island_pieces=300).collect()
    n = check_packing(rows, [(str(i), 0, 0, x, i) for i, x in enumerate(lengths)])
    assert n < len(best_fit(lengths))


def test_a_worker_keeps_the_state_of_one_operator():
    from depotlens.llm.tokens import library_encoder

    held = library_encoder(TOKENIZER)
    assert library_encoder(TOKENIZER) is held
    toxicity.pooled(("poison", "venom"))
    assert library_encoder.cache_info().currsize == 0 and toxicity.pooled.cache_info().currsize == 1
    library_encoder(TOKENIZER)
    assert toxicity.pooled.cache_info().currsize == 0
