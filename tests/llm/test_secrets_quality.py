import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from depotlens.llm import quality, secret_scan

ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]+")


def brute_spans(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= 16]
    return sorted(out)


def secret_texts():
    rnd = random.Random(5)
    parts = ["password", "PassWD=", "secret", "Token", "api_key", "apikey", ":", "=", " = ", "'", '"', "abcdefghijkl", "x1y2z3w4v5u6t7", "AKIA",
             "ABCDEFGHIJKLMNOP", "0123456789abcdef", "deadbeef", " ", "\n", "é🙂", "AKIAAKIA", "tok", "ſecret", "the "]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randrange(1, 25))) for _ in range(800)]


def test_spans_equal_brute_force(documents):
    texts = [*secret_texts(), None, "", "secret=token = \"abcdefghijklmnop\"", "🙂 " * 3000 + "token: abcdefghijklmnop " + "0" * 5000]
    got = {r["doc_id"]: sorted((s["start"], s["kind"], s["end"]) for s in r["spans"] if s["kind"] < 3)
           for r in secret_scan.scan(documents(texts)).collect()}
    assert got == {i: brute_spans(t) for i, t in enumerate(texts)}


def test_trigram_queries_are_necessary():
    for rule in secret_scan.RULES:
        query = secret_scan.trigram_query(rule.pattern)
        assert bool(query) == (rule.kind != "hex")
    for text in secret_texts():
        for m in ASSIGN.finditer(text):
            low = m[0].lower()
            assert all(any(all(t in low for t in s) for s in clause) for clause in secret_scan.trigram_query(secret_scan.RULES[0].pattern))
    assert secret_scan.trigram_query("ab?cd[xy]z") == [[["abc", "bcd", "cdx", "dxz"], ["abc", "bcd", "cdy", "dyz"], ["acd", "cdx", "dxz"], ["acd", "cdy", "dyz"]]]
    assert secret_scan.trigram_query("a*b+") == []


def test_added_kinds_and_redaction(documents):
    text = "x ghp_" + "a1B2" * 9 + " y -----BEGIN RSA PRIVATE KEY----- token=xoxb-1234567890ab z"
    df = documents([text, None, "clean"])
    for c in ("spans", "kinds", "_doc", "_row"):  # names that the scan uses itself
        df = df.withColumn(c, F.lit("own"))
    out = secret_scan.redact(df.withColumn("other", F.lit(1)))
    assert out.columns == [*df.columns, "other"]
    rows = {r["doc_id"]: r for r in out.collect()}
    assert all(r["spans"] == r["kinds"] == r["_row"] == "own" for r in rows.values())
    assert rows[0]["text"] == "x [SECRET] y [SECRET] [SECRET] z"
    assert rows[1]["text"] is None and rows[2]["text"] == "clean" and rows[2]["other"] == 1


def test_scan_of_odd_rows(odd, documents):
    rows = secret_scan.scan(odd).collect()
    assert len(rows) == odd.count() and {r["doc_id"] for r in rows if r["spans"]} == {9}  # a run of hex letters
    assert secret_scan.scan(documents([])).count() == 0


def test_span_text(documents):
    row = secret_scan.scan(documents(["token=abcdefghijklmnop 0123456789abcdef"])).select(secret_scan.span_text(F.col("spans")).alias("s")).first()
    assert row["s"] == "assign:0:22,hex:23:39"
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_base(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen, again = {}, set()
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i:i + 8]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            again.update(k for i in at for k in range(i, i + 8))
    n = len(words)
    return (n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(again), n < 20 or 100 * len(again) > 30 * n)


def test_base_values_equal_brute_force(documents, odd):
    rnd = random.Random(9)
    texts = [" ".join(rnd.choice(["a", "b", "é#", "*\n", "c|", "\x0b", "d"]) for _ in range(rnd.randrange(0, 60))) for _ in range(400)]
    texts += ["one two three four five six seven eight " * 3, "a b c d e f g h", "a " * 5000, "l1 w\n\nl1 w\n \nl1 w", None, " \x85 "]
    for df in (documents(texts), odd.where("doc_id < 900")):
        want = {r["doc_id"]: brute_base(r["text"]) for r in df.collect()}
        assert {r["doc_id"]: tuple(r)[1:] for r in quality.base_values(df, ["doc_id"]).drop("_text").collect()} == want


@pytest.fixture()
def corpus(spark, documents):
    rnd = random.Random(4)
    common, rare = ["the", "of", "and", "to", "in", "is", "it"], [f"w{i}" for i in range(200)]
    good = [" ".join(rnd.choice(common) if rnd.random() < .6 else rnd.choice(rare) for _ in range(60)) for _ in range(80)]
    bad = [" ".join(rnd.choice(rare) + rnd.choice(["***", "%%%", "|"]) for _ in range(60)) for _ in range(40)]
    labels = spark.createDataFrame([(i, int(i < 80), 0) for i in range(0, 120, 2)], "doc_id long, quality int, toxic int")
    return documents(good + bad), labels


def test_likelihood_ratio_tells_good_from_bad(corpus):
    docs, labels = corpus
    rows = quality.judge(docs, labels).collect()
    assert all(r["kept"] == (r["doc_id"] < 80) for r in rows if not r["base_failed"])
    more = docs.withColumn("_text", F.lit(1)).withColumn("_row", F.lit(2)).withColumn("score", F.lit(3))
    kept = quality.keep_documents(more, labels)
    assert kept.columns == more.columns and kept.where("score = 3 AND _row = 2").count() == kept.count() == 80


def test_scores_equal_brute_force(corpus):
    docs, labels = corpus
    counts = {r["bucket"]: r["ratio"] for r in quality.ratios(docs, quality.target_ids(labels)).collect()}
    assert len(counts) == quality.BUCKETS
    grams = {r["doc_id"]: r["_grams"] for r in quality.with_ngrams(docs.withColumn("_text", F.col("text"))).collect()}
    scores = {r["doc_id"]: r["score"] for r in quality.judge(docs, labels).collect()}
    for i, g in grams.items():
        assert abs(scores[i] - sum(round(counts[b], 3) for b in g) / len(g)) < 2e-3


def test_quality_without_targets_and_odd_rows(odd, documents, corpus):
    _, labels = corpus
    rows = quality.judge(odd, labels.limit(0)).collect()
    assert len(rows) == odd.count() and all(r["score"] == 0 and r["kept"] != r["base_failed"] for r in rows)
    assert quality.judge(documents([]), labels).count() == 0
