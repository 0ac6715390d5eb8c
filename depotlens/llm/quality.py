"""Operator 8: quality rules.

Tokens (runs of letters, digits and marks, and single symbols) and pairs of
neighbours are hashed into ``BUCKETS`` buckets. Two multinomials over the buckets,
of trusted target documents and of the whole raw corpus, give every bucket a
log-likelihood ratio; a document's score is the mean ratio of its n-grams, and
every document at or above a fixed threshold is kept.

The target multinomial is fitted on at most ``target_rows`` documents labelled
as good (a documented bound: their ids are broadcast); the raw one counts all
documents. The table of ratios has ``BUCKETS`` rows at most, whatever the
input, and reaches the documents as one constant array.

Base values of a text: words are runs without \\x20 and \\x09-\\x0D.

* null or empty text: no words, base_failed, not kept, score 0.
* no target documents: all ratios are 0, so the base rules decide.
* repeated rows: one result row each. Extra columns are not carried by
  ``judge``; ``keep_documents`` keeps all columns of its input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlens.llm.common import text_or_empty, written

BUCKETS = 1 << 15
TARGET_ROWS = 20_000
#: mean log-likelihood ratio below which a document is rejected
THRESHOLD = -0.35
_NO_SYMBOLS = r"[^#*$%&|<>]+"
WINDOW = 8
_WORD_GAP = r"[\x20\x09-\x0D]+"
_TOKEN = r"[\p{L}\p{M}\p{N}]+|[^\p{L}\p{M}\p{N}\s]"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, _WORD_GAP, -1), "")


def _next_pairs(hashes: str, distance: int) -> Column:
    """Hash of each entry with the one ``distance`` further on (the last ones alone)."""
    return F.zip_with(hashes, F.slice(hashes, 1 + distance, F.size(hashes)), lambda a, b: F.xxhash64(a, b))


def _with_windows(rows: DataFrame) -> DataFrame:
    """``_windows``: the hash of every window of 8 words, by doubling."""
    rows = rows.withColumn("_w1", F.transform("_words", lambda w: F.xxhash64(w)))
    rows = rows.withColumn("_w2", _next_pairs("_w1", 1)).withColumn("_w4", _next_pairs("_w2", 2))
    return rows.withColumn("_windows", F.slice(
        _next_pairs("_w4", 4), 1, F.greatest(F.size("_words") - (WINDOW - 1), F.lit(0))))


def _covered() -> tuple[Column, Column]:
    """Words in 8-word windows that the text holds twice or more: the windows
    are sorted by hash with their places, the places whose hash stands twice
    are sorted again, and the union of the windows at these places is added up
    from the distances between them."""
    by_hash = F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    # a place counts if its neighbour in the sorted order has the same hash
    pairs = F.zip_with("_sorted", F.slice("_sorted", 2, F.size("_sorted")), lambda a, b: F.struct(
        F.when(a["h"] == b["h"], a["i"]).alias("a"), F.when(a["h"] == b["h"], b["i"]).alias("b")))
    places = F.array_sort(F.array_distinct(F.array_compact(F.concat(
        F.transform(pairs, lambda p: p["a"]), F.transform(pairs, lambda p: p["b"])))))
    acc = F.struct(F.lit(-WINDOW).alias("at"), F.lit(0).cast("long").alias("n"))
    total = F.aggregate(places, acc, lambda x, p: F.struct(
        p.alias("at"), (x["n"] + F.least(F.lit(WINDOW), p - x["at"])).alias("n")), lambda x: x["n"])
    return by_hash, total


def base_values(df: DataFrame, keep: list[str]) -> DataFrame:
    """keep columns, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = F.col("_text")
    rows = df.select(*keep, text_or_empty().alias("_text")).withColumn("_words", words_of(text))
    rows = _with_windows(rows)
    rows = rows.withColumn("_again", F.size(F.array_distinct("_windows")) < F.size("_windows"))
    by_hash, covered = _covered()
    rows = rows.withColumn("_sorted", F.when(F.col("_again"), by_hash))
    rows = rows.withColumn("_lines", F.split(text, "\n", -1))
    # only where two lines are equal, blank ones among them, are these looked at one by one
    rows = rows.withColumn("_same_lines", F.size(F.array_distinct("_lines")) < F.size("_lines"))
    rows = rows.withColumn("_marked", F.when(F.col("_same_lines"), F.filter("_lines", lambda x: x.rlike(r"[^\x20\x09-\x0D]"))))
    rows = rows.select(
        *keep, "_text", F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, _NO_SYMBOLS, "")).cast("long").alias("n_symbols"),
        F.when(F.col("_same_lines"), F.size("_marked") - F.size(F.array_distinct("_marked"))).otherwise(F.lit(0)).cast("long").alias("n_dup_lines"),
        F.when(F.col("_again"), covered).otherwise(F.lit(0).cast("long")).alias("n_repeat_words"))
    return rows.withColumn("base_failed", (F.col("n_words") < 20) | (
        100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def with_ngrams(df: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """df (with ``_text``) and ``_grams``: the buckets of all tokens and of
    all pairs of neighbouring tokens."""
    def bucket(*words: Column) -> Column:
        return F.pmod(F.xxhash64(*words), F.lit(buckets)).cast("int")

    rows = df.withColumn("_tokens", F.regexp_extract_all("_text", F.lit(_TOKEN), F.lit(0)))
    ones = F.transform("_tokens", lambda t: bucket(t))
    pairs = F.slice(F.zip_with("_tokens", F.slice("_tokens", 2, F.size("_tokens")), lambda a, b: bucket(a, b)),
                    1, F.greatest(F.size("_tokens") - 1, F.lit(0)))  # the last token has no neighbour
    return rows.withColumn("_grams", F.concat(ones, pairs)).drop("_tokens")


def target_ids(labels: DataFrame, target_rows: int = TARGET_ROWS) -> DataFrame:
    """At most target_rows ids labelled good, the same ones on every run."""
    good = labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(target_rows)


def ratios(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, ratio) for every bucket: log of the target's count over the one
    that the raw corpus lets expect at the target's size, both plus one (so a
    rare n-gram says little). Counts cover the whole corpus."""
    marked = docs.select("doc_id", text_or_empty().alias("_text")).join(
        F.broadcast(target.withColumn("_good", F.lit(1))), "doc_id", "left")  # bounded by target_rows
    counts = (
        with_ngrams(marked.select("_text", F.coalesce("_good", F.lit(0)).alias("_good")), buckets)
        # outer: an inner explode would have every text's n-grams made twice, to filter empty ones
        .select("_good", F.explode_outer("_grams").alias("bucket")).where(F.col("bucket").isNotNull())
        .groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("_good").alias("target")))
    counts = written(counts, "quality-counts")
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    full = every.join(counts, "bucket", "left").select(
        "bucket", F.coalesce("raw", F.lit(0)).alias("raw"), F.coalesce("target", F.lit(0)).alias("target"))
    sums = full.agg(F.sum("raw").alias("raws"), F.sum("target").alias("targets"))
    n_raw, n_target = (sums.select(c).scalar() for c in ("raws", "targets"))
    share = F.log((F.col("target") + 1.0) / (F.col("raw") * n_target / n_raw + 1.0))
    return full.select("bucket", F.when(n_target > 0, share).otherwise(F.lit(0.0)).alias("ratio"))


def judge(docs: DataFrame, labels: DataFrame, keep: list[str] | None = None, buckets: int = BUCKETS,
          threshold: float = THRESHOLD, target_rows: int = TARGET_ROWS) -> DataFrame:
    """keep columns (default doc_id), the base values, score and kept."""
    keep = keep or ["doc_id"]
    table = ratios(docs, target_ids(labels, target_rows), buckets)
    # one number per bucket, whatever the input: in thousandths, so that sums do not depend on order
    steps = [r[0] for r in table.orderBy("bucket").select(F.round(F.col("ratio") * 1000).cast("int")).collect()]
    ratio = F.split(F.lit(",".join(map(str, steps))), ",").cast("array<int>")
    rows = with_ngrams(base_values(docs, keep), buckets)
    total = F.aggregate("_grams", F.lit(0).cast("long"), lambda acc, b: acc + F.get(ratio, b))
    score = F.when(F.size("_grams") > 0, total / F.size("_grams") / 1000).otherwise(F.lit(0.0))
    rows = rows.withColumn("score", score)
    return rows.select(
        *keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score",
        (~F.col("base_failed") & (F.col("score") >= threshold)).alias("kept"))


def keep_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that pass, with all their columns."""
    # the row travels as one column, so its names cannot clash with the values'
    held = docs.select("doc_id", "text", F.struct(*docs.columns).alias("_row"))
    judged = judge(held, labels, ["_row"], **options)
    # the row number keeps the optimizer from moving the filter below the
    # scores, where it would compute each of their steps again wherever it is used
    return judged.withColumn("_n", F.monotonically_increasing_id()).where("kept AND _n >= 0").select("_row.*")
