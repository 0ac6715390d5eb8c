"""Operator 1: URL filters.

Rules (host, path prefix) and a list of canonical URLs are entries of one
set. Every distinct URL expands into the few entries that could match it (host
suffix x path prefix in the shapes that the rules have, and its canonical
form); a blocked Bloom filter (one 64-bit word per block, all bits of a key in
one word) lets possible hits through, and an exact hash join on the entry
removes its false positives.

* null URL or one without "://": host, path and canonical form are empty, no
  rule fits, the verdict is that of an unlisted URL.
* repeated rows: URLs are judged once per distinct URL and joined back, so
  each row keeps its own result row; a null id stays null.
* repeated rules with different verdicts: block wins.
* two rules of the same length fit: the one with the longer host wins.
* extra columns of the input are not carried; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from depotlens.llm.common import ascii_lower, written

# fixed values: the rules of the contract
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)

URL_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
URL_QUERY = r"(?s)^[^?#]*\?([^#]*)"
#: parameters that do not change the page: they are not part of the canonical URL
TRACKING = "^(utm_[a-z]+|ref|gclid|fbclid)="

BITS_PER_KEY = 16
BITS_SET = 5


def rules_frame(spark: SparkSession, rules=RULES) -> DataFrame:
    def text(v: str) -> str:
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"

    rows = ", ".join("(" + ", ".join(map(text, r)) + ")" for r in rules)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS rules(host, path, verdict)")


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, URL_PARTS, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL_PARTS, 2), F.lit(""))


def canonical_of(url: Column, host: Column, path: Column) -> Column:
    """Host without leading www., path without trailing slashes, parameters
    sorted and without tracking ones; no scheme, no fragment."""
    params = F.array_sort(F.filter(
        F.split(F.coalesce(F.regexp_extract(url, URL_QUERY, 1), F.lit("")), "&", -1),
        lambda p: (p != "") & ~p.rlike(TRACKING)))
    query = F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&"))).otherwise(F.lit(""))
    return F.when(host == "", F.lit("")).otherwise(
        F.concat(F.regexp_replace(host, r"^www\.", ""), F.regexp_replace(path, r"/+$", ""), query))


def parsed(df: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    url = F.col("_url")
    out = df.select(F.col(id_col).alias("_id"), F.col(url_col).cast("string").alias("_url"))
    out = out.select("_id", "_url", host_of(url).alias("host"), path_of(url).alias("path"))
    return out.select("_id", "host", "path",
                      canonical_of(url, F.col("host"), F.col("path")).alias("canonical"))


def repeated_urls(df: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """The list that the query uses: canonical URLs that several rows share
    (crawled again under other schemes, parameters or fragments)."""
    return (parsed(df, id_col, url_col).where(F.col("canonical") != "").groupBy("canonical").count()
            .where(F.col("count") > 1).select("canonical"))


def _block(entry: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(entry), F.lit(blocks))


def _mask(entry: Column) -> Column:
    h = F.xxhash64(entry, F.lit("bits"))
    mask = F.lit(0).cast("long")
    for i in range(BITS_SET):
        bit = F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return mask


def bloom_filter(entries: DataFrame, blocks: int) -> DataFrame:
    """(block, bits): one word per block that holds a key."""
    e = F.col("entry")
    return (entries.select(_block(e, blocks).alias("block"), _mask(e).alias("mask"))
            .groupBy("block").agg(F.bit_or("mask").alias("bits")))


def judge_urls(df: DataFrame, rules: DataFrame, listed: DataFrame, id_col: str = "page_id",
               url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict, listed) for every row of df.

    rules: (host, path, verdict); listed: (canonical) URLs to block where no
    rule fits."""
    pages = parsed(df, id_col, url_col)
    entries = written(
        rules.select(F.concat("host", "path").alias("entry"), "verdict", F.length("host").alias("host_length"))
        .unionByName(listed.select(F.concat(F.lit("="), "canonical").alias("entry"),
                                   F.lit("listed").alias("verdict"), F.lit(0).alias("host_length")))
        .groupBy("entry").agg(F.max("verdict").alias("verdict"), F.max("host_length").alias("host_length")), "url-entries")
    # the shapes of the rules (labels of the host, length of the path): a
    # URL has one candidate per shape, whatever the number of rules
    shapes = sorted((r[0], r[1]) for r in rules.select(
        F.size(F.split("host", r"\.", -1)), F.length("path")).distinct().collect())
    keys, blocks = entries.count(), 64
    while blocks * 64 < keys * BITS_PER_KEY:
        blocks *= 2
    bloom = bloom_filter(entries, blocks)

    labels = F.split("host", r"\.", -1)
    candidates = [F.when((F.size(labels) >= k) & (F.length("path") >= n),
                         F.concat(F.array_join(F.slice(labels, -k, k), "."), F.substring("path", 1, n)))
                  for k, n in shapes]
    candidates.append(F.when(F.col("canonical") != "", F.concat(F.lit("="), "canonical")))
    key = ["host", "path", "canonical"]
    urls = pages.select(*key).distinct()
    possible = (
        urls.select(*key, F.explode(F.array_compact(F.array(*candidates))).alias("entry"))
        .withColumn("block", _block(F.col("entry"), blocks)).withColumn("mask", _mask(F.col("entry")))
        .join(bloom, "block").where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
        .select(*key, "entry"))
    rule = F.col("verdict") != "listed"
    hits = (
        possible.join(entries, "entry").groupBy(*key).agg(
            F.max(F.when(rule, F.struct(F.length("entry").alias("n"), "host_length", "entry", "verdict"))).alias("best"),
            F.max(~rule).alias("listed")))
    out = pages.join(hits, key, "left")
    return out.select(
        F.col("_id").alias(id_col), "host", "path", F.col("best.entry").alias("rule"),
        F.coalesce("best.verdict", F.when(F.col("listed"), F.lit("block")), F.lit("allow")).alias("verdict"),
        F.coalesce("listed", F.lit(False)).alias("listed"))
