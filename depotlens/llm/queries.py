"""The registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from depotlens.llm import (bpe, ctph, fim, hard_negatives, minhash, ngram_join, oracle, packing, pfor, quality,
                           secret_scan, sharding, toxicity, url_filter)
from depotlens.llm.common import table
from depotlens.session import new_scratch_path


def op1_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge_urls(pages, url_filter.rules_frame(spark), url_filter.repeated_urls(pages)).drop("listed")


def op2_sharding(spark, sf_dir):
    return sharding.place_documents(table(spark, sf_dir, "documents"))


def op3_byte_bpe(spark, sf_dir, path=public_tokenizers.path("byte_bpe_multi_50k.tiktoken")):
    ids = bpe.encode_documents(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return bpe.decode_ids(ids, path).select(
        "doc_id", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_fingerprints(spark, sf_dir):
    return ctph.compare_neighbours(table(spark, sf_dir, "documents"))


def op5_secret_scan(spark, sf_dir):
    spans = secret_scan.scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < len(secret_scan.BASE))

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    counts = [number(i).alias(f"n_{r.kind}") for i, r in enumerate(secret_scan.BASE)]
    return spans.select(
        "doc_id", *counts, F.sha2(secret_scan.span_text(base).cast("binary"), 256).alias("base_sha256"),
        secret_scan.span_text(F.col("spans")).alias("spans"))


def op6_minhash(spark, sf_dir):
    return minhash.link(table(spark, sf_dir, "documents"), words=3, percent=85)


def op7_token_files(spark, sf_dir, path=public_tokenizers.path("byte_bpe_50k.json")):
    files = new_scratch_path(spark, "llm-token-files")
    pfor.write_files(table(spark, sf_dir, "documents"), files, path)
    return pfor.read_files(spark, files, end="digest")


def op8_quality(spark, sf_dir):
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op10_packing(spark, sf_dir, path=public_tokenizers.path("word_bpe_49k.json")):
    return packing.pack_documents(table(spark, sf_dir, "documents"), path)


def op11_fill_in_middle(spark, sf_dir):
    return fim.transform(table(spark, sf_dir, "documents")).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"))


def op12_ngram_join(spark, sf_dir):
    return ngram_join.join(table(spark, sf_dir, "documents"), words=3, percent=90)


def op13_hard_negatives(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").withColumn(
        "label", F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"))
    return hard_negatives.mine(vectors, F.expr("vec_id % 50 = 0"))


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_sharding": op2_sharding,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_fingerprints": op4_fingerprints,
    "op5_secret_scan": op5_secret_scan,
    "op6_minhash": op6_minhash,
    "op7_token_files": op7_token_files,
    "op8_quality": op8_quality,
    "op9_toxicity": op9_toxicity,
    "op10_packing": op10_packing,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_ngram_join": op12_ngram_join,
    "op13_hard_negatives": op13_hard_negatives,
}

#: the others are not SQL (or need functions that DuckDB lacks): the tests hold them against brute force
ORACLE: dict[str, str] = {
    "op1_url_filter": oracle.url_filter_sql(),
    "op5_secret_scan": oracle.secret_scan_sql(),
    "op6_minhash": oracle.minhash_sql(),
    "op11_fill_in_middle": oracle.fill_in_middle_sql(),
    "op12_ngram_join": oracle.ngram_join_sql(),
    "op13_hard_negatives": oracle.hard_negatives_sql(),
}
