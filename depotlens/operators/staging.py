"""Staging rows (L7-L10): normalised names, record hash, dedupe by hash."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlens.functions.text import norm_text, record_hash
from depotlens.operators.ids import assign_ids, lit_ts
from depotlens.operators.prefilter import is_set
from depotlens.schemas import COMPLAINT_FIELDS, DELIVERY_FIELDS
from depotlens.session import BROADCAST_BYTES, small, written

BITMAP_BYTES = 4 << 10  # of the places of a file that share a bucket

KINDS = {
    "complaints": dict(fields=COMPLAINT_FIELDS, time="complained_at"),
    "delivery_events": dict(fields=DELIVERY_FIELDS, time="delivered_at"),
}


def staging_columns(system: str) -> list[str]:
    k = KINDS[system]
    return ["file_id", "record_index", "record_hash_sha256", *k["fields"],
            "recipient_name_norm", "recipient_address_norm", "ingested_at"]


def finish_staging(rows: DataFrame, system: str, run_ts: dt.datetime) -> DataFrame:
    """Add record hash (K12), normalised recipient (K11) and ingested_at to
    rows that already carry file_id and record_index (and, as ``_time_text``,
    the time as sent)."""
    return (with_hash_and_norms(rows, system).withColumn("ingested_at", lit_ts(run_ts))
            .select(*staging_columns(system)))


def with_hash_and_norms(rows: DataFrame, system: str) -> DataFrame:
    """Rows with the record hash and the normalised recipient."""
    raw = "_time_text" if "_time_text" in rows.columns else None
    return with_norms(rows.withColumn("record_hash_sha256", hash_of(system, raw)))


def hash_of(system: str, time_text: str | None = None) -> Column:
    k = KINDS[system]
    return record_hash(system, k["time"], [c for c in k["fields"] if c != k["time"]], time_text)


def with_norms(rows: DataFrame) -> DataFrame:
    return (rows.withColumn("recipient_name_norm", norm_text("recipient_name"))
            .withColumn("recipient_address_norm", norm_text("recipient_address")))


def stage_from_files(records: DataFrame, files: DataFrame, system: str, order_cols: list[str],
                     run_ts: dt.datetime, derived: dict[str, Column] | None = None) -> DataFrame:
    """Staging rows for records whose file is known by (ingest_dt,
    source_format): ``files`` maps that pair to ledger file ids. A file sent
    twice gives every record twice, under both file ids. record_index is the
    0-based position in the file: records are numbered in (ingest_dt,
    source_format, order) order by the distributed id allocator and shifted
    by the first id of their pair (no window over a whole file). The files with
    their first ids are written, so that Spark sees how few they are and does
    not shuffle the records to join them.

    The numbered rows are written without what only orders them and without
    their hash, which would be half of what they take; the staging rows are a
    view of them, with the hash of the fields. ``derived``: the record columns
    that are made of the others, after the move."""
    key, derived = ["ingest_dt", "source_format"], derived or {}
    kept = [*key, *[c for c in staging_columns(system) if c not in ("file_id", "record_index", "record_hash_sha256", "ingested_at")]]
    numbered = assign_ids(records, [derived.get(c, c) for c in [*key, *order_cols]], "_id",
                          finish=lambda rows: with_norms(rows.withColumns(derived)).select(*kept))
    first = numbered.groupBy(*key).agg(F.min("_id").alias("_first"))
    f = small(written(first.join(files.select("file_id", *key), key), "first-ids"), 96)
    j = numbered.join(f, key).withColumn("record_index", (F.col("_id") - F.col("_first")).cast("int"))
    # a hash is never null, but Spark can't know: without this it would be made once more for each test of it
    j = j.withColumn("record_hash_sha256", F.coalesce(hash_of(system), F.lit("")))
    return j.withColumn("ingested_at", lit_ts(run_ts)).select(*staging_columns(system))


def dedupe_staged(batch: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """L10 with K7: one row per record hash, the one with the smallest
    (file_id, record_index); hashes already staged are dropped. The rows
    themselves are only joined with the places to drop, which are few or none in
    most batches (then they are broadcast and the rows stay where they are).

    A short number per hash is counted first; only rows whose number stands
    twice (``suspects``) are compared by the whole hash. Counts and smallest
    places have a map-side half, and places are dropped by (hash, place), so a
    hash repeated very often does not pile up in one task. (file_id,
    record_index) is the key of a batch; rows without hash or place go."""
    cols = batch.columns
    key = ["record_hash_sha256", "_place"]
    placed = (batch.withColumn("_place", F.col("file_id") * (1 << 31) + F.col("record_index"))
              .where(F.col("record_hash_sha256").isNotNull() & F.col("_place").isNotNull()))
    short = F.xxhash64("record_hash_sha256").alias("_short")
    twice = placed.groupBy(short).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_short")
    twice, kept = written(twice, "repeated"), placed
    if not twice.isEmpty():
        suspects = written(placed.select(*key, short).join(small(twice, 32), "_short", "left_semi").select(*key), "suspects")
        first = suspects.groupBy("record_hash_sha256").agg(F.min("_place").alias("_place"))
        dropped = small(written(suspects.join(first, key, "left_anti"), "dropped"), 160)
        kept = placed.join(dropped, key, "left_anti")
    if existing is not None:
        kept = kept.join(existing.select("record_hash_sha256"), "record_hash_sha256", "left_anti")
    return kept.select(*cols)


def packed(name: str) -> Column:
    """A hash in half its bytes: hex text as the bytes it stands for, other
    text as it is, told apart by the first byte."""
    text, raw = F.col(name), F.unhex(name)
    return (F.when(F.lower(F.hex(raw)) == text, F.concat(F.lit(bytearray(b"\1")), raw))
            .otherwise(F.concat(F.lit(bytearray(b"\0")), text.cast("binary"))))


def without_known(rows: DataFrame, known: DataFrame) -> DataFrame | None:
    """The rows (with hash and place) whose hash is not among those of
    ``known``. Only hashes and places are shuffled: the places of known rows
    become bitmaps per file, which are broadcast, and the rows stay where they
    are. None where the bitmaps are too large for that, or where a row with
    another hash shares the place of a known one. ``rows`` is read three times."""
    at = F.col("record_index").cast("long")
    place = {"_block": F.bitmap_bucket_number(at), "_bit": F.bitmap_bit_position(at)}
    key = ["file_id", "_block"]
    found = (rows.withColumns({**place, "_hash": packed("record_hash_sha256")}).select(*key, "_bit", "_hash")
             .join(known.select(packed("record_hash_sha256").alias("_hash")), "_hash", "left_semi"))
    found = written(found.drop("_hash"), "known-places")
    # dealt by block first: a task holds the bitmaps of its own blocks only
    bitmaps = written(found.repartition(*key).groupBy(*key).agg(F.bitmap_construct_agg("_bit").alias("_bits")), "known-blocks")
    if bitmaps.count() * BITMAP_BYTES > BROADCAST_BYTES:
        return None
    held = rows.withColumns(place).join(F.broadcast(bitmaps), key, "left")
    there = F.coalesce(is_set("_bits", "_bit"), F.lit(False))
    if held.where(there).count() != found.count():
        return None
    return held.where(~there).select(*rows.columns)
