"""Pickup-station history as a type-2 dimension.

The daily run is one pure function ``apply_snapshot(dim, snapshot, run_ts)``.
All classes (unchanged, changed, added, removed) are computed from one frozen
set of current rows, so a changed station keeps its id and gets its new
version in the same run (decision K1), unlike four statements that each see
the effect of the one before.

Identity (decision K2): the reference identifier wins. A fingerprint
(zip|street) match only pairs snapshot rows and current rows that both found
no identifier match, only when the fingerprint occurs once on each side, and
never for a blank fingerprint (K3). Both steps are equi joins; the
"ref OR fingerprint" join is never written, since it plans as a nested loop.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotlens.functions.text import attr_hash, fingerprint, fingerprint_is_blank
from depotlens.operators.ids import assign_ids, lit_ts
from depotlens.schemas import STATION_DIM, STATION_DIM_COLUMNS, STATION_SNAPSHOT

ATTRS = ["ref_identifier", "name", "city", "zip_code", "street", "fingerprint", "attr_hash_sha256"]


class EmptySnapshotError(ValueError):
    """Raised when a daily snapshot has no rows (decision K5)."""


def empty_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], STATION_DIM)


def empty_snapshot(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], STATION_SNAPSHOT)


def snapshot_rows(station_list: DataFrame, snapshot_date: dt.date) -> DataFrame:
    """Reference list -> staging snapshot rows with fingerprint (D2) and
    attribute hash (D3)."""
    return station_list.select(
        F.lit(snapshot_date).cast("date").alias("snapshot_date"),
        F.col("identifier").alias("ref_identifier"),
        "name", "city", "zip_code", "street",
        fingerprint().alias("fingerprint"),
        attr_hash().alias("attr_hash_sha256"),
    )


def upsert_snapshot(old: DataFrame, new: DataFrame) -> DataFrame:
    """Upsert by (snapshot_date, ref_identifier). Rows of a re-run replace
    the ones with the same key; rows missing from the re-run stay. A key that
    one list holds several times keeps its smallest row (by name, city, zip
    code, street; nulls first)."""
    key = ["snapshot_date", "ref_identifier"]
    rest = [c for c in old.columns if c not in key]
    order = F.struct("name", "city", "zip_code", "street")
    new = new.groupBy(*key).agg(F.min_by(F.struct(*rest), order).alias("_r")).select(*key, "_r.*")
    return old.join(new.select(*key), key, "left_anti").unionByName(new.select(*old.columns))


def current_rows(dim: DataFrame) -> DataFrame:
    return dim.where(F.col("is_current"))


def resolve(current: DataFrame, today: DataFrame) -> DataFrame:
    """D6 under K2/K3/K6: each snapshot row with the station id it belongs to
    (null = new station) and how it was found (``match``: ref / fingerprint)."""
    cur = current.select("pickup_station_id", "ref_identifier", "fingerprint", "zip_code", "street")
    # K6: two current rows with one identifier -> the smallest id wins.
    by_ref = cur.groupBy("ref_identifier").agg(F.min("pickup_station_id").alias("_ref_id"))
    # used four times below: written once (snapshot-sized) so the plan
    # does not repeat the join
    t = today.join(by_ref, "ref_identifier", "left").checkpoint(eager=True)

    ref_matched_ids = t.where(F.col("_ref_id").isNotNull()).select(F.col("_ref_id").alias("pickup_station_id"))
    cur_left = (cur.join(ref_matched_ids, "pickup_station_id", "left_anti")
                .where(~fingerprint_is_blank()))
    snap_left = t.where(F.col("_ref_id").isNull() & ~fingerprint_is_blank())

    def unique_fp(df: DataFrame) -> DataFrame:
        return df.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("_n")).where("_n = 1").select("fingerprint")

    fp_pairs = (snap_left.select("ref_identifier", "fingerprint").join(unique_fp(snap_left), "fingerprint", "left_semi")
                .join(cur_left.select("fingerprint", F.col("pickup_station_id").alias("_fp_id"))
                      .join(unique_fp(cur_left), "fingerprint", "left_semi"), "fingerprint")
                .select("ref_identifier", "_fp_id"))
    out = t.join(fp_pairs, "ref_identifier", "left")
    return (out.withColumn("pickup_station_id", F.coalesce("_ref_id", "_fp_id"))
            .withColumn("match", F.when(F.col("_ref_id").isNotNull(), F.lit("ref"))
                        .when(F.col("_fp_id").isNotNull(), F.lit("fingerprint")))
            .drop("_ref_id", "_fp_id")
            .checkpoint(eager=True))


def classify(dim: DataFrame, today: DataFrame, run_ts: dt.datetime) -> dict[str, DataFrame]:
    """Split one daily run into its parts (without new ids yet).

    Keys: history (non-current rows, untouched), unchanged, closed, removed,
    new_version (id known, sk missing), added (id and sk missing), resolved.
    """
    ts = lit_ts(run_ts)
    cur = current_rows(dim)
    history = dim.where(~F.col("is_current"))
    resolved = resolve(cur, today)
    matched = resolved.where(F.col("pickup_station_id").isNotNull())
    snap_cols = [F.col(c).alias("_s_" + c) for c in ATTRS]
    # every class below is a filter of this one pairing: written once
    paired = cur.join(matched.select("pickup_station_id", *snap_cols), "pickup_station_id", "left") \
                .checkpoint(eager=True)
    is_removed = F.col("_s_ref_identifier").isNull()
    is_changed = (~is_removed) & ((F.col("attr_hash_sha256") != F.col("_s_attr_hash_sha256"))
                                  | (F.col("ref_identifier") != F.col("_s_ref_identifier")))
    base = [c for c in STATION_DIM_COLUMNS]
    unchanged = paired.where(~is_removed & ~is_changed).select(*base)
    closed = (paired.where(is_changed)
              .withColumn("valid_to", ts).withColumn("is_current", F.lit(False)).select(*base))
    removed = (paired.where(is_removed)
               .withColumn("valid_to", ts).withColumn("is_current", F.lit(False))
               .withColumn("is_active", F.lit(False)).select(*base))
    new_version = paired.where(is_changed).select(
        "pickup_station_id", *[F.col("_s_" + c).alias(c) for c in ATTRS])
    added = resolved.where(F.col("pickup_station_id").isNull()).select(*ATTRS)
    return dict(history=history, unchanged=unchanged, closed=closed, removed=removed,
                new_version=new_version, added=added, resolved=resolved)


def _finish_new(rows: DataFrame, run_ts: dt.datetime) -> DataFrame:
    return (rows.withColumn("valid_from", lit_ts(run_ts))
            .withColumn("valid_to", F.lit(None).cast("timestamp_ntz"))
            .withColumn("is_current", F.lit(True)).withColumn("is_active", F.lit(True))
            .select(*STATION_DIM_COLUMNS))


def apply_snapshot(dim: DataFrame, snapshot: DataFrame, run_ts: dt.datetime,
                   snapshot_date: dt.date | None = None, allow_empty: bool = False,
                   parts: dict | None = None) -> DataFrame:
    """The dimension after one daily snapshot (ADD, CLOSE, INSERT, REMOVE).

    ``snapshot`` is staging rows (``snapshot_rows``); when ``snapshot_date``
    is given only that day is used. New station ids (D11) continue after the
    largest id ever given, in ref_identifier order; new row versions get
    surrogate keys after the largest one, in station-id order. A station that
    was removed and comes back gets a new id (K4).
    """
    top = dim.agg(F.max("pickup_station_id").alias("i"), F.max("pickup_station_sk").alias("s")).first()
    p = apply_changes(dim, snapshot, run_ts, int(top["i"] or 0), int(top["s"] or 0), snapshot_date, allow_empty)
    if parts is not None:
        parts.update(p)
    return p["history"].unionByName(p["current"]).unionByName(p["newly_closed"])


def apply_changes(dim: DataFrame, snapshot: DataFrame, run_ts: dt.datetime, last_id: int, last_sk: int,
                  snapshot_date: dt.date | None = None, allow_empty: bool = False) -> dict[str, DataFrame]:
    """D10 as changes: the parts of ``classify``, with ``current`` (all current
    rows after the run), ``newly_closed`` and ``fresh`` (the rows with new
    surrogate keys). Only current rows of ``dim`` are needed; ``last_id`` and
    ``last_sk`` are the largest keys ever given."""
    today = snapshot if snapshot_date is None else snapshot.where(F.col("snapshot_date") == F.lit(snapshot_date))
    n_today = today.count()
    if not allow_empty and n_today == 0:
        raise EmptySnapshotError("snapshot has no rows; pass allow_empty=True to deactivate every station")
    p = classify(dim, today, run_ts)
    added = assign_ids(p["added"], ["ref_identifier"], "pickup_station_id", start=last_id)
    fresh = p["new_version"].unionByName(added.select("pickup_station_id", *ATTRS))
    fresh = _finish_new(assign_ids(fresh, ["pickup_station_id"], "pickup_station_sk", start=last_sk), run_ts)
    return dict(p, fresh=fresh, current=p["unchanged"].unionByName(fresh), newly_closed=p["closed"].unionByName(p["removed"]))


def first_load(spark: SparkSession, snapshot: DataFrame, run_ts: dt.datetime,
               snapshot_date: dt.date | None = None) -> DataFrame:
    """D4 (decision K8): the daily run against an empty dimension, so a second
    first load cannot duplicate stations."""
    return apply_snapshot(empty_dim(spark), snapshot, run_ts, snapshot_date)


def state_as_of(dim: DataFrame, at: dt.datetime) -> DataFrame:
    """The station rows valid at ``at`` (half-open validity intervals)."""
    t = lit_ts(at)
    return dim.where((F.col("valid_from") <= t) & (F.col("valid_to").isNull() | (F.col("valid_to") > t)))


def check_keys(dim: DataFrame) -> DataFrame:
    """Stations with several current rows and surrogate keys given twice."""
    current = dim.where(F.col("is_current")).groupBy("pickup_station_id").count().where("count > 1")
    keys = dim.groupBy("pickup_station_sk").count().where("count > 1")
    return (current.agg(F.count(F.lit(1)).alias("violations")).select(F.lit("one_current").alias("check_name"), "violations")
            .unionByName(keys.agg(F.count(F.lit(1)).alias("violations")).select(F.lit("unique_sk").alias("check_name"), "violations")))


def check_one_current(dim: DataFrame) -> DataFrame:
    """Stations, current rows and stations with more than one current row."""
    per = dim.groupBy("pickup_station_id").agg(F.count_if(F.col("is_current")).alias("_c"))
    return per.agg(F.count(F.lit(1)).alias("stations"),
                   F.coalesce(F.sum("_c"), F.lit(0)).cast("long").alias("current_rows"),
                   F.count_if(F.col("_c") > 1).alias("violations"))
