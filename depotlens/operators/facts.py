"""Fact loads (F1, F3, F4), complaint-station links (F2) and checks C2, C3.

Facts are append-only and partitioned by event month (a day column is kept;
rows are written sorted by event time, so parquet statistics prune row
groups of day windows). Dedupe against the fact uses the record hash, which
includes the event time (K12): equal hashes have equal event months, so the
anti join only reads the fact partitions of the months in the batch.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlens.operators.ids import assign_ids, ids_by_place, lit_ts, max_value
from depotlens.operators.staging import dedupe_staged, without_known
from depotlens.operators.station_dim import current_rows
from depotlens.schemas import FACT_COMPLAINT_COLUMNS, FACT_DELIVERY_COLUMNS
from depotlens.session import small, written

SPECS = {
    "complaints": dict(sk="complaint_sk", time="complained_at", date="complained_date", month="complained_month",
                       columns=FACT_COMPLAINT_COLUMNS),
    "delivery_events": dict(sk="delivery_event_sk", time="delivered_at", date="delivered_date",
                            month="delivered_month",
                            columns=FACT_DELIVERY_COLUMNS),
}


def same_months(fact: DataFrame, batch: DataFrame, date_col: str) -> DataFrame:
    """Fact rows of the event months present in the batch (partition
    pruning). The distinct months of a batch are a short list (bounded by
    the calendar)."""
    return fact.where(in_months([r[0] for r in batch.select(date_col).distinct().collect()], date_col))


def in_months(months: list, date_col: str) -> Column:
    """The condition that a month column holds one of these (null counts)."""
    known = [d for d in months if d is not None]
    cond = F.col(date_col).isin(known) if known else F.lit(False)
    return cond | F.col(date_col).isNull() if len(known) != len(months) else cond


def event_months(staged: DataFrame, system: str) -> list:
    """The event months of staged rows: reads their time column only."""
    return [r[0] for r in staged.select(F.trunc(SPECS[system]["time"], "month")).distinct().collect()]


def load_facts(fact: DataFrame | None, staged: DataFrame, system: str, run_ts: dt.datetime,
               created_at: Column | None = None, start: int | None = None, months: list | None = None) -> DataFrame:
    """the rows to append. Insert if the hash is new; within the batch
    keep the smallest (file_id, record_index) (K7). Surrogate keys continue
    after ``start`` (None: the largest one in the fact, found by a scan) in
    (file_id, record_index) order (F4). Of the fact, only the event months of
    the batch are read (``months``, where the caller knows them)."""
    s = SPECS[system]
    new = dedupe_staged(staged)
    stay = new  # the staged rows stay where they are
    if fact is not None:
        months = event_months(staged, system) if months is None else months
        known = fact.where(in_months(months, s["month"])).select("record_hash_sha256")
        start = max_value(fact, s["sk"]) if start is None else start
        stay = without_known(new, known)
    if stay is not None:
        new = ids_by_place(stay, "file_id", "record_index", s["sk"], start=start or 0)
    else:
        new = assign_ids(new.join(known, "record_hash_sha256", "left_anti"), ["file_id", "record_index"], s["sk"], start=start or 0)
    new = new.withColumn(s["date"], F.to_date(s["time"])).withColumn(s["month"], F.trunc(s["time"], "month"))
    new = new.withColumn("created_at", created_at if created_at is not None else lit_ts(run_ts))
    return new.select(*s["columns"])


def station_by_ref(dim: DataFrame) -> DataFrame:
    """Current station id per reference identifier; K6: smallest id wins."""
    return (current_rows(dim).groupBy("ref_identifier")
            .agg(F.min("pickup_station_id").alias("pickup_station_id")))


LINK_COLUMNS = ["record_hash_sha256", "complained_date", "complained_month", "pickup_station_external_id"]


def link_candidates(fact: DataFrame, waiting: DataFrame | None) -> DataFrame:
    """Complaints to link: those of ``fact`` and the ones that earlier runs
    could not link (``waiting``), each once. Null external ids never link."""
    new = fact.where(F.col("pickup_station_external_id").isNotNull()).select(*LINK_COLUMNS)
    if waiting is None:
        return new
    return (new.join(waiting.select("record_hash_sha256"), "record_hash_sha256", "left_anti")
            .select(*LINK_COLUMNS).unionByName(waiting.select(*LINK_COLUMNS)))


def link_complaints(fact: DataFrame, links: DataFrame | None, dim: DataFrame,
                    run_ts: dt.datetime) -> DataFrame:
    """new link rows (record_hash, complained_date, pickup_station_id,
    linked_at) for complaints without a link whose external id equals the
    reference identifier of a current station. Links are sticky: a linked
    complaint is never linked again; an unlinked one is retried every run.
    Null external ids are dropped before the join (no null-key skew)."""
    cand = link_candidates(fact, None)
    if links is not None:
        cand = cand.join(links.select("record_hash_sha256"), "record_hash_sha256", "left_anti")
    st = station_by_ref(dim)
    return (cand.join(st, cand.pickup_station_external_id == st.ref_identifier)
            .select("record_hash_sha256", "complained_date", "complained_month", "pickup_station_id",
                    lit_ts(run_ts).alias("linked_at")))


def complaint_view(fact: DataFrame, links: DataFrame | None) -> DataFrame:
    """The fact as the reference's table shows it: with pickup_station_id."""
    if links is None:
        return fact.withColumn("pickup_station_id", F.lit(None).cast("long"))
    return fact.join(links.select("record_hash_sha256", "pickup_station_id"), "record_hash_sha256", "left")


def repeated_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """How many values of ``key`` several rows share."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).agg(F.count_if(F.col("_n") > 1).alias("violations"))


def check_unique_hash(df: DataFrame) -> DataFrame:
    """Rows, distinct hashes, hashes seen more than once. A short number
    per hash is counted first; whole hashes move only where it stands twice."""
    short = F.xxhash64("record_hash_sha256").alias("_short")
    twice = df.groupBy(short).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_short")
    suspects = df.select("record_hash_sha256", short).join(small(written(twice, "repeated"), 32), "_short", "left_semi")
    per = suspects.groupBy("record_hash_sha256").agg(F.count(F.lit(1)).alias("_n"))
    # every row counts as a hash of its own, but for the suspects
    n, none = F.count(F.lit(1)), F.lit(0).cast("long")
    both = df.agg(n.alias("rows"), n.alias("distinct_hashes"), none.alias("duplicated_hashes")).unionByName(
        per.agg(none.alias("rows"), (n - F.coalesce(F.sum("_n"), none)).alias("distinct_hashes"),
                F.count_if(F.col("_n") > 1).alias("duplicated_hashes")))
    return both.agg(*[F.sum(c).alias(c) for c in both.columns])


def check_file_fk(df: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows whose file_id is missing from the ledger (must be 0)."""
    orphans = df.join(ledger.select("file_id"), "file_id", "left_anti")
    return orphans.agg(F.count(F.lit(1)).alias("orphan_rows"))
