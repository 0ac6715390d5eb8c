"""Daily load-quality counts (M1) and pipeline volumes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotlens.operators.ids import lit_ts


def complaint_monitoring(complaints: DataFrame, monitoring_date: dt.date, run_ts: dt.datetime) -> DataFrame:
    """M1: one row for the day: complaints created that day and those of them
    without a station. A global aggregate, so a day without loads still gives
    one row with 0, 0. ``complaints`` is the fact with pickup_station_id."""
    lo = F.lit(monitoring_date.isoformat()).cast("timestamp_ntz")
    hi = F.lit((monitoring_date + dt.timedelta(days=1)).isoformat()).cast("timestamp_ntz")
    day = complaints.where((F.col("created_at") >= lo) & (F.col("created_at") < hi))
    return day.agg(F.count(F.lit(1)).alias("complaints_loaded"),
                   F.count_if(F.col("pickup_station_id").isNull()).alias("complaints_unresolved")) \
              .select(F.lit(monitoring_date).alias("monitoring_date"), "complaints_loaded",
                      "complaints_unresolved", lit_ts(run_ts).alias("updated_at"))


def upsert_by_date(old: DataFrame, new: DataFrame, key: str = "monitoring_date") -> DataFrame:
    """Upsert by date: the new row replaces an earlier one of the same day."""
    return old.join(new.select(key), key, "left_anti").unionByName(new.select(*old.columns))


def _metric(df: DataFrame, stage: str, system: str, metric: str, value: F.Column) -> DataFrame:
    return df.agg(value.cast("long").alias("value")).select(
        F.lit(stage).alias("stage"), F.lit(system).alias("source_system"), F.lit(metric).alias("metric"), "value")


def pipeline_volumes(ledger: DataFrame, staged_raw: dict, staged: dict, facts: dict,
                     complaints_view: DataFrame) -> DataFrame:
    """Volumes and quality per stage, one row per (stage, system, metric):
    files per status; rows read, kept, rejected as duplicates, with an
    unreadable event time (K14); rows loaded; complaints with and without a
    station. Each number is an aggregate; the table is small."""
    files = (ledger.groupBy("source_system", "status").agg(F.count(F.lit(1)).alias("value"))
             .select(F.lit("landing").alias("stage"), "source_system",
                     F.concat(F.lit("files_"), F.lower("status")).alias("metric"), "value"))
    parts = [files]
    for system, raw in staged_raw.items():
        kept = staged[system]
        tcol = "complained_at" if system == "complaints" else "delivered_at"
        parts.append(_metric(raw, "staging", system, "rows_read", F.count(F.lit(1))))
        parts.append(_metric(kept, "staging", system, "rows_kept", F.count(F.lit(1))))
        parts.append(_metric(kept, "staging", system, "rows_without_time", F.count_if(F.col(tcol).isNull())))
        parts.append(_rejected(raw, kept, system))
    for system, fact in facts.items():
        parts.append(_metric(fact, "dw", system, "rows_loaded", F.count(F.lit(1))))
    parts.append(_metric(complaints_view, "dw", "complaints", "complaints_linked",
                         F.count_if(F.col("pickup_station_id").isNotNull())))
    parts.append(_metric(complaints_view, "dw", "complaints", "complaints_unlinked",
                         F.count_if(F.col("pickup_station_id").isNull())))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _rejected(raw: DataFrame, kept: DataFrame, system: str) -> DataFrame:
    """Duplicates rejected by L10: raw rows minus kept rows (two global
    counts, tagged and summed)."""
    both = (raw.select(F.lit(1).alias("_s")).unionByName(kept.select(F.lit(-1).alias("_s"))))
    return _metric(both, "staging", system, "rows_rejected_duplicate", F.sum("_s"))
