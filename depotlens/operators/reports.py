"""Reports R1, R2 and threshold alerts.

Reports join complaints to *current* station rows only, as the reference
does (K10): complaints of removed stations drop out of R1 and show no
enriched text in R2. Windows have a lower bound only, so future times count.
The window filter is written on the event time (pushed to the parquet scan)
and repeated on the month partition column (partition pruning).
"""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotlens.functions.text import station_label
from depotlens.operators.station_dim import current_rows

R2_MIN_COMPLAINTS = 5      # more than five complaints
R2_MONTHS = 2
R1_DAYS = 14


def _window(fact: DataFrame, links: DataFrame | None, lower: dt.date):
    ts = F.lit(lower.isoformat()).cast("timestamp_ntz")
    month = F.lit(lower.replace(day=1))
    f = fact.where((F.col("complained_at") >= ts) & (F.col("complained_month") >= month))
    lk = None
    if links is not None:
        lk = links.where((F.col("complained_date") >= F.lit(lower)) & (F.col("complained_month") >= month)) \
                  .select("record_hash_sha256", "pickup_station_id")
    return f, lk


def station_claims(fact: DataFrame, links: DataFrame, dim: DataFrame, as_of: dt.date,
                   days: int = R1_DAYS) -> DataFrame:
    """Complaints per current station since as_of - days (inclusive)."""
    lower = as_of - dt.timedelta(days=days)
    f, lk = _window(fact, links, lower)
    cur = current_rows(dim).select("pickup_station_id", "ref_identifier", "name", "zip_code")
    return (f.select("record_hash_sha256").join(lk, "record_hash_sha256")
            .join(cur, "pickup_station_id")
            .groupBy("ref_identifier", "name", "zip_code")
            .agg(F.count(F.lit(1)).alias("claims_last_14_days"))
            .select(F.col("ref_identifier").alias("pickup_identifier"), "name", "zip_code",
                    "claims_last_14_days"))


def _joined_list(c) -> F.Column:
    s = F.collect_set(c)
    return F.when(F.size(s) == 0, F.lit(None).cast("string")).otherwise(F.array_join(F.sort_array(s), " | "))


def frequent_recipients(fact: DataFrame, links: DataFrame | None, dim: DataFrame, as_of: dt.date,
                        months: int = R2_MONTHS, min_count: int = R2_MIN_COMPLAINTS) -> DataFrame:
    """R2: recipients (normalised name and address; nulls group together)
    with more than ``min_count`` complaints since as_of - months. Lists are
    distinct, sorted by bytes, joined by ' | ', null when empty.

    collect_set merges partially on the map side and is bounded by the
    number of stations, so one very frequent recipient stays small."""
    lower_date = _months_back(as_of, months)
    f, lk = _window(fact, links, lower_date)
    f = f.select("record_hash_sha256", "recipient_name", "recipient_address",
                 "recipient_name_norm", "recipient_address_norm", "pickup_station_external_id")
    if lk is not None:
        f = f.join(lk, "record_hash_sha256", "left")
    else:
        f = f.withColumn("pickup_station_id", F.lit(None).cast("long"))
    cur = current_rows(dim).select("pickup_station_id", station_label().alias("_label"))
    # unlinked complaints (null id) skip the join: no null-key hot spot
    linked = f.where(F.col("pickup_station_id").isNotNull()).join(cur, "pickup_station_id", "left")
    j = linked.unionByName(f.where(F.col("pickup_station_id").isNull())
                           .withColumn("_label", F.lit(None).cast("string")))
    return (j.groupBy("recipient_name_norm", "recipient_address_norm")
            .agg(F.min("recipient_name").alias("recipient_name"),
                 F.min("recipient_address").alias("recipient_address"),
                 F.count(F.lit(1)).alias("complaints_2m"),
                 _joined_list("pickup_station_external_id").alias("pickup_locations_given"),
                 _joined_list("_label").alias("pickup_locations_enriched"))
            .where(F.col("complaints_2m") > min_count)
            .select("recipient_name", "recipient_address", "complaints_2m",
                    "pickup_locations_given", "pickup_locations_enriched"))


def _months_back(d: dt.date, months: int) -> dt.date:
    """date - N months, clamped to the month's last day (as add_months)."""
    y, m = divmod(d.year * 12 + (d.month - 1) - months, 12)
    m += 1
    return dt.date(y, m, min(d.day, calendar.monthrange(y, m)[1]))


def complaint_alerts(fact: DataFrame, links: DataFrame, dim: DataFrame, as_of: dt.date,
                     threshold: int = 1, days: int = R1_DAYS) -> DataFrame:
    """(current station, complaint day) pairs in the report window whose
    complaint count is above ``threshold``. The output is the alert table a
    notifier would read."""
    lower = as_of - dt.timedelta(days=days)
    f, lk = _window(fact, links, lower)
    cur = current_rows(dim).select("pickup_station_id", "ref_identifier", "name", "zip_code")
    return (f.select("record_hash_sha256", "complained_date").join(lk, "record_hash_sha256")
            .groupBy("pickup_station_id", "complained_date")
            .agg(F.count(F.lit(1)).alias("complaints"))
            .where(F.col("complaints") > threshold)
            .join(cur, "pickup_station_id")
            .select(F.col("ref_identifier").alias("pickup_identifier"), "name", "zip_code",
                    F.col("complained_date").alias("complaint_date"), "complaints",
                    F.lit(threshold).cast("long").alias("threshold")))
