"""Alert episodes (S7): when a station's complaints breach a limit, from the
first breach to the last.

A breach is a station-day with more complaints than the threshold. Breaches at
most ``quiet`` days apart belong to one episode; an episode stays open until
``quiet`` days have passed since its last breach. Episodes are intervals with
additive measures, so the state of earlier days and the breaches of a new day
merge by the same rule: a run reads the new day's facts and the episodes of the
stations they touch, not the history.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

STATION = "pickup_station_id"
COLUMNS = [STATION, "episode_start", "episode_last", "breach_days", "complaints", "peak"]


def breaches(fact: DataFrame, links: DataFrame, threshold: int) -> DataFrame:
    """Station-days above the threshold, as episodes of one day."""
    daily = (fact.where(F.col("complained_date").isNotNull()).select("record_hash_sha256", "complained_date")
             .join(links.select("record_hash_sha256", STATION), "record_hash_sha256")
             .groupBy(STATION, "complained_date").agg(F.count("*").alias("complaints")))
    day = F.col("complained_date")
    return daily.where(F.col("complaints") > threshold).select(
        STATION, day.alias("episode_start"), day.alias("episode_last"), F.lit(1).cast("long").alias("breach_days"),
        "complaints", F.col("complaints").alias("peak"))


def merge(intervals: DataFrame, quiet: int) -> DataFrame:
    """Episodes from intervals that may touch (gaps and islands, by station;
    a station has at most one interval per day and state)."""
    before = Window.partitionBy(STATION).orderBy("episode_start", "episode_last").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(STATION).orderBy("episode_start", "episode_last").rowsBetween(Window.unboundedPreceding, 0)
    gap = F.date_diff("episode_start", F.max("episode_last").over(before))
    marked = intervals.withColumn("_new", F.when(gap <= quiet, 0).otherwise(1))
    numbered = marked.withColumn("_island", F.sum("_new").over(upto))
    return numbered.groupBy(STATION, "_island").agg(
        F.min("episode_start").alias("episode_start"), F.max("episode_last").alias("episode_last"),
        F.sum("breach_days").alias("breach_days"), F.sum("complaints").alias("complaints"),
        F.max("peak").alias("peak")).select(*COLUMNS)


def advance(state: DataFrame | None, new: DataFrame, quiet: int) -> DataFrame:
    """The episodes after the breaches ``new`` (station-days not counted yet,
    also late ones of earlier days). Stations without new breaches keep their
    rows as they are."""
    if state is None:
        return merge(new, quiet)
    touched = new.select(STATION).distinct()
    merged = merge(state.join(touched, STATION, "left_semi").select(*COLUMNS).unionByName(new.select(*COLUMNS)), quiet)
    return state.join(touched, STATION, "left_anti").select(*COLUMNS).unionByName(merged)


def with_status(state: DataFrame, day: dt.date, quiet: int) -> DataFrame:
    """is_open: fewer than ``quiet`` full days have passed since the last breach."""
    return state.withColumn("is_open", F.date_diff(F.lit(day), F.col("episode_last")) <= quiet)
