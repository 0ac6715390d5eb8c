"""Station mapping for identifiers of other systems.

Delivery events carry station identifiers that do not equal the reference
identifiers ('S-000042' versus 'PS42'). Mapping, per distinct external id:
1. a crosswalk table (external_id -> ref_identifier), when given, wins;
2. otherwise candidates are the current stations with the same number
   (digits at the end, leading zeros dropped; the blocking key), scored by
   the edit distance of the letter parts; the lowest score wins, ties by
   the smaller reference identifier. A score above ``MAX_DISTANCE`` times the
   longer letter part is no match.
Candidates are compared as distinct (number, letters) patterns, all of them
(no cap): identifiers and stations sharing a pattern cost one row, and the
best candidate is chosen by a partial aggregate (min_by).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotlens.operators.station_dim import current_rows


#: largest edit distance of the letter parts, relative to the longer one
MAX_DISTANCE = 0.6


def _norm(c: str) -> F.Column:
    return F.upper(F.regexp_replace(F.col(c), "[^A-Za-z0-9]", ""))


def _parts(df: DataFrame, c: str, p: str) -> DataFrame:
    n = _norm(c)
    return (df.withColumn(p + "num", F.regexp_extract(n, "([0-9]+)$", 1).try_cast("bigint"))
              .withColumn(p + "letters", F.regexp_replace(n, "[0-9]+$", "")))


def match_stations(external_ids: DataFrame, dim: DataFrame, crosswalk: DataFrame | None = None) -> DataFrame:
    """(external_id, pickup_station_id, ref_identifier, match_method, score)
    for every distinct non-null external id; unmatched ids have nulls."""
    # distinct identifiers (few: one per identifier, not per event) are read
    # three times below: computed once and written
    ids = (external_ids.select(F.col(external_ids.columns[0]).alias("external_id"))
           .where(F.col("external_id").isNotNull()).distinct().checkpoint(eager=True))
    cur = current_rows(dim).select("pickup_station_id", "ref_identifier")
    x = _parts(ids, "external_id", "x_")
    s = _parts(cur, "ref_identifier", "s_")
    # The score depends only on the letter parts, so distinct patterns are
    # compared, not identifiers: per (number, letters) the station pattern
    # keeps its smallest reference. A number shared by many stations or ids
    # costs one row per distinct pattern.
    x_pat = x.where(F.col("x_num").isNotNull()).select("x_num", "x_letters").distinct()
    s_pat = (s.where(F.col("s_num").isNotNull()).groupBy("s_num", "s_letters")
             .agg(F.min_by(F.struct("pickup_station_id", "ref_identifier"), F.col("ref_identifier")).alias("_st")))
    cand = (x_pat.join(s_pat, F.col("x_num") == F.col("s_num"))
            .withColumn("score", F.levenshtein("x_letters", "s_letters"))
            .where(F.col("score") <= MAX_DISTANCE * F.greatest(F.length("x_letters"), F.length("s_letters"))))
    best_pat = (cand.groupBy("x_num", "x_letters")
                .agg(F.min_by(F.struct(F.col("_st.pickup_station_id").alias("pickup_station_id"),
                                       F.col("_st.ref_identifier").alias("ref_identifier"), "score"),
                              F.struct("score", F.col("_st.ref_identifier"))).alias("_b")))
    best = (x.join(best_pat, ["x_num", "x_letters"])
            .select("external_id", "_b.pickup_station_id", "_b.ref_identifier", "_b.score",
                    F.lit("fuzzy").alias("match_method")))
    if crosswalk is not None:
        cw = (crosswalk.select("external_id", "ref_identifier").join(cur, "ref_identifier")
              # an id with several references: one station, by the smallest reference
              .groupBy("external_id").agg(F.min_by(F.struct("pickup_station_id", "ref_identifier"), F.struct(
                  "ref_identifier", "pickup_station_id")).alias("_cw"))
              .select("external_id", "_cw.pickup_station_id", "_cw.ref_identifier",
                      F.lit(None).cast("int").alias("score"), F.lit("crosswalk").alias("match_method")))
        best = cw.unionByName(best.join(cw.select("external_id"), "external_id", "left_anti"))
    out = ids.join(best, "external_id", "left")
    return out.select("external_id", "pickup_station_id", "ref_identifier", "match_method", "score")
