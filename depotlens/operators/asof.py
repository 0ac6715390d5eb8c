"""As-of join: for each left row, the latest right row of the same key whose
time is not after the left row's time.

Spark has no as-of join, and a window partitioned by the key alone puts a
hot key (one parcel, one station) into a single task. Keys whose size is
checked to be bounded use that window; otherwise this plan never does:

1. Left and right rows are tagged and range-partitioned on (key, time,
   side, tie), then sorted inside each partition. A hot key is cut into
   several consecutive *segments* (one per range partition).
2. Inside a segment, a window over (segment, key) takes the last right row
   before each left row. A segment is at most one range partition.
3. The last right row of every earlier segment of the same key is carried
   in: one row per (segment, key), windowed per key, so at most
   ``num_partitions`` rows per key.

The tagged rows are written once (shared folder), so both branches
see the same range bounds, also after a lost executor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from depotlens.session import written


def asof_join(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str,
              right_cols: list[str], tie: str, prefix: str = "m_",
              num_partitions: int | None = None, fallback_latest: bool = False) -> DataFrame:
    """Left rows plus ``prefix + c`` for each of ``right_cols`` from the
    matching right row (null when none). Among right rows with the same
    time, the one with the greatest ``tie`` wins. Left rows with a null key
    or time get no match.

    ``fallback_latest``: when no right row is at or before the left time,
    take the latest right row of the key instead; ``prefix + "found"`` tells
    whether the key has any right row. Both come from a second frame over
    the same window, so no extra shuffle or join."""
    lcols = left.columns
    r_struct = F.struct(*[F.col(c).alias(c) for c in right_cols])
    r_type = right.select(r_struct.alias("r")).schema["r"].dataType
    l_type = left.select(F.struct(*lcols).alias("l")).schema["l"].dataType
    ok_left = F.col(key).isNotNull() & F.col(left_time).isNotNull()
    lt = left.where(ok_left).select(
        F.col(key).alias("_k"), F.col(left_time).cast("timestamp_ntz").alias("_t"), F.lit(1).alias("_side"),
        F.lit(None).cast(right.schema[tie].dataType).alias("_tb"),
        F.struct(*lcols).alias("_l"), F.lit(None).cast(r_type).alias("_r"))
    rt = right.where(F.col(key).isNotNull() & F.col(right_time).isNotNull()).select(
        F.col(key).alias("_k"), F.col(right_time).cast("timestamp_ntz").alias("_t"), F.lit(0).alias("_side"),
        F.col(tie).alias("_tb"), F.lit(None).cast(l_type).alias("_l"), r_struct.alias("_r"))
    order = ["_k", "_t", "_side", "_tb"]
    rest = left.where(~ok_left | ok_left.isNull()).select(
        *lcols, *[F.lit(None).cast(right.schema[c].dataType).alias(prefix + c) for c in right_cols])
    if fallback_latest:
        rest = rest.withColumn(prefix + "found", F.lit(False))

    def finish(got: DataFrame, hit, latest) -> DataFrame:
        if fallback_latest:
            got = got.withColumn("_hit", F.coalesce(hit, latest)).withColumn(prefix + "found", latest.isNotNull())
        else:
            got = got.withColumn("_hit", hit)
        extra = [prefix + "found"] if fallback_latest else []
        got = got.select(*lcols, *[F.col("_hit")[c].alias(prefix + c) for c in right_cols], *extra)
        return got.unionByName(rest)

    both = lt.unionByName(rt)
    # without a number, adaptive execution sizes the segments: few rows become one
    dealt = both.repartitionByRange(num_partitions, *order) if num_partitions else both.repartitionByRange(*order)
    u = (dealt.sortWithinPartitions(*order)
         .withColumn("_m", F.monotonically_increasing_id())
         .withColumn("_seg", F.shiftright("_m", 33)))
    u = written(u, "asof")

    upto = Window.partitionBy("_seg", "_k").orderBy("_m").rowsBetween(Window.unboundedPreceding, 0)
    local = (u.withColumn("_loc", F.last("_r", ignorenulls=True).over(upto))
             .where(F.col("_side") == 1).select("_seg", "_k", "_l", "_loc"))
    seg_last = (u.groupBy("_seg", "_k")
                .agg(F.max_by("_r", F.when(F.col("_side") == 0, F.col("_m"))).alias("_last")))
    by_seg = Window.partitionBy("_k").orderBy("_seg")
    carry = seg_last.select(
        "_seg", "_k",
        F.last("_last", ignorenulls=True).over(by_seg.rowsBetween(Window.unboundedPreceding, -1)).alias("_carry"),
        F.last("_last", ignorenulls=True).over(
            by_seg.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_lat"))
    got = (local.join(carry, ["_seg", "_k"], "left")
           .select("_l.*", F.coalesce("_loc", "_carry").alias("_h"), "_lat"))
    return finish(got, F.col("_h"), F.col("_lat"))
