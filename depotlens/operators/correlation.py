"""Complaint-delivery correlation and the views built on it.

S2 links each complaint to one delivery event: by parcel_id first, by
purchase_order_id only for complaints whose parcel has no delivery at all.
The delivery is the latest one not after the complaint (as-of join); when
every delivery of that parcel/order is later, the latest one. Ties in time
go to the greatest delivery record hash. Two equi-key steps, never an OR
join; deliveries are first reduced to the keys that complaints use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotlens.functions.text import epoch_micros
from depotlens.operators.asof import asof_join
from depotlens.operators.prefilter import may_match
from depotlens.session import written

_D_COLS = ["d_hash", "delivered_at", "driver_id"]


def _deliveries(deliveries: DataFrame) -> DataFrame:
    return deliveries.where(F.col("delivered_at").isNotNull()).select(
        F.col("record_hash_sha256").alias("d_hash"), "delivered_at", "driver_id", "parcel_id", "purchase_order_id")


def _step(c: DataFrame, d: DataFrame, key: str) -> DataFrame:
    """Complaints with the matched delivery by ``key`` (``m_*``, ``_has``)."""
    keys = c.select(key).where(F.col(key).isNotNull())
    d = may_match(d.select(key, *_D_COLS), keys, key).join(keys.distinct(), key)
    m = asof_join(c, d, key, "complained_at", "delivered_at", _D_COLS, tie="d_hash",
                  fallback_latest=True)
    return m.withColumnRenamed("m_found", "_has")


def complaint_delivery_link(complaints: DataFrame, deliveries: DataFrame) -> DataFrame:
    """One row per complaint with matched_by ('parcel' / 'purchase_order'
    / null), the delivery's hash, time and driver, and the delay in seconds."""
    c = complaints.select("record_hash_sha256", "complained_at", "parcel_id", "purchase_order_id")
    d = _deliveries(deliveries)
    # read twice below (matched / left for the order step): written once
    by_parcel = written(_step(c, d, "parcel_id"), "by-parcel")
    hit = by_parcel.where("_has").withColumn("matched_by", F.lit("parcel"))
    rest = by_parcel.where(~F.col("_has")).select(*c.columns)
    by_order = _step(rest, d, "purchase_order_id")
    by_order = by_order.withColumn("matched_by", F.when(F.col("_has"), F.lit("purchase_order")))
    both = hit.unionByName(by_order)
    delay = (epoch_micros(F.col("complained_at")) - epoch_micros(F.col("m_delivered_at"))) / F.lit(1000000.0)
    return both.select(*c.columns, "matched_by", F.col("m_d_hash").alias("delivery_record_hash"),
                       F.col("m_delivered_at").alias("delivered_at"), F.col("m_driver_id").alias("driver_id"),
                       delay.alias("delay_seconds"))


def _rate(num: str, den: str) -> F.Column:
    return F.when(F.col(den) > 0, F.col(num) / F.col(den)).alias("complaint_rate")


def complaint_rate(links: DataFrame, deliveries: DataFrame) -> DataFrame:
    """S3: per delivery month: deliveries, complaints traced to a delivery of
    that month (S2), and their ratio."""
    dm = (deliveries.where(F.col("delivered_at").isNotNull())
          .groupBy(F.trunc("delivered_at", "month").alias("delivery_month"))
          .agg(F.count(F.lit(1)).alias("deliveries")))
    cm = (links.where(F.col("delivery_record_hash").isNotNull())
          .groupBy(F.trunc("delivered_at", "month").alias("delivery_month"))
          .agg(F.count(F.lit(1)).alias("complaints")))
    j = dm.join(cm, "delivery_month", "full")
    j = j.select("delivery_month", F.coalesce("deliveries", F.lit(0)).alias("deliveries"),
                 F.coalesce("complaints", F.lit(0)).alias("complaints"))
    return j.select("*", _rate("complaints", "deliveries"))


def driver_complaints(links: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Per driver: deliveries, complaints traced to the driver's
    deliveries (S2), distinct complained parcels, and the ratio."""
    dd = deliveries.groupBy("driver_id").agg(F.count(F.lit(1)).alias("deliveries"))
    cd = (links.where(F.col("delivery_record_hash").isNotNull()).groupBy(F.col("driver_id").alias("_driver"))
          .agg(F.count(F.lit(1)).alias("complaints"),
               F.count_distinct("delivery_record_hash").alias("complained_deliveries")))
    # the unknown driver is one driver
    j = dd.join(cd, F.col("driver_id").eqNullSafe(F.col("_driver")), "full").select(
        F.coalesce("driver_id", "_driver").alias("driver_id"), F.coalesce("deliveries", F.lit(0)).alias("deliveries"),
        F.coalesce("complaints", F.lit(0)).alias("complaints"),
        F.coalesce("complained_deliveries", F.lit(0)).alias("complained_deliveries"))
    return j.select("*", _rate("complaints", "deliveries"))


def recipient_behavior(complaints: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Per normalised recipient (nulls form one group): deliveries,
    complaints and complaints per delivery. Both sides are aggregated before
    the (null-safe) full outer join."""
    keys = ["recipient_name_norm", "recipient_address_norm"]
    d = deliveries.groupBy(*keys).agg(F.count(F.lit(1)).alias("deliveries"))
    c = complaints.groupBy(*[F.col(k).alias("_c_" + k) for k in keys]).agg(F.count(F.lit(1)).alias("complaints"))
    cond = None
    for k in keys:
        e = F.col(k).eqNullSafe(F.col("_c_" + k))
        cond = e if cond is None else cond & e
    j = d.join(c, cond, "full")
    return j.select(*[F.coalesce(F.col(k), F.col("_c_" + k)).alias(k) for k in keys],
                    F.coalesce("deliveries", F.lit(0)).alias("deliveries"),
                    F.coalesce("complaints", F.lit(0)).alias("complaints")) \
            .select("*", _rate("complaints", "deliveries"))


def complaint_rate_limits(links: DataFrame, deliveries: DataFrame, z: float = 3.0) -> DataFrame:
    """S3: which stations' complaint ratios are abnormal, by delivery month.

    Per (month, station): deliveries, complained deliveries (S2), their ratio
    and its Wilson interval, against the month's ratio over all stations:
    'high' where the whole interval lies above it, 'low' where below, else
    'normal'. The fewer a station's deliveries, the wider its interval (funnel
    limits)."""
    complained = (links.where(F.col("delivery_record_hash").isNotNull())
                  .select(F.col("delivery_record_hash").alias("record_hash_sha256")).distinct())
    d = deliveries.where(F.col("delivered_at").isNotNull()).select(
        "record_hash_sha256", F.col("pickup_station_external_id").alias("station"),
        F.trunc("delivered_at", "month").alias("delivery_month"))
    # all deliveries are counted where they lie; only complained ones move by hash
    hit = may_match(d, complained, "record_hash_sha256").join(complained, "record_hash_sha256")
    keys, one, none = ["delivery_month", "station"], F.lit(1).cast("long"), F.lit(0).cast("long")
    per = d.select(*keys, one.alias("_d"), none.alias("_c")).unionByName(
        hit.select(*keys, none.alias("_d"), one.alias("_c"))).groupBy(*keys).agg(
        F.sum("_d").alias("deliveries"), F.sum("_c").alias("complained"))
    month = per.groupBy("delivery_month").agg(
        (F.sum("complained") / F.sum("deliveries")).alias("month_rate"))
    n, c, zz = F.col("deliveries").cast("double"), F.col("complained").cast("double"), z * z
    p = c / n
    middle, width, scale = p + zz / (2.0 * n), z * F.sqrt(p * (1.0 - p) / n + zz / (4.0 * n * n)), 1.0 + zz / n
    out = per.join(month, "delivery_month").select(
        "delivery_month", "station", "deliveries", "complained", p.alias("complaint_rate"), "month_rate",
        ((middle - width) / scale).alias("lower_limit"), ((middle + width) / scale).alias("upper_limit"))
    return out.withColumn("flag", F.when(F.col("lower_limit") > F.col("month_rate"), "high")
                          .when(F.col("upper_limit") < F.col("month_rate"), "low").otherwise("normal"))


#: leading bits that a delay keeps in the sketch: a relative error below 2^-6
SKETCH_BITS = 7


def delay_sketch(links: DataFrame) -> DataFrame:
    """Mergeable quantile sketch of delays as rows (complaint day, driver,
    bucket, n). A bucket is the delay in whole seconds cut to its leading bits
    (towards zero), so sketches of any days merge by adding n, and a quantile
    is off by less than one part in 64. At most some 60 * 64 buckets per sign,
    day and driver, whatever the number of complaints."""
    delay = F.col("delay_seconds").cast("long")
    size = F.abs(delay)
    drop = F.greatest(F.length(F.bin(size)) - SKETCH_BITS, F.lit(0))
    cut = F.call_function("shiftleft", F.call_function("shiftright", size, drop), drop)
    return (links.where(F.col("delay_seconds").isNotNull())
            .select(F.to_date("complained_at").alias("complaint_day"), "driver_id",
                    F.when(delay < 0, -cut).otherwise(cut).alias("bucket"))
            .groupBy("complaint_day", "driver_id", "bucket").agg(F.count(F.lit(1)).alias("n")))


def delay_quantiles(sketch: DataFrame, quantiles=(0.5, 0.9, 0.99), since=None, until=None) -> DataFrame:
    """Per driver the delays' quantiles over the days since..until (inclusive;
    None: unbounded), from the sketch alone."""
    from pyspark.sql import Window

    days = sketch
    if since is not None:
        days = days.where(F.col("complaint_day") >= F.lit(since))
    if until is not None:
        days = days.where(F.col("complaint_day") <= F.lit(until))
    merged = days.groupBy("driver_id", "bucket").agg(F.sum("n").alias("n"))
    own = Window.partitionBy("driver_id")
    held = merged.withColumn("total", F.sum("n").over(own)).withColumn(
        "upto", F.sum("n").over(own.orderBy("bucket")))
    # the first bucket that reaches the rank
    return held.groupBy("driver_id").agg(
        F.max("total").alias("delays"),
        *[F.min(F.when(F.col("upto") >= F.ceil(F.col("total") * q), F.col("bucket"))).alias(f"p{round(100 * q)}_seconds")
          for q in quantiles])


def missing_deliveries(links: DataFrame) -> DataFrame:
    """Complained parcels without a delivery event of their own: how
    often and when they were complained about, and whether another parcel of
    the purchase order was delivered."""
    m = links.where(F.col("parcel_id").isNotNull() & ~F.col("matched_by").eqNullSafe(F.lit("parcel")))
    return m.groupBy("parcel_id").agg(
        F.count(F.lit(1)).alias("complaints"), F.min("complained_at").alias("first_complained_at"),
        F.max("complained_at").alias("last_complained_at"),
        F.max(F.coalesce(F.col("matched_by") == "purchase_order", F.lit(False))).alias("order_delivered"))
