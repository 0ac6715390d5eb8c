"""Pipeline inputs derived from the driver's test tables.

The derivations are the ones fixed in FIXTURES.md section 3 (station lists
from supplier/nation, complaints from error events/customer, deliveries from
lineitem/orders/customer). Everything is a lazy DataFrame over the parquet
tables, so the work grows with the scale factor.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the test scenario.
AS_OF = dt.date(2024, 1, 31)
DAY1 = dt.date(2024, 1, 30)
DAY2 = dt.date(2024, 1, 31)
RUN1 = dt.datetime(2024, 1, 30, 23, 0, 0)
RUN2 = dt.datetime(2024, 1, 31, 23, 0, 0)
FORMATS = ["csv", "json", "xml"]
FILE_BLOCK_BYTES = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """The derived input dealt out evenly (a test table may be one row group,
    which one task would read and derive alone)."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def station_list_day1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference station list as received on day 1 (plus s_suppkey for tests)."""
    sup = table(spark, sf_dir, "supplier")
    nat = table(spark, sf_dir, "nation")
    return (sup.join(nat, nat.n_nationkey == sup.s_nationkey)
            .select(F.concat(F.lit("PS"), _s("s_suppkey")).alias("identifier"),
                    F.col("s_name").alias("name"), F.col("n_name").alias("city"),
                    F.lpad(_s("s_nationkey"), 5, "0").alias("zip_code"),
                    F.concat(F.lit("Street "), _s("s_suppkey")).alias("street"),
                    "s_suppkey"))


def station_list_day2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day-2 list. Class by s_suppkey % 10: 0 removed, 1 renamed, 2 new
    identifier at the same address, 3 unchanged plus one new station."""
    st1 = station_list_day1(spark, sf_dir)
    cls = F.col("s_suppkey") % 10
    kept = st1.where(cls != 0).select(
        F.when(cls == 2, F.concat(F.lit("PSX"), _s("s_suppkey"))).otherwise(F.col("identifier")).alias("identifier"),
        F.when(cls == 1, F.concat(F.col("name"), F.lit(" NEW"))).otherwise(F.col("name")).alias("name"),
        "city", "zip_code", "street", "s_suppkey")
    added = st1.where(cls == 3).select(
        F.concat(F.lit("PSN"), _s("s_suppkey")).alias("identifier"), "name", "city", "zip_code",
        F.concat(F.lit("New Street "), _s("s_suppkey")).alias("street"), "s_suppkey")
    return kept.unionByName(added)


def partner_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Another system's station list: every day-1 station with faults by
    s_suppkey (name: % 4 lower case, a lost vowel, another name; zip: % 5
    missing or wrong; street: % 3 other spelling; number: % 7 another one), and
    for each sixth one a station that is not in the reference list, in the same
    zip and with the same house number. Columns as the station list, identifier
    as the delivery events give it, and the true reference (null: none)."""
    st = station_list_day1(spark, sf_dir)
    k, nation = F.col("s_suppkey"), F.col("zip_code").cast("int")
    known = st.select(
        F.concat(F.lit("S-"), F.lpad(_s(F.when(k % 7 == 6, k + 500000).otherwise(k)), 6, "0")).alias("identifier"),
        F.when(k % 4 == 1, F.lower("name")).when(k % 4 == 2, F.replace(F.col("name"), F.lit("i"), F.lit("")))
        .when(k % 4 == 3, F.concat(F.lit("Depot "), _s(k * 3))).otherwise(F.col("name")).alias("name"),
        F.when(k % 5 == 0, F.lit(None)).when(k % 5 == 1, F.lpad(_s((nation + 1) % 25), 5, "0"))
        .otherwise(F.col("zip_code")).alias("zip_code"),
        F.when(k % 3 == 1, F.concat(F.lit("STREET  "), _s(k))).when(k % 3 == 2, F.concat(F.lit("Str. "), _s(k)))
        .otherwise(F.col("street")).alias("street"),
        F.col("identifier").alias("true_ref"))
    strange = st.where(k % 6 == 0).select(
        F.concat(F.lit("S-9"), F.lpad(_s(k), 6, "0")).alias("identifier"), F.concat(F.lit("Partner Depot "), _s(k)).alias("name"),
        "zip_code", F.concat(F.lit("Harbour "), _s(k)).alias("street"), F.lit(None).cast("string").alias("true_ref"))
    return known.unionByName(strange)


def complaint_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One complaint per 'error' event, with the file it arrives in.

    Columns: event_id, received_at, ingest_dt, source_format, then the
    complaint record fields.
    """
    ev = table(spark, sf_dir, "events")
    cust = table(spark, sf_dir, "customer")
    n_sup = table(spark, sf_dir, "supplier").select(F.count(F.lit(1))).scalar()
    n_ord = table(spark, sf_dir, "orders").select(F.count(F.lit(1))).scalar()
    e = F.col("event_id")
    po = _s(e % n_ord)
    station = (F.when(e % 11 == 10, F.concat(F.lit("XX"), _s(e % 3)))
               .when(e % 11 == 9, F.lit(None).cast("string"))
               .otherwise(F.concat(F.lit("PS"), _s((F.col("user_id") * 7 + e % 3) % n_sup))))
    name = F.when(e % 2 == 0, F.col("c_name")).otherwise(F.concat(F.lit(" "), F.lower("c_name")))
    parcel = F.concat(po, F.lit("-"), _s(e % 7 + 1))
    return (spread(ev.where(F.col("event_type") == "error"))
            .join(cust, cust.c_custkey == ev.user_id)
            .select(
                "event_id",
                F.col("ts").alias("received_at"),
                F.to_date("ts").alias("ingest_dt"),
                F.element_at(F.array(*[F.lit(x) for x in FORMATS]), (e % 3 + 1).cast("int")).alias("source_format"),
                (F.col("ts") - F.make_dt_interval(((e % 4) * 25).cast("int"))).alias("complained_at"),
                station.alias("pickup_station_external_id"),
                name.alias("recipient_name"),
                F.concat(F.col("c_mktsegment"), F.lit(" "), _s("c_nationkey")).alias("recipient_address"),
                parcel.alias("parcel_id"),
                po.alias("purchase_order_id"),
                F.concat(F.lit("Parcel "), parcel, F.lit(" late "), F.coalesce("props", F.lit(""))).alias("complaint_text"),
            ))


def delivery_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per lineitem row, with the order's customer: what the delivery
    records are made of.

    Each order gets its customer before the line items, which move once, for
    the merge join (hinted, which also deals them out where the table is one
    row group).
    """
    li = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    recipients = orders.join(cust, orders.o_custkey == cust.c_custkey, "left")
    j = li.join(recipients.hint("merge"), li.l_orderkey == F.col("o_orderkey"), "left")
    return j.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate", "c_name", "c_mktsegment", "c_nationkey")


def delivery_fields() -> dict[str, Column]:
    """The fields of a delivery record and its file, from ``delivery_rows``."""
    return {
        "ingest_dt": F.trunc("l_shipdate", "month"),
        "source_format": F.element_at(F.array(*[F.lit(x) for x in FORMATS]), (F.col("l_linenumber") % 3 + 1).cast("int")),
        "delivered_at": F.col("l_shipdate"),
        "pickup_station_external_id": F.concat(F.lit("S-"), F.lpad(_s("l_suppkey"), 6, "0")),
        "driver_id": F.concat(F.lit("D"), _s(F.col("l_suppkey") % 7)),
        "parcel_id": F.concat(_s("l_orderkey"), F.lit("-"), _s("l_linenumber")),
        "purchase_order_id": _s("l_orderkey"),
        "recipient_name": F.col("c_name"),
        "recipient_address": F.concat(F.col("c_mktsegment"), F.lit(" "), _s("c_nationkey")),
    }


def with_delivery_fields(rows: DataFrame) -> DataFrame:
    """The delivery records: columns for the file order, ingest_dt (month of
    the ship date), source_format, then the delivery record fields."""
    order = [c for c in DELIVERY_FILE_ORDER if c != "delivered_at"]
    return rows.select(*order, *[c.alias(name) for name, c in delivery_fields().items()])


def delivery_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One delivery event per lineitem row; recipient from the order's customer."""
    return with_delivery_fields(delivery_rows(spark, sf_dir))


# Total order of records inside one derived file (ties impossible up to full equality).
COMPLAINT_FILE_ORDER = ["event_id"]
DELIVERY_FILE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                       "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                       "delivered_at"]


def file_name(system: str) -> Column:
    return F.concat(F.lit(system + "_"), F.date_format("ingest_dt", "yyyyMMdd"), F.lit("."), F.col("source_format"))


def derived_listing(records: DataFrame, system: str, time_col: str) -> DataFrame:
    """File listing of the derived files: one file per (ingest_dt, format).

    Returns the listing columns plus ingest_dt and source_format.
    """
    fname = file_name(system)
    return (records.groupBy("ingest_dt", "source_format")
            .agg(F.max(time_col).alias("source_modified_at"),
                 (F.count(F.lit(1)) * FILE_BLOCK_BYTES).alias("file_size_bytes"))
            .select(F.lit(system).alias("source_system"),
                    F.concat(F.lit(f"//fileserver/incoming/{system}/"), fname).alias("source_file_path"),
                    "source_modified_at", "file_size_bytes",
                    F.concat(F.lit(f"landing/{system}/ingest_dt="), F.date_format("ingest_dt", "yyyy-MM-dd"),
                             F.lit("/"), fname).alias("landing_file_path"),
                    "ingest_dt", "source_format"))


def resent_listing(listing: DataFrame) -> DataFrame:
    """The files of the last ingest day, exported again one hour later with
    one more block: same path, new time and size, so a new ledger entry."""
    last = listing.select(F.max("ingest_dt")).scalar()
    return (listing.where(F.col("ingest_dt") == last)
            .withColumn("source_modified_at", F.col("source_modified_at") + F.expr("INTERVAL 1 HOUR"))
            .withColumn("file_size_bytes", F.col("file_size_bytes") + FILE_BLOCK_BYTES))
