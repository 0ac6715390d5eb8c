"""Fact rows are numbered and written where the staged rows lie (round 4:
disk findings), with the same results."""

from pyspark.sql import functions as F

from depotlens.operators.facts import check_unique_hash
from depotlens.operators.ids import PLACES, assign_ids, ids_by_place
from depotlens.plans.pipeline import metrics_of
from depotlens.session import written
from depotlens.sources import testdata as td
from depotlens.sources.store import Store, lie_by


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def numbered(df, start=0):
    return sorted(tuple(r) for r in ids_by_place(df, "f", "p", "n", start).select("f", "p", "n").collect())


def test_ids_by_place_are_those_of_assign_ids(spark):
    gaps = [(2, i) for i in range(2 * PLACES + 10) if i not in (0, 7, PLACES, PLACES + 1)]
    rows = [(1, 5), (3, 0), (3, 3 * PLACES), (9, 0), *gaps]
    df = written(spark.createDataFrame(rows, "f long, p int").repartition(3))
    want = sorted(tuple(r) for r in assign_ids(df, ["f", "p"], "n", start=40).select("f", "p", "n").collect())
    assert numbered(df, 40) == want
    assert [n for _, _, n in want] == list(range(41, 41 + len(rows)))
    assert "hashpartitioning" not in plan(ids_by_place(df, "f", "p", "n"))


def test_ids_by_place_of_shared_places_and_of_no_rows(spark):
    # as many rows as the run from 0 to 3 has, but not its places
    df = spark.createDataFrame([(1, 0), (1, 0), (1, 3), (1, 3)], "f long, p int")
    assert numbered(df) == [(1, 0, 1), (1, 0, 2), (1, 3, 3), (1, 3, 4)]
    assert numbered(df.limit(0)) == []


def test_unique_hash_moves_short_numbers(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,), (None,), ("c",)], "record_hash_sha256 string")
    assert tuple(check_unique_hash(df).first()) == (6, 4, 2)
    assert tuple(check_unique_hash(df.where("record_hash_sha256 in ('b', 'c')")).first()) == (2, 2, 0)
    assert tuple(check_unique_hash(df.limit(0)).first()) == (0, 0, 0)
    # whole hashes are grouped behind the choice of the suspects alone
    assert "BroadcastHashJoin [_short" in plan(check_unique_hash(written(df)))


def test_rows_that_lie_by_partition_are_not_dealt(spark, tmp_path):
    df = spark.range(8000).select((F.col("id") / 1000).cast("int").alias("month"), "id")
    lying = written(df.repartitionByRange(8, "month"))
    mixed = spark.range(0, 8000, 1, 16).withColumn("month", (F.col("id") % 400).cast("int"))
    assert lie_by(lying, "month") and not lie_by(mixed, "month")
    got = Store(spark, str(tmp_path / "store")).append("t", lying, partition_by=["month"], deal=False)
    assert sorted(tuple(r) for r in got.select("month", "id").collect()) == sorted(tuple(r) for r in lying.select("month", "id").collect())


def test_delivery_records_are_made_of_the_joined_rows(spark, tmp_path):
    import datetime as dt
    t = dt.datetime(2024, 3, 5)
    spark.createDataFrame([(1, 2, 3, 2, 1.0, 2.0, 0.0, 0.0, "N", "O", t)], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                          "l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                          "l_shipdate timestamp_ntz").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(1, 4)], "o_orderkey long, o_custkey long").write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame([(4, "Ann", "TOYS", 7)], "c_custkey long, c_name string, c_mktsegment string, c_nationkey int").write.parquet(
        str(tmp_path / "customer.parquet"))
    rows = td.delivery_rows(spark, str(tmp_path))
    assert "parcel_id" not in rows.columns
    r = td.delivery_records(spark, str(tmp_path)).first()
    assert (r.ingest_dt, r.source_format, r.delivered_at, r.pickup_station_external_id, r.driver_id, r.parcel_id, r.purchase_order_id,
            r.recipient_name, r.recipient_address) == (dt.date(2024, 3, 1), "xml", t, "S-000003", "D3", "1-2", "1", "Ann", "TOYS 7")


def test_metrics_of_rows_that_turn_out_empty(spark, tmp_path):
    from pyspark.sql import Observation
    seen = Observation()
    none = spark.range(10).repartition(2).where("id > 100").join(spark.range(5).repartition(2), "id")
    none.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(str(tmp_path / "none"))
    assert not metrics_of(seen).get("n")
