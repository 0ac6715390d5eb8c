"""Wide rows stay where they are also where Spark would broadcast little
(round 5: disk findings), with the same results."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from depotlens.operators import correlation, prefilter
from depotlens.operators.ids import PLACES, assign_ids, ids_by_place
from depotlens.operators.prefilter import may_match
from depotlens.operators.staging import dedupe_staged
from depotlens.session import written

T = dt.datetime(2024, 3, 1)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def little(spark):
    """A session that broadcasts nothing by itself."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield spark
    spark.conf.set(name, old)


def test_numbered_rows_do_not_move(little):
    df = written(little.range(3 * PLACES).select(F.lit(1).cast("long").alias("f"), F.col("id").cast("int").alias("p")).where("p % 5000 != 7"))
    got = ids_by_place(df, "f", "p", "n")
    assert "SortMergeJoin" not in plan(got)
    want = assign_ids(df, ["f", "p"], "n")
    assert sorted(map(tuple, got.select("f", "p", "n").collect())) == sorted(map(tuple, want.select("f", "p", "n").collect()))


def test_deduplicated_rows_do_not_move(little):
    rows = [(h, 1, i) for i, h in enumerate("abcabd")] + [(None, 1, 9)]
    got = dedupe_staged(written(little.createDataFrame(rows, "record_hash_sha256 string, file_id long, record_index int")))
    assert sorted(map(tuple, got.collect())) == [("a", 1, 0), ("b", 1, 1), ("c", 1, 2), ("d", 1, 5)]
    assert "SortMergeJoin" not in plan(got)


def test_may_match_keeps_all_matches_and_few_others(little, monkeypatch):
    rows = little.range(200000).select(F.when(F.col("id") != 5, F.col("id").cast("string")).alias("k"), "id")
    keys = little.range(0, 40000, 20).select(F.col("id").cast("string").alias("k")).unionByName(little.createDataFrame([(None,)], "k string"))
    got = may_match(rows, keys, "k")
    assert "SortMergeJoin" not in plan(got) and got.columns == ["k", "id"]
    assert got.join(keys, "k", "left_semi").count() == 2000
    assert got.count() < 2000 + 198000 / 8
    assert may_match(rows, keys.limit(0), "k").count() == 0
    monkeypatch.setattr(prefilter, "MOST_BITS", 100)  # too many keys: no filter
    assert may_match(rows, keys, "k").count() == 199999


def test_deliveries_without_complaints_do_not_move(little):
    """Neither step of the link shuffles deliveries that cannot match."""
    d = [(f"d{i}", f"p{i}", f"o{i}", T, "D1", f"S{i % 2}") for i in range(500)] + [(None, "p1", "o1", T, None, None)]
    d = written(little.createDataFrame(d, "record_hash_sha256 string, parcel_id string, purchase_order_id string, delivered_at timestamp_ntz, "
                                          "driver_id string, pickup_station_external_id string"))
    c = written(little.createDataFrame([("a", T, "p7", "o7"), ("b", T, "-", "o9"), ("c", T, None, None)],
                                       "record_hash_sha256 string, complained_at timestamp_ntz, parcel_id string, purchase_order_id string"))
    s2 = written(correlation.complaint_delivery_link(c, d))
    assert {(r.record_hash_sha256, r.matched_by, r.delivery_record_hash) for r in s2.collect()} == {
        ("a", "parcel", "d7"), ("b", "purchase_order", "d9"), ("c", None, None)}
    out = correlation.complaint_rate_limits(s2, d)
    # the deliveries are joined by hash behind the filter alone (the tree is printed from the top)
    tree = out._jdf.queryExecution().optimizedPlan().toString()
    assert -1 < tree.find("(record_hash_sha256") < tree.find("_bits")
    assert {(r.station, r.deliveries, r.complained) for r in out.collect()} == {("S0", 250, 0), ("S1", 250, 2), (None, 1, 0)}
