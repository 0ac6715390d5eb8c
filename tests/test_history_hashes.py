"""Station history stored by changes (D10, D11) and bucketed staged hashes."""

import datetime as dt
import os

from pyspark.sql import functions as F

from depotlens.operators import station_dim as sd
from depotlens.operators.staging import dedupe_staged
from depotlens.plans.pipeline import HASH, Pipeline
from depotlens.sources.store import Store

STATION = "identifier string, name string, city string, zip_code string, street string"
DAYS = [dt.date(2024, 1, 30) + dt.timedelta(days=i) for i in range(4)]
LISTS = [
    [("A", "a", "c", "1", "s1"), ("B", "b", "c", "2", "s2"), ("C", "x", "c", "3", "s3")],
    [("A", "a2", "c", "1", "s1"), ("B", "b", "c", "2", "s2"), ("D", "d", "c", "4", "s4")],  # A changed, C gone, D new
    [("A", "a2", "c", "1", "s1"), ("B", "b", "c", "2", "s2"), ("D", "d", "c", "4", "s4")],
    [("A", "a3", "c", "1", "s1"), ("B", "b", "c", "2", "s2"), ("C", "x", "c", "3", "s3")],  # D gone, C back
]


def at(day):
    return dt.datetime.combine(day, dt.time(6))


def rows(df):
    return sorted(map(tuple, df.select(*sd.STATION_DIM_COLUMNS).collect()), key=str)


def files(p):
    root = p.store.root.removeprefix("file:") + "/dim_pickup_station/closed"
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def test_history_by_changes_equals_the_whole_apply(spark):
    p, dim, seen = Pipeline(spark), sd.empty_dim(spark), {}
    for day, stations in zip(DAYS, LISTS):
        listed = spark.createDataFrame(stations, STATION)
        dim = sd.apply_snapshot(dim, sd.snapshot_rows(listed, day), at(day)).checkpoint()
        got = p.apply_stations(listed, day, at(day))
        assert rows(got) == rows(dim), day
        now = files(p)
        assert {f: now[f] for f in seen} == seen  # closed rows of earlier days are not written again
        seen = now
    assert p.store.version("dim_pickup_station").count() == 3
    assert p.store.get("dim_pickup_station").count() == 7
    # current rows alone: the files of closed rows are not read
    plan = p.store.get("dim_pickup_station").where("is_current")._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan
    # a new driver goes on from the stored keys
    again = Pipeline(spark, Store(spark, p.store.root))
    assert again._last_station_keys(4) == (5, 7)
    assert rows(again.apply_stations(spark.createDataFrame(LISTS[3], STATION), DAYS[3], at(DAYS[3]))) == rows(dim)


def test_a_stopped_apply_publishes_nothing(spark):
    p = Pipeline(spark)
    first = p.apply_stations(spark.createDataFrame(LISTS[0], STATION), DAYS[0], at(DAYS[0]))
    before = rows(first)
    # a run that ends after the closed rows and the keys, and in the middle of the version
    name = f"{p.store.root}/dim_pickup_station"
    first.where("ref_identifier = 'B'").write.parquet(f"{name}/closed/apply=000002")
    p.store.append("last_station_keys", spark.createDataFrame([(2, 90, 90)], "apply int, last_id long, last_sk long"))
    first.limit(1).write.parquet(f"{name}/v000002")
    os.remove(f"{name}/v000002/_SUCCESS".removeprefix("file:"))
    assert rows(p.store.get("dim_pickup_station")) == before
    got = p.apply_stations(spark.createDataFrame(LISTS[1], STATION), DAYS[1], at(DAYS[1]))
    want = sd.apply_snapshot(spark.createDataFrame(before, first.schema), sd.snapshot_rows(
        spark.createDataFrame(LISTS[1], STATION), DAYS[1]), at(DAYS[1]))
    assert rows(got) == rows(want)


def test_a_version_written_whole_is_taken_over(spark):
    p, dim = Pipeline(spark), sd.empty_dim(spark)
    for day, stations in zip(DAYS[:2], LISTS):
        dim = sd.apply_snapshot(dim, sd.snapshot_rows(spark.createDataFrame(stations, STATION), day), at(day)).checkpoint()
    p.store.put("dim_pickup_station", dim, partition_by=["is_current"])
    listed = spark.createDataFrame(LISTS[3], STATION)
    got = p.apply_stations(listed, DAYS[3], at(DAYS[3]))
    assert rows(got) == rows(sd.apply_snapshot(dim, sd.snapshot_rows(listed, DAYS[3]), at(DAYS[3])))


def batch(spark, hashes, file_id):
    return spark.createDataFrame([(h, file_id, i) for i, h in enumerate(hashes)], f"{HASH} string, file_id long, record_index int")


def stage(p, hashes, no):
    """One claim's staging, as the ingest does it."""
    rows = dedupe_staged(batch(p.spark, hashes, no), p.staged_hashes("complaints"))
    p.store.append("stg_complaint", rows.withColumn("load_batch", F.lit(no)), partition_by=["load_batch"])
    return sorted(r[0] for r in p.store.get("stg_complaint").where(F.col("load_batch") == no).select(HASH).collect())


def test_staged_hashes_are_joined_without_a_shuffle(spark):
    p = Pipeline(spark, hash_buckets=8)
    assert p.staged_hashes("complaints") is None and p._last_batch_no() == 0
    assert stage(p, ["a", "b", "a"], 1) == ["a", "b"]
    assert stage(p, ["b", "c"], 2) == ["c"]
    plan = dedupe_staged(batch(spark, ["a", "z"], 3), p.staged_hashes("complaints"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    lines = text[text.index("LeftAnti"):].splitlines()[1:]
    scan = next(i for i, x in enumerate(lines) if "Bucketed: true" in x)
    assert "SelectedBucketsCount: 8 out of 8" in lines[scan]
    # above the scan of the history up to the anti join: sort and filter only
    start = max(i for i, x in enumerate(lines[:scan]) if x.lstrip(" :").startswith("+- Sort"))
    assert not any("Exchange" in x for x in lines[start:scan + 1]), text
    assert [r[0] for r in plan.collect()] == ["z"]


def test_hashes_survive_a_new_driver_and_a_stop(spark):
    p = Pipeline(spark, hash_buckets=8)
    stage(p, ["a", "b"], 1)
    stage(p, ["c"], 2)  # staged, but not in the hash table: it is added by the next claim
    table = p.store._bucketed("staged_hashes_complaints", None, HASH, 0)
    spark.sql(f"DROP TABLE {table}")  # the catalog of the old driver is gone, its files are not
    again = Pipeline(spark, Store(spark, p.store.root), hash_buckets=4)  # the files decide on the buckets
    assert again._last_batch_no() == 2
    assert stage(again, ["a", "b", "c", "d"], 3) == ["d"]
    assert stage(again, ["d", "e"], 4) == ["e"]
    assert sorted(r[0] for r in again.staged_hashes("complaints").collect()) == ["a", "b", "c", "d", "e"]
    assert again.pending_batches("complaints") == [1, 2, 3, 4]
