"""Retired versions and staged batches, stopped calls, files per append; M1 by months; F4 after a stop."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from depotlens.operators import monitoring
from depotlens.operators import facts as fx
from depotlens.operators.ids import lit_ts
from depotlens.operators.staging import dedupe_staged, finish_staging
from depotlens.plans.pipeline import Pipeline
from depotlens.sources.store import Store

END = dt.datetime(9999, 1, 1)
RUN = [dt.datetime(2024, 1, 30, 6), dt.datetime(2024, 1, 31, 6), dt.datetime(2024, 2, 1, 6)]
STATION = "identifier string, name string, city string, zip_code string, street string"


def local(path):
    return path.removeprefix("file:")


def folders(p, name):
    return sorted(n for n in os.listdir(f"{local(p.root)}/{name}") if not n.startswith((".", "_")))


def complaints(spark, n, start=0):
    """n complaints on days of three months, two of three at a known station."""
    df = spark.range(start, start + n)
    return finish_staging(df.select(
        F.lit(1).cast("long").alias("file_id"), F.col("id").cast("int").alias("record_index"),
        F.expr("timestampadd(DAY, cast(id % 80 as int), timestamp_ntz'2023-11-20 08:00:00')").alias("complained_at"),
        *[F.concat(F.lit(c), F.col("id")).alias(c) for c in ("complaint_text", "purchase_order_id", "parcel_id",
                                                              "recipient_address", "recipient_name")],
        F.when(F.col("id") % 3 > 0, "A").otherwise("unknown").alias("pickup_station_external_id")), "complaints", RUN[0])


def stage(p, rows):
    no = p._last_batch_no() + 1
    rows = dedupe_staged(rows, p.staged_hashes("complaints"))
    p.store.append("stg_complaint", rows.withColumn("load_batch", F.lit(no)), partition_by=["load_batch"])
    return no


def day(p, rows, run_ts):
    stage(p, rows)
    p.load_pending(run_ts)
    p.link(run_ts)
    return p.monitor(run_ts.date(), run_ts)


def state(p):
    tables = ("fact_complaint", "complaint_station_link", "complaint_unlinked", "monitoring_complaints", "dim_pickup_station")
    return {t: sorted(map(str, p.store.get(t).collect())) for t in tables}


def started(spark):
    p = Pipeline(spark, hash_buckets=4)
    p.apply_stations(spark.createDataFrame([("A", "a", "c", "1", "s")], STATION), RUN[0].date(), RUN[0])
    return p


def test_runs_go_on_the_same_after_retention(spark):
    kept, thin = started(spark), started(spark)
    for i, run_ts in enumerate(RUN[:2]):
        rows = complaints(spark, 40 + 30 * i)  # each day brings the earlier records again
        day(kept, rows, run_ts)
        day(thin, rows, run_ts)
        gone = thin.retire(END, keep=1)
        assert gone["stg_complaint"] == [str(i + 1)] and folders(thin.store, "stg_complaint/data") == []
        assert thin.pending_batches("complaints") == []
    assert state(thin) == state(kept)
    assert thin._last_batch_no() == 2 and thin.store.get("stg_complaint").count() == 0
    assert len(folders(thin.store, "monitoring_complaints")) == 1 and len(folders(kept.store, "monitoring_complaints")) == 2
    assert thin.retire(END, keep=1) == {}


def test_only_what_is_done_and_old_enough_goes(spark):
    p = started(spark)
    day(p, complaints(spark, 20), RUN[0])
    stage(p, complaints(spark, 30))  # staged, not loaded
    assert p.retire(dt.datetime(2001, 1, 1)) == {}
    assert p.retire(END)["stg_complaint"] == ["1"]
    assert folders(p.store, "stg_complaint/data") == ["load_batch=2"]
    p.load_pending(RUN[1])  # loaded, not linked
    assert "stg_complaint" not in p.retire(END)
    p.link(RUN[1])
    assert p.retire(END)["stg_complaint"] == ["2"]
    assert p.store.get("fact_complaint").count() == 30 and p.store.get("complaint_station_link").count() == 20


def test_a_reader_keeps_the_version_before_the_latest(spark, tmp_root):
    s = Store(spark, tmp_root)
    for i in range(4):
        s.put("t", spark.createDataFrame([(i,)], "k int"))
        s.put("by_day/day=1", spark.createDataFrame([(i,)], "k int"))
        reader = s.get("t") if i == 2 else None or (reader if i > 2 else None)
    os.makedirs(f"{tmp_root}/t/v000005")  # being written
    assert s.versioned() == ["by_day/day=1", "t"]
    assert s.retire_versions("t", END) == [1, 2] and s.retire_versions("nothing", END) == []
    assert [r.k for r in reader.collect()] == [2] and [r.k for r in s.get("t").collect()] == [3]
    assert folders(s, "t") == ["v000003", "v000004", "v000005"]
    assert s.retire_versions("t", END, keep=0) == [3] and [r.k for r in s.get("t").collect()] == [3]


class Stop(Exception):
    pass


def test_a_stopped_retention_goes_on(spark, monkeypatch):
    p = started(spark)
    for i, run_ts in enumerate(RUN[:2]):
        day(p, complaints(spark, 40 + 30 * i), run_ts)
    whole = state(p)
    remove, calls = Store._remove, []

    def half(self, path):
        """Ends in the middle of a folder: some of its files are gone."""
        calls.append(path)
        files = sorted(os.path.join(d, f) for d, _, names in os.walk(local(path)) for f in names)
        for f in files[: len(files) // 2]:
            os.remove(f)
        raise Stop

    for _ in range(3):
        monkeypatch.setattr(Store, "_remove", half)
        with pytest.raises(Stop):
            p.retire(END, keep=1)
        monkeypatch.setattr(Store, "_remove", remove)
        assert state(p) == whole
        left = p.store.get("stg_complaint")  # a batch is there whole or not at all
        assert {r["load_batch"]: r["count"] for r in left.groupBy("load_batch").count().collect()}.items() <= {1: 40, 2: 30}.items()
        again = Pipeline(spark, Store(spark, p.store.root))
        assert again._last_batch_no() == 2 and again.pending_batches("complaints") == []
    assert calls
    p.retire(END, keep=1)
    assert folders(p.store, "stg_complaint/retired") == []
    assert state(p) == whole
    day(p, complaints(spark, 90), RUN[2])  # the next day brings the 20 new records alone
    assert p.store.get("fact_complaint").count() == 90 and p.store.get("stg_complaint").count() == 20


def test_an_append_adds_a_file_per_month_not_per_task(spark, tmp_root):
    s = Store(spark, tmp_root)
    df = spark.range(0, 4000, numPartitions=16).select("id", (F.col("id") % 5).cast("int").alias("month"))
    got = s.append("f", df, partition_by=["month"], sort_by=["id"])
    assert got.count() == 4000 and sorted(got.groupBy("month").count().collect()) == [(m, 800) for m in range(5)]
    files = [f for _, _, names in os.walk(f"{tmp_root}/f/data") for f in names if f.endswith(".parquet")]
    assert len(files) == 5  # 80 without dealing


def test_the_day_count_reads_the_months_loaded_that_day(spark, monkeypatch):
    p = started(spark)
    day(p, complaints(spark, 80), RUN[0])  # three months
    seen = []
    monkeypatch.setattr("depotlens.plans.pipeline.complaint_monitoring",
                        lambda view, *a: seen.append(view) or monitoring.complaint_monitoring(view, *a))
    late = complaints(spark, 1, start=160).withColumn("file_id", F.lit(2).cast("long"))  # 2023-11 only
    got = day(p, late, RUN[1]).orderBy("monitoring_date").collect()
    assert [(r.complaints_loaded, r.complaints_unresolved) for r in got] == [(80, 27), (1, 0)]
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "complained_month" in plan.split("PartitionFilters: [")[1].split("]")[0] and "2023-11-01" in plan
    # an older store, without the months of its loads, reads all of them
    q = started(spark)
    rows = fx.load_facts(None, complaints(spark, 80), "complaints", RUN[0], created_at=lit_ts(RUN[1]))
    q.store.append("fact_complaint", rows, partition_by=["complained_month"])
    got = day(q, late, RUN[1]).collect()
    assert [r.complaints_loaded for r in got] == [81]


def test_keys_stay_unique_after_a_load_that_was_stopped(spark, monkeypatch):
    p = started(spark)
    day(p, complaints(spark, 20), RUN[0])
    stage(p, complaints(spark, 50))
    put = Pipeline._put_key

    def stop(self, name, last_key, loading):
        if not loading:  # the facts are written, their largest key is not
            raise Stop
        put(self, name, last_key, loading)

    monkeypatch.setattr(Pipeline, "_put_key", stop)
    with pytest.raises(Stop):
        p.load_pending(RUN[1])
    monkeypatch.setattr(Pipeline, "_put_key", put)
    again = Pipeline(spark, Store(spark, p.store.root))
    again.load_pending(RUN[1])
    day(again, complaints(spark, 60), RUN[2])
    n, keys, top = again.store.get("fact_complaint").agg(F.count("*"), F.count_distinct("complaint_sk"), F.max("complaint_sk")).first()
    assert n == keys == top == 60
