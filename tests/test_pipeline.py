"""The daily pipeline over real landing files, two days, and idempotence."""

import datetime as dt

from pyspark.sql import functions as F

from depotlens.operators import reports
from depotlens.plans.pipeline import Pipeline
from depotlens.schemas import COMPLAINT_FIELDS, DELIVERY_FIELDS
from depotlens.sources import testdata as td
from depotlens.sources.files import write_landing

SF = "/root/testdata/sf0.001"


def test_two_daily_runs_and_rerun_changes_nothing(spark, tmp_root):
    write_landing(td.complaint_records(spark, SF), tmp_root, "complaints", COMPLAINT_FIELDS, "complained_at",
                  td.COMPLAINT_FILE_ORDER, part=F.col("event_id") % 2)
    write_landing(td.delivery_records(spark, SF), tmp_root, "delivery_events", DELIVERY_FIELDS, "delivered_at",
                  td.DELIVERY_FILE_ORDER, part=F.col("l_linenumber") % 2)
    p = Pipeline(spark, batch_size=40)
    p.run(td.DAY1, td.RUN1, tmp_root, td.station_list_day1(spark, SF).drop("s_suppkey"))
    facts1 = p.store.get("fact_complaint").count()
    assert facts1 == td.complaint_records(spark, SF).count()
    assert p.store.get("fact_delivery_event").count() > 0
    p.run(td.DAY2, td.RUN2, tmp_root, td.station_list_day2(spark, SF).drop("s_suppkey"))
    dim = p.store.get("dim_pickup_station")
    snapshot = (p.ledger().count(), p.store.get("fact_complaint").count(),
                p.store.get("complaint_station_link").count(), dim.count())
    assert snapshot[1] == facts1
    # linking from new and still unlinked complaints finds what a run over all of them finds
    from depotlens.operators import facts as fx
    whole = fx.link_complaints(p.store.get("fact_complaint"), None, dim, td.RUN2)
    linked = p.store.get("complaint_station_link").select("record_hash_sha256")
    assert whole.join(linked, "record_hash_sha256", "left_anti").count() == 0
    waiting = p.store.get("complaint_unlinked")
    assert waiting.count() + linked.count() == p.store.get("fact_complaint").where("pickup_station_external_id IS NOT NULL").count()
    # same day again: nothing new anywhere
    p.run(td.DAY2, dt.datetime(2024, 1, 31, 23, 30), tmp_root, td.station_list_day2(spark, SF).drop("s_suppkey"))
    again = (p.ledger().count(), p.store.get("fact_complaint").count(),
             p.store.get("complaint_station_link").count(), p.store.get("dim_pickup_station").count())
    assert again == snapshot
    r1 = reports.station_claims(p.store.get("fact_complaint"), p.store.get("complaint_station_link"),
                                p.store.get("dim_pickup_station"), td.AS_OF)
    assert r1.where(F.col("claims_last_14_days") <= 0).count() == 0
    mon = p.store.get("monitoring_complaints").orderBy("monitoring_date").collect()
    assert [m.monitoring_date for m in mon] == [td.DAY1, td.DAY2]
    # the same report through SQL on the registered views
    from depotlens.plans.views import register_views
    register_views(p, td.AS_OF)
    via_sql = spark.sql("SELECT pickup_identifier, claims_last_14_days FROM rpt_pickup_station_claims_14d")
    assert sorted(map(tuple, via_sql.collect())) == \
        sorted(map(tuple, r1.select("pickup_identifier", "claims_last_14_days").collect()))
    days = spark.sql("SELECT snapshot_date, count(*) AS n FROM stg_pickup_station GROUP BY 1 ORDER BY 1").collect()
    assert [(r.snapshot_date, r.n) for r in days] == [
        (td.DAY1, td.station_list_day1(spark, SF).count()), (td.DAY2, td.station_list_day2(spark, SF).count())]
    n_unlinked = spark.sql("SELECT count(*) AS n FROM fact_complaint WHERE pickup_station_id IS NULL").first().n
    assert n_unlinked == p.store.get("fact_complaint").count() - p.store.get("complaint_station_link").count()


def test_a_run_with_an_earlier_run_time_links_its_complaints(spark, tmp_root):
    from depotlens.operators import facts as fx
    p = Pipeline(spark)
    stations = td.station_list_day1(spark, SF).drop("s_suppkey")
    counts = []
    # the second run catches up on files of a missed run: its time lies before the first one's
    for part, run_ts in ((0, td.RUN2), (1, td.RUN2 - dt.timedelta(hours=3))):
        root = f"{tmp_root}/{part}"
        write_landing(td.complaint_records(spark, SF).where(F.col("event_id") % 2 == part), root, "complaints",
                      COMPLAINT_FIELDS, "complained_at", td.COMPLAINT_FILE_ORDER, part=F.lit(part))
        write_landing(td.delivery_records(spark, SF).where(F.col("l_linenumber") % 2 == part), root, "delivery_events",
                      DELIVERY_FIELDS, "delivered_at", td.DELIVERY_FILE_ORDER, part=F.lit(part))
        p.run(td.DAY2, run_ts, root, stations)
        counts.append(p.store.get("complaint_station_link").count())
    fact, links = p.store.get("fact_complaint"), p.store.get("complaint_station_link")
    whole = fx.link_complaints(fact, None, p.store.get("dim_pickup_station"), td.RUN2)
    assert 0 < counts[0] < counts[1] == whole.count()
    assert links.join(whole, "record_hash_sha256", "left_anti").count() == 0
    known = fact.where("pickup_station_external_id IS NOT NULL").count()
    assert p.store.get("complaint_unlinked").count() == known - counts[1]


def test_stream_trigger_runs_ledger_intake(spark, tmp_root):
    from depotlens.session import new_scratch_path
    from depotlens.streaming.intake import start_intake

    write_landing(td.complaint_records(spark, SF), tmp_root, "complaints", COMPLAINT_FIELDS, "complained_at",
                  td.COMPLAINT_FILE_ORDER, part=F.col("event_id") % 2)
    p = Pipeline(spark)
    q = start_intake(spark, p, tmp_root, new_scratch_path(spark, "stream-ckpt"), system="complaints",
                     clock=lambda: td.RUN1)
    q.awaitTermination(300)
    assert p.store.get("stg_complaint").count() == td.complaint_records(spark, SF).count()
    assert p.ledger().where("status = 'PARSED'").count() == p.ledger().count()


def test_store_state_survives_a_new_driver_object(spark, tmp_root):
    from depotlens.sources.store import Store

    s1 = Store(spark, tmp_root + "/store")
    df = spark.createDataFrame([(1, True), (2, False)], "k long, flag boolean")
    s1.put("t", df, partition_by=["flag"])
    s1.put("t", df.where("k = 1"), partition_by=["flag"])
    s1.append("f", df)
    s2 = Store(spark, tmp_root + "/store")  # e.g. after a driver restart
    assert s2.has("t") and s2.has("f") and not s2.has("nothing")
    got = s2.get("t")
    assert got.columns == ["k", "flag"] and dict(got.schema.fields[1].jsonValue())["type"] == "boolean"
    assert [r.k for r in got.collect()] == [1] and s2.get("f").count() == 2


def test_staged_batches_left_by_a_stopped_driver_are_loaded_next_run(spark, tmp_root):
    from depotlens.sources.store import Store

    write_landing(td.complaint_records(spark, SF), tmp_root + "/landing", "complaints", COMPLAINT_FIELDS,
                  "complained_at", td.COMPLAINT_FILE_ORDER, part=F.col("event_id") % 2)
    store_root = tmp_root + "/store"
    p1 = Pipeline(spark, Store(spark, store_root), batch_size=30)
    p1.ingest(tmp_root + "/landing", td.RUN1, systems=("complaints",))  # stops before loading facts
    assert not p1.store.has("fact_complaint")
    p2 = Pipeline(spark, Store(spark, store_root), batch_size=30)  # a new driver
    p2.run(td.DAY2, td.RUN2, tmp_root + "/landing", td.station_list_day1(spark, SF).drop("s_suppkey"))
    assert p2.store.get("fact_complaint").count() == td.complaint_records(spark, SF).count()
    assert p2.pending_batches("complaints") == []
    batches = [r[0] for r in p2.store.get("stg_complaint").select("load_batch").distinct().collect()]
    assert sorted(batches) == list(range(1, len(batches) + 1))


def test_volumes_are_observed_by_day_and_a_second_run_adds_nothing(spark, tmp_root):
    write_landing(td.complaint_records(spark, SF), tmp_root, "complaints", COMPLAINT_FIELDS, "complained_at",
                  td.COMPLAINT_FILE_ORDER, part=F.col("event_id") % 2)
    p = Pipeline(spark)
    stations = td.station_list_day1(spark, SF).drop("s_suppkey")
    p.run(td.DAY1, td.RUN1, tmp_root, stations)

    def volumes():
        return {(r.volume_date, r.stage, r.metric): r.value for r in p.volumes().where("source_system = 'complaints'").collect()}

    one, n = volumes(), td.complaint_records(spark, SF).count()
    assert one[td.DAY1, "staging", "rows_read"] == one[td.DAY1, "staging", "rows_kept"] == one[td.DAY1, "dw", "rows_loaded"] == n
    assert one[td.DAY1, "landing", "files_parsed"] == p.ledger().count() and one[td.DAY1, "landing", "files_failed"] == 0
    assert one[td.DAY1, "dw", "complaints_linked"] == p.store.get("complaint_station_link").count()
    assert one[td.DAY1, "dw", "complaints_waiting"] == p.store.get("complaint_unlinked").count()
    p.run(td.DAY2, td.RUN2, tmp_root, stations)
    two = volumes()
    assert {k: v for k, v in two.items() if k[0] == td.DAY1} == one
    assert two[td.DAY2, "landing", "files_registered"] == 0 and two[td.DAY2, "dw", "complaints_linked"] == 0


def test_surrogate_keys_go_on_without_a_scan_of_the_fact(spark, tmp_root):
    from depotlens.operators import facts as fx
    p = Pipeline(spark)
    stations = td.station_list_day1(spark, SF).drop("s_suppkey")
    for part, run_ts in ((0, td.RUN1), (1, td.RUN2)):
        root = f"{tmp_root}/{part}"
        write_landing(td.complaint_records(spark, SF).where(F.col("event_id") % 2 == part), root, "complaints",
                      COMPLAINT_FIELDS, "complained_at", td.COMPLAINT_FILE_ORDER, part=F.lit(part))
        p.run(run_ts.date(), run_ts, root, stations)
    fact = p.store.get("fact_complaint")
    top = fact.agg(F.max("complaint_sk"), F.count("*"), F.count_distinct("complaint_sk")).first()
    assert p.store.get("last_key_complaints").first()[0] == top[0] and top[1] == top[2]
    staged = p.store.get("stg_complaint").drop("load_batch").limit(0)  # no month: nothing of the fact is read
    rows = fx.load_facts(fact, staged, "complaints", td.RUN2, start=top[0])
    plan = rows._jdf.queryExecution().toString()
    assert "complaint_sk" not in plan.split("== Physical Plan ==")[1].split("ReadSchema")[0] or rows.count() == 0
