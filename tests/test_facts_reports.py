"""Facts, links, monitoring and reports on hand tables."""

import datetime as dt

from pyspark.sql import functions as F

from depotlens.operators import facts as fx
from depotlens.operators import reports, station_dim
from depotlens.operators.monitoring import complaint_monitoring
from depotlens.operators.staging import finish_staging
from helpers import D1, D2, T1, T2, stations

COLS = ("file_id long, record_index int, complained_at timestamp_ntz, pickup_station_external_id string, "
        "recipient_name string, recipient_address string, parcel_id string, purchase_order_id string, "
        "complaint_text string")


def staged(spark, rows):
    return finish_staging(spark.createDataFrame(rows, COLS), "complaints", T1)


def c(file_id, idx, when, station, name="Ann", addr="Road 1", text="late"):
    return (file_id, idx, when, station, name, addr, None, None, text)


def dim_for(spark, rows, day=D1, ts=T1, dim=None):
    snap = station_dim.snapshot_rows(stations(spark, rows), day)
    base = station_dim.empty_dim(spark) if dim is None else dim
    return station_dim.apply_snapshot(base, snap, ts).cache()


def test_same_record_in_two_files_loads_once_and_reload_is_noop(spark):
    t = dt.datetime(2024, 3, 1, 9)
    rows = [c(2, 0, t, "A"), c(1, 5, t, "A"), c(1, 6, t, "B")]
    fact = fx.load_facts(None, staged(spark, rows), "complaints", T1).cache()
    assert fact.count() == 2
    a = fact.where("pickup_station_external_id = 'A'").first()
    assert (a.file_id, a.complaint_sk) == (1, 1)
    again = fx.load_facts(fact, staged(spark, rows), "complaints", T2)
    assert again.count() == 0


def test_link_is_sticky_and_retried(spark):
    t = dt.datetime(2024, 3, 1, 9)
    fact = fx.load_facts(None, staged(spark, [c(1, 0, t, "A"), c(1, 1, t, "N"), c(1, 2, t, None)]),
                         "complaints", T1).cache()
    dim1 = dim_for(spark, [("A", "Alpha", "X", "1", "S1")])
    l1 = fx.link_complaints(fact, None, dim1, T1).cache()
    assert l1.count() == 1
    # day 2: A renamed (same id), N appears
    dim2 = dim_for(spark, [("A", "Alpha 2", "X", "1", "S1"), ("N", "Nu", "Y", "2", "S2")], D2, T2, dim1)
    l2 = fx.link_complaints(fact, l1, dim2, T2).cache()
    assert [(r.pickup_station_id, r.linked_at) for r in l2.collect()] == [(2, T2)]
    view = fx.complaint_view(fact, l1.unionByName(l2))
    assert view.where("pickup_station_id is null").count() == 1


def test_two_current_rows_with_one_identifier_link_smallest_id(spark):
    t = dt.datetime(2024, 3, 1, 9)
    fact = fx.load_facts(None, staged(spark, [c(1, 0, t, "A")]), "complaints", T1)
    dim = dim_for(spark, [("A", "Alpha", "X", "1", "S1"), ("Q", "Q", "X", "2", "S2")])
    dup = dim.withColumn("ref_identifier", F.lit("A"))  # both current rows say A
    assert [r.pickup_station_id for r in fx.link_complaints(fact, None, dup, T1).collect()] == [1]


def test_reports_windows_thresholds_and_nulls(spark):
    as_of = dt.date(2024, 3, 31)
    edge = dt.datetime(2024, 3, 17, 0, 0)        # exactly as_of - 14 days
    before = dt.datetime(2024, 3, 16, 23, 59, 59)
    future = dt.datetime(2024, 4, 5, 0, 0)
    rows = [c(1, 0, edge, "A"), c(1, 1, before, "A"), c(1, 2, future, "A"), c(1, 3, None, "A")]
    rows += [c(2, i, dt.datetime(2024, 3, 1, i), "A", name="Five") for i in range(5)]
    rows += [c(3, i, dt.datetime(2024, 3, 2, i), "B" if i % 2 else "Z", name=" six  ", addr="road 1") for i in range(6)]
    rows += [c(4, i, dt.datetime(2024, 3, 3, i), None, name=None, addr=None) for i in range(6)]
    fact = fx.load_facts(None, staged(spark, rows), "complaints", T1).cache()
    dim = dim_for(spark, [("A", "Alpha", "X", "1", "S1"), ("B", "Beta", "Y", "2", "S2")])
    links = fx.link_complaints(fact, None, dim, T1).cache()
    r1 = {r.pickup_identifier: r.claims_last_14_days for r in reports.station_claims(fact, links, dim, as_of).collect()}
    assert r1 == {"A": 2}
    r2 = {(r.recipient_name, r.recipient_address): r for r in
          reports.frequent_recipients(fact, links, dim, as_of).collect()}
    assert set(r2) == {(" six  ", "road 1"), (None, None)}
    six = r2[(" six  ", "road 1")]
    assert six.complaints_2m == 6 and six.pickup_locations_given == "B | Z"
    assert six.pickup_locations_enriched == "B - Beta (2)"
    none = r2[(None, None)]
    assert none.pickup_locations_given is None and none.pickup_locations_enriched is None


def test_monitoring_day_without_loads_has_zero_row(spark):
    t = dt.datetime(2024, 3, 1, 9)
    fact = fx.load_facts(None, staged(spark, [c(1, 0, t, "A")]), "complaints", T1)
    row = complaint_monitoring(fx.complaint_view(fact, None), dt.date(2024, 5, 1), T2).collect()
    assert [(r.complaints_loaded, r.complaints_unresolved) for r in row] == [(0, 0)]
    row = complaint_monitoring(fx.complaint_view(fact, None), T1.date(), T2).collect()
    assert [(r.complaints_loaded, r.complaints_unresolved) for r in row] == [(1, 1)]
