"""Station history (D1-D11, C1) on hand tables (FIXTURES.md section 4)."""

import pytest
from pyspark.sql import functions as F

from depotlens.operators import station_dim as sd
from helpers import D1, D2, D3, T1, T2, T3, current, stations

BASE = [("A", "Alpha", "Berlin", "10115", "Main 1"),
        ("B", "Beta", "Berlin", "10117", "Main 2"),
        ("C", "Gamma", "Hamburg", "20095", "Port 3"),
        ("E", "Epsilon", "Munich", "80331", "Hill 5")]


def load(spark, rows, day, ts, dim=None, **kw):
    snap = sd.snapshot_rows(stations(spark, rows), day)
    dim = sd.empty_dim(spark) if dim is None else dim
    return sd.apply_snapshot(dim, snap, ts, **kw).cache()


def rows_of(dim, sid):
    return dim.where(F.col("pickup_station_id") == sid).orderBy("pickup_station_sk").collect()


def test_first_load_ids_follow_reference_order(spark):
    dim = load(spark, BASE, D1, T1)
    assert current(dim) == {"A": 1, "B": 2, "C": 3, "E": 4}
    assert [r.pickup_station_sk for r in dim.orderBy("pickup_station_sk").collect()] == [1, 2, 3, 4]
    assert dim.where("valid_to is null and is_current and is_active").count() == 4


def test_renamed_station_keeps_id_and_gets_new_version(spark):
    dim1 = load(spark, BASE, D1, T1)
    day2 = [("A", "Alpha NEW", "Berlin", "10115", "Main 1")] + BASE[1:]
    dim2 = load(spark, day2, D2, T2, dim=dim1)
    versions = rows_of(dim2, 1)
    assert [(v.name, v.is_current, v.valid_to) for v in versions] == [("Alpha", False, T2), ("Alpha NEW", True, None)]
    assert versions[1].valid_from == T2 and versions[0].is_active
    assert current(dim2)["A"] == 1


def test_new_identifier_same_address_keeps_id(spark):
    dim1 = load(spark, BASE, D1, T1)
    day2 = [("B2", "Beta", "Berlin", "10117", "Main 2")] + [r for r in BASE if r[0] != "B"]
    dim2 = load(spark, day2, D2, T2, dim=dim1)
    versions = rows_of(dim2, 2)
    assert [(v.ref_identifier, v.is_current) for v in versions] == [("B", False), ("B2", True)]
    assert dim2.where("not is_active").count() == 0


def test_new_station_at_address_of_listed_one_is_added(spark):
    dim1 = load(spark, BASE, D1, T1)
    day2 = BASE + [("F", "Phi", "Munich", "80331", "Hill 5")]  # E's address, E still listed
    dim2 = load(spark, day2, D2, T2, dim=dim1)
    assert current(dim2)["F"] == 5
    assert len(rows_of(dim2, 4)) == 1 and rows_of(dim2, 4)[0].is_current  # E untouched


def test_blank_addresses_never_match(spark):
    rows = BASE + [("G", "G", "X", None, None), ("H", "H", "Y", "", "")]
    dim1 = load(spark, rows, D1, T1)
    assert {"G", "H"} <= set(current(dim1))
    # G disappears, J appears with a blank address: J is new, G is removed
    day2 = [r for r in rows if r[0] != "G"] + [("J", "J", "Z", None, None)]
    dim2 = load(spark, day2, D2, T2, dim=dim1)
    g = current(dim1)["G"]
    assert current(dim2)["J"] not in current(dim1).values()
    assert [(r.is_current, r.is_active) for r in rows_of(dim2, g)] == [(False, False)]


def test_removed_then_back_gets_new_id(spark):
    dim1 = load(spark, BASE, D1, T1)
    dim2 = load(spark, [r for r in BASE if r[0] != "C"], D2, T2, dim=dim1)
    c = rows_of(dim2, 3)
    assert [(r.is_current, r.is_active, r.valid_to) for r in c] == [(False, False, T2)]
    dim3 = load(spark, BASE, D3, T3, dim=dim2)
    assert current(dim3)["C"] == 5


def test_empty_snapshot_raises_unless_allowed(spark):
    dim1 = load(spark, BASE, D1, T1)
    with pytest.raises(sd.EmptySnapshotError):
        load(spark, [], D2, T2, dim=dim1)
    dim2 = load(spark, [], D2, T2, dim=dim1, allow_empty=True)
    assert dim2.where("is_current").count() == 0 and dim2.where("not is_active").count() == 4


def test_same_snapshot_twice_changes_nothing(spark):
    dim1 = load(spark, BASE, D1, T1)
    dim2 = load(spark, BASE, D2, T2, dim=dim1)
    cols = [c for c in dim1.columns]
    assert sorted(map(tuple, dim1.select(cols).collect())) == sorted(map(tuple, dim2.select(cols).collect()))


def test_fingerprint_shared_on_one_side_is_not_used(spark):
    # K2: B and C both renamed their identifier; the new rows share one address
    dim1 = load(spark, BASE, D1, T1)
    day2 = [BASE[0], BASE[3], ("B9", "Beta", "Berlin", "10117", "Main 2"),
            ("C9", "Gamma", "Berlin", "10117", "Main 2")]
    dim2 = load(spark, day2, D2, T2, dim=dim1)
    cur = current(dim2)
    assert cur["B9"] not in (2, 3) and cur["C9"] not in (2, 3)


def test_one_current_row_and_no_overlap_over_three_days(spark):
    dim = load(spark, BASE, D1, T1)
    dim = load(spark, [("A", "Alpha 2", "Berlin", "10115", "Main 1"), ("B2", "Beta", "Berlin", "10117", "Main 2"),
                       BASE[3]], D2, T2, dim=dim)
    dim = load(spark, BASE, D3, T3, dim=dim)
    chk = sd.check_one_current(dim).first()
    assert chk.violations == 0
    for sid in [r[0] for r in dim.select("pickup_station_id").distinct().collect()]:
        vs = rows_of(dim, sid)
        for a, b in zip(vs, vs[1:]):
            assert a.valid_to is not None and a.valid_to <= b.valid_from


def test_snapshot_upsert_keeps_rows_missing_from_rerun(spark):
    first = sd.snapshot_rows(stations(spark, BASE), D1)
    t = sd.upsert_snapshot(sd.empty_snapshot(spark), first)
    rerun = sd.snapshot_rows(stations(spark, [("A", "Alpha X", "Berlin", "10115", "Main 1")]), D1)
    t = sd.upsert_snapshot(t, rerun)
    got = {r.ref_identifier: r.name for r in t.collect()}
    assert got == {"A": "Alpha X", "B": "Beta", "C": "Gamma", "E": "Epsilon"}


def test_fingerprint_and_hash_values(spark):
    snap = sd.snapshot_rows(stations(spark, [("Z", "n", "c", "ab1", "street x"), ("Y", None, None, None, None)]), D1)
    got = {r.ref_identifier: (r.fingerprint, r.attr_hash_sha256) for r in snap.collect()}
    import hashlib
    assert got["Z"] == ("AB1|STREET X", hashlib.sha256(b"n|c|ab1|street x").hexdigest())
    assert got["Y"] == ("|", hashlib.sha256(b"|||").hexdigest())


def test_repeated_identifier_keeps_one_row_and_broken_keys_stop(spark):
    import pytest

    from depotlens.plans.pipeline import Pipeline

    rows = stations(spark, [("A", "a2", "c", "1", "s"), ("A", "a", "c", "1", "s"), ("B", "b", "c", "2", "s")])
    p = Pipeline(spark)
    dim = p.apply_stations(rows, D1, T1)
    assert sorted((r.ref_identifier, r.name) for r in dim.collect()) == [("A", "a"), ("B", "b")]
    assert sd.check_keys(dim).where("violations > 0").count() == 0
    doubled = dim.unionByName(dim.where("ref_identifier = 'A'"))
    assert {r[0]: r[1] for r in sd.check_keys(doubled).collect()} == {"one_current": 1, "unique_sk": 1}
    p.store.put("dim_pickup_station", doubled, partition_by=["is_current"])
    with pytest.raises(ValueError):
        p.apply_stations(rows, D2, T2)


def test_unknown_driver_is_one_row(spark):
    from depotlens.operators.correlation import driver_complaints

    links = spark.createDataFrame([("c1", "d1", None), ("c2", "d2", "x")], "record_hash_sha256 string, delivery_record_hash string, driver_id string")
    deliveries = spark.createDataFrame([(None,), (None,), ("x",)], "driver_id string")
    got = {r.driver_id: (r.deliveries, r.complaints) for r in driver_complaints(links, deliveries).collect()}
    assert got == {None: (2, 1), "x": (1, 1)}
