"""As-of join and id allocation against brute force."""

import datetime as dt
import random

from depotlens.operators.asof import asof_join
from depotlens.operators.ids import assign_ids


def test_asof_matches_brute_force_with_hot_key(spark):
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    keys = ["a", "b", "hot", "hot", "hot", "hot", None]
    L = [(i, rnd.choice(keys), base + dt.timedelta(hours=rnd.randint(0, 60)) if rnd.random() > 0.05 else None)
         for i in range(400)]
    R = [(j, rnd.choice(keys[:-1] + ["c"]), base + dt.timedelta(hours=rnd.randint(0, 60)), f"h{rnd.randint(0, 30):02d}")
         for j in range(700)]
    left = spark.createDataFrame(L, "lid int, k string, t timestamp_ntz")
    right = spark.createDataFrame(R, "rid int, k string, rt timestamp_ntz, h string")
    for parts in (1, 3, 9, None):
        got = {r.lid: r.m_rid for r in asof_join(left, right, "k", "t", "rt", ["rid", "h"], "h",
                                                  num_partitions=parts).collect()}
        want = {}
        for lid, k, t in L:
            cands = [(rt, h, rid) for rid, rk, rt, h in R if k is not None and t is not None and rk == k and rt <= t]
            want[lid] = max(cands)[2] if cands else None
        assert got == want


def test_assign_ids_are_consecutive_in_order(spark):
    df = spark.range(0, 5000).selectExpr("(id * 7919) % 5000 AS k", "id AS v")
    small = {r.k: r.n for r in assign_ids(df, ["k"], "n", start=10).collect()}
    big = {r.k: r.n for r in assign_ids(df, ["k"], "n", start=10, num_partitions=6).collect()}
    assert small == big == {k: k + 11 for k in range(5000)}


def test_complaint_delivery_link_against_brute_force(spark):
    from depotlens.operators.correlation import complaint_delivery_link

    rnd = random.Random(11)
    base = dt.datetime(2024, 1, 1)
    parcels = ["p1", "hot", "hot", "hot", "p2", "p3", None]
    orders = ["o1", "o2", "o3"]
    C = [(f"c{i:03d}", base + dt.timedelta(hours=rnd.randint(0, 50)), rnd.choice(parcels), rnd.choice(orders))
         for i in range(120)]
    D = [(f"d{j:03d}", base + dt.timedelta(hours=rnd.randint(0, 50)), f"drv{j % 4}", rnd.choice(parcels[:-2]),
          rnd.choice(orders[:2])) for j in range(200)]
    comp = spark.createDataFrame(C, "record_hash_sha256 string, complained_at timestamp_ntz, parcel_id string, "
                                    "purchase_order_id string")
    deliv = spark.createDataFrame(D, "record_hash_sha256 string, delivered_at timestamp_ntz, driver_id string, "
                                     "parcel_id string, purchase_order_id string")
    got = {r.record_hash_sha256: (r.matched_by, r.delivery_record_hash) for r in
           complaint_delivery_link(comp, deliv).collect()}

    def pick(cands, t):
        before = [d for d in cands if d[1] <= t]
        pool = before or cands
        return max(pool, key=lambda d: (d[1], d[0]))[0]

    for h, t, p, o in C:
        by_p = [d for d in D if p is not None and d[3] == p]
        by_o = [d for d in D if d[4] == o]
        want = ("parcel", pick(by_p, t)) if by_p else (("purchase_order", pick(by_o, t)) if by_o else (None, None))
        assert got[h] == want, h


def test_fact_keys_follow_file_and_position(spark):
    from depotlens.operators import facts as fx
    from depotlens.operators.staging import finish_staging

    base = dt.datetime(2024, 2, 1)
    rows = [(f, i, base + dt.timedelta(minutes=7 * f + i), "PS1", f"n{i % 5}", "a", None, None, f"t{f}-{i}")
            for f in (3, 1, 2) for i in range(40)]
    staged = finish_staging(spark.createDataFrame(rows, "file_id long, record_index int, complained_at timestamp_ntz, "
                                                        "pickup_station_external_id string, recipient_name string, "
                                                        "recipient_address string, parcel_id string, "
                                                        "purchase_order_id string, complaint_text string"),
                            "complaints", base)
    got = fx.load_facts(None, staged, "complaints", base).select("file_id", "record_hash_sha256", "complaint_sk").collect()
    place = {r.record_hash_sha256: (r.file_id, r.record_index) for r in staged.collect()}
    assert [r.complaint_sk for r in sorted(got, key=lambda r: place[r.record_hash_sha256])] == list(range(1, 121))
