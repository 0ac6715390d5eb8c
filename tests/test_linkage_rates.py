"""Station linkage, ratio limits, delay sketches, alert episodes."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from depotlens.operators import correlation, episodes, linkage
from depotlens.operators.matching import match_stations
from depotlens.plans.scenario import scenario

SF = "/root/testdata/sf0.01"


# ------------------------------------------------------------------- crosswalk
def test_crosswalk_gives_id_and_reference_of_one_station(spark):
    dim = spark.createDataFrame([(9, "A1", True), (2, "B2", True)], "pickup_station_id long, ref_identifier string, is_current boolean")
    cross = spark.createDataFrame([("x", "A1"), ("x", "B2"), ("x", "B2")], "external_id string, ref_identifier string")
    got = match_stations(spark.createDataFrame([("x",)], "e string"), dim, crosswalk=cross).collect()
    assert [tuple(r) for r in got] == [("x", 9, "A1", "crosswalk", None)]


# --------------------------------------------------------------------- linkage
def stations(spark, rows, identifier="identifier"):
    return linkage.comparable(spark.createDataFrame(rows, "identifier string, name string, zip_code string, street string"), identifier)


def test_levels_and_null_fields(spark):
    left = stations(spark, [("S-7", "Depot North", "01000", "Main 5"), ("S-8", None, None, None), ("S-9", "Dpt Nrth", "01000", "High 5")])
    right = stations(spark, [("PS7", "DEPOT  north", "01000", "main 5"), ("PS8", "x", "1", "y"), ("PS1", "Other", "01000", "Low 5")])
    got = {(r["identifier_l"], r["identifier_r"]): tuple(r[f"{f}_level"] for f in linkage.FIELDS)
           for r in linkage.candidates(left, right).collect()}
    assert got[("S-7", "PS7")] == (2, 2, 2, 2)
    assert got[("S-8", "PS8")] == (None, None, None, 2)
    assert got[("S-9", "PS7")] == (1, 2, 1, 0)
    assert got[("S-9", "PS1")] == (0, 2, 1, 0)
    assert ("S-8", "PS7") not in got  # nulls share no block


def test_chance_levels_equal_all_pairs(spark):
    r = random.Random(1)
    rows = [[(f"{s}{r.randrange(8)}", r.choice(["Alpha", "Alph", "Beta", None]), r.choice(["1", "2", None]), f"{r.choice('ab')} {r.randrange(3)}")
             for _ in range(40)] for s in "LR"]
    left, right = (stations(spark, x) for x in rows)
    u = linkage.chance_levels(left, right)
    pairs = [(a, b) for a in left.collect() for b in right.collect()]
    for f in linkage.FIELDS:
        known = [(a, b) for a, b in pairs if a[f] is not None and b[f] is not None]
        equal = sum(a[f] == b[f] for a, b in known) / len(known)
        rough = sum(a[f] != b[f] and a[f"{f}_rough"] == b[f"{f}_rough"] for a, b in known) / len(known) if f in linkage.ROUGH else 0
        assert u[f][2] == pytest.approx(equal) and u[f][1] == pytest.approx(rough) and u[f][0] == pytest.approx(1 - equal - rough)


def test_expectation_maximisation_finds_planted_rates():
    r = random.Random(3)
    u = {"name": {2: 0.01, 1: 0.02, 0: 0.97}, "number": {2: 0.01, 1: 0.0, 0: 0.99}}
    counts: dict = {}
    for _ in range(20_000):
        match = r.random() < 0.3
        name = r.choices((2, 1, 0), (0.7, 0.2, 0.1) if match else (0.01, 0.02, 0.97))[0]
        number = r.choices((2, 0), (0.9, 0.1) if match else (0.01, 0.99))[0]
        counts[name, number] = counts.get((name, number), 0) + 1
    m, expected = linkage.learned_levels([(*k, n) for k, n in counts.items()], ["name", "number"], u)
    assert expected == pytest.approx(6000, rel=0.05)
    assert m["name"][2] == pytest.approx(0.7, abs=0.03) and m["number"][2] == pytest.approx(0.9, abs=0.03)


def test_learned_linkage_finds_planted_stations(spark):
    sc = scenario(spark, SF)
    from depotlens.operators.station_dim import current_rows
    left, right = linkage.comparable(sc.partner_list, "identifier"), linkage.comparable(current_rows(sc.dim2), "ref_identifier")
    weights, prior = linkage.learn_weights(left, right)
    got = {r["identifier"]: r["ref_identifier"] for r in linkage.link_stations(left, right, weights, -prior).collect()}
    current = {r[0] for r in current_rows(sc.dim2).select("ref_identifier").collect()}
    truth = {}
    for r in sc.partner_list.collect():
        t = r["true_ref"]
        truth[r["identifier"]] = t if t in current else f"PSX{t[2:]}" if t and f"PSX{t[2:]}" in current else None
    assert got.keys() == truth.keys()
    right_ones = sum(1 for k, v in got.items() if v and v == truth[k])
    assert right_ones / sum(v is not None for v in got.values()) >= 0.98  # precision
    assert right_ones / sum(v is not None for v in truth.values()) >= 0.93  # recall
    assert all(got[k] is None for k in got if k.startswith("S-9"))  # planted strangers in the same zip and house number


def test_rows_with_equal_fields_get_the_same_station(spark):
    left = stations(spark, [("S-7", "A", "1", "b 1"), ("T-7", "A", "1", "b 1"), ("U-8", "zzz", "9", "q")])
    right = stations(spark, [("PS7", "A", "1", "b 1")])
    got = linkage.link_stations(left, right, {"name": {0: -1, 1: 1, 2: 2}, "zip": {0: -1, 2: 1}, "street": {0: -1, 1: 1, 2: 2}, "number": {0: -1, 2: 2}}, 3)
    assert sorted(map(tuple, got.collect())) == [("S-7", "PS7", 7), ("T-7", "PS7", 7), ("U-8", None, None)]


# ------------------------------------------------------------- ratios and delays
def test_wilson_limits_flag_a_station_and_spare_a_small_one(spark):
    at = dt.datetime(2024, 1, 5)
    deliveries = [(f"h{s}{i}", at, s) for s, n in (("bad", 200), ("good", 2000), ("tiny", 10)) for i in range(n)]
    hit = [f"hbad{i}" for i in range(60)] + [f"hgood{i}" for i in range(20)] + ["htiny0"]
    d = spark.createDataFrame(deliveries, "record_hash_sha256 string, delivered_at timestamp_ntz, pickup_station_external_id string")
    links = spark.createDataFrame([(h,) for h in [*hit, *hit, None]], "delivery_record_hash string")  # complained twice: one delivery
    got = {r["station"]: r for r in correlation.complaint_rate_limits(links, d).collect()}
    assert {k: (r["complained"], r["flag"]) for k, r in got.items()} == {"bad": (60, "high"), "good": (20, "low"), "tiny": (1, "normal")}
    n, p = 200, 0.3
    middle, width = p + 9 / (2 * n), 3 * math.sqrt(p * (1 - p) / n + 9 / (4 * n * n))
    assert got["bad"]["lower_limit"] == pytest.approx((middle - width) / (1 + 9 / n))
    assert got["tiny"]["upper_limit"] <= 1


def delays(spark, values):
    start = dt.datetime(2024, 1, 1)
    rows = [(start + dt.timedelta(days=i % 5), "d1" if i % 3 else None, float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "complained_at timestamp_ntz, driver_id string, delay_seconds double"), rows


def test_quantiles_of_merged_sketches_are_within_the_error(spark):
    r = random.Random(2)
    links, rows = delays(spark, [r.choice([-1, 1]) * int(10 ** r.uniform(0, 9)) for _ in range(4000)] + [0] * 20)
    sketch = correlation.delay_sketch(links)
    for since, until in ((None, None), (dt.date(2024, 1, 2), dt.date(2024, 1, 3))):
        got = {x["driver_id"]: x for x in correlation.delay_quantiles(sketch, (0.1, 0.5, 0.9), since, until).collect()}
        for driver in ("d1", None):
            held = sorted(v for t, d, v in rows if d == driver and (since is None or since <= t.date() <= until))
            assert got[driver]["delays"] == len(held)
            for q in (0.1, 0.5, 0.9):
                exact, said = held[math.ceil(q * len(held)) - 1], got[driver][f"p{round(100 * q)}_seconds"]
                assert abs(said) <= abs(exact) and abs(said - exact) <= abs(exact) / 64


def test_a_day_of_the_sketch_replaces_no_other(spark):
    links, _ = delays(spark, range(1000))
    days = [correlation.delay_sketch(links.where(F.to_date("complained_at") == F.lit(dt.date(2024, 1, 1 + k)))) for k in range(5)]
    merged = days[0]
    for d in days[1:]:
        merged = merged.unionByName(d)
    whole = correlation.delay_quantiles(correlation.delay_sketch(links)).collect()
    assert sorted(map(str, correlation.delay_quantiles(merged).collect())) == sorted(map(str, whole))


def test_missing_deliveries(spark):
    t = [dt.datetime(2024, 1, k) for k in (1, 2, 3)]
    links = spark.createDataFrame(
        [("p1", t[1], None), ("p1", t[0], "purchase_order"), ("p2", t[2], "parcel"), ("p3", t[2], None), (None, t[0], None)],
        "parcel_id string, complained_at timestamp_ntz, matched_by string")
    assert sorted(map(tuple, correlation.missing_deliveries(links).collect())) == [("p1", 2, t[0], t[1], True), ("p3", 1, t[2], t[2], False)]


# -------------------------------------------------------------------- episodes
def brute_episodes(days, quiet):
    out = []
    for s in sorted({s for s, _ in days}):
        for d in sorted(d for x, d in days if x == s):
            n = days[s, d]
            if out and out[-1][0] == s and (d - out[-1][2]).days <= quiet:
                a = out[-1]
                out[-1] = (s, a[1], d, a[3] + 1, a[4] + n, max(a[5], n))
            else:
                out.append((s, d, d, 1, n, n))
    return out


def test_episodes_day_by_day_equal_all_days_at_once(spark):
    r = random.Random(5)
    start = dt.date(2024, 1, 1)
    days = {(s, start + dt.timedelta(days=r.randrange(40))): r.randrange(2, 9) for s in range(4) for _ in range(12)}
    schema = "pickup_station_id long, episode_start date, episode_last date, breach_days long, complaints long, peak long"

    def frame(part):
        return spark.createDataFrame([(s, d, d, 1, n, n) for (s, d), n in part.items()], schema)

    expected = brute_episodes(days, 2)
    assert sorted(map(tuple, episodes.advance(None, frame(days), 2).collect())) == expected
    state = None
    late = [k for k in days if k[1].day % 7 == 3]  # known only at the end
    for low, high in ((0, 10), (10, 25), (25, 60)):
        part = {k: v for k, v in days.items() if low <= (k[1] - start).days < high and k not in late}
        state = spark.createDataFrame(episodes.advance(state, frame(part), 2).collect(), schema)
    state = episodes.advance(state, frame({k: days[k] for k in late}), 2)
    assert sorted(map(tuple, state.collect())) == expected
    status = episodes.with_status(state, start + dt.timedelta(days=39), 2).collect()
    assert all(x["is_open"] == ((start + dt.timedelta(days=39) - x["episode_last"]).days <= 2) for x in status)


def test_breaches_count_linked_complaints_per_day(spark):
    d = dt.date(2024, 1, 1)
    fact = spark.createDataFrame([("a", d), ("b", d), ("c", d), ("x", None), ("y", d)], "record_hash_sha256 string, complained_date date")
    links = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2), ("x", 1)], "record_hash_sha256 string, pickup_station_id long")
    assert [tuple(r) for r in episodes.breaches(fact, links, 1).collect()] == [(1, d, d, 1, 2, 2)]
