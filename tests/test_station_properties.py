"""Properties of the station history over random snapshot sequences."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from depotlens.operators import station_dim as sd
from helpers import stations

REFS = ["A", "B", "C", "D", "E", "F"]
ADDRS = [("1", "Main 1"), ("2", "Main 2"), ("3", "Main 3"), (None, None)]
NAMES = ["n1", "n2"]

station = st.tuples(st.sampled_from(NAMES), st.sampled_from(ADDRS))
snapshot = st.dictionaries(st.sampled_from(REFS), station, min_size=1, max_size=5)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(snapshot, min_size=2, max_size=3))
def test_history_invariants(spark, days):
    dim = sd.empty_dim(spark)
    cur_before = {}
    for i, snap in enumerate(days):
        ts = dt.datetime(2024, 5, 1 + i, 6)
        rows = [(ref, name, "X", a[0], a[1]) for ref, (name, a) in sorted(snap.items())]
        dim = sd.apply_snapshot(dim, sd.snapshot_rows(stations(spark, rows), ts.date()), ts).cache()
        all_rows = dim.collect()
        current = [r for r in all_rows if r.is_current]
        # At most one current row per station, and one per listed identifier
        assert len({r.pickup_station_id for r in current}) == len(current) == len(snap)
        assert {r.ref_identifier for r in current} == set(snap)
        # a station whose identifier stays listed keeps its id
        now = {r.ref_identifier: r.pickup_station_id for r in current}
        for ref, sid in cur_before.items():
            if ref in now:
                assert now[ref] == sid
        cur_before = now
        # validity intervals of one station do not overlap; removed rows are inactive
        by_id = {}
        for r in all_rows:
            by_id.setdefault(r.pickup_station_id, []).append(r)
        for versions in by_id.values():
            versions.sort(key=lambda r: r.pickup_station_sk)
            for a, b in zip(versions, versions[1:]):
                assert a.valid_to is not None and a.valid_to <= b.valid_from
        assert all(r.is_active for r in current)
        assert dim.where(~F.col("is_current") & F.col("valid_to").isNull()).count() == 0
