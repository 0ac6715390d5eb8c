"""Rows loaded onto an existing fact stay where they are (round 6: disk
finding), with the same rows and keys."""

import datetime as dt

import pytest
from pyspark.sql.readwriter import DataFrameWriter

from depotlens.operators import facts as fx
from depotlens.operators import staging
from depotlens.plans.scenario import Scenario
from depotlens.session import written
from depotlens.sources.store import Store

T = dt.datetime(2024, 3, 1)
TEXTS = ("pickup_station_external_id", "driver_id", "parcel_id", "purchase_order_id", "recipient_name", "recipient_address",
         "recipient_name_norm", "recipient_address_norm")
STAGED = "file_id long, record_index int, record_hash_sha256 string, delivered_at timestamp_ntz, " + ", ".join(f"{c} string" for c in TEXTS) + \
    ", ingested_at timestamp_ntz"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def staged(spark, rows):
    return written(spark.createDataFrame([(f, i, h, T.replace(month=1 + (f or 0) % 3), *[None] * len(TEXTS), T) for f, i, h in rows], STAGED))


def loaded(spark, old, new):
    """What a load of ``new`` adds to the fact of ``old``, and the fact."""
    fact = written(fx.load_facts(None, staged(spark, old), "delivery_events", T))
    return fx.load_facts(fact, staged(spark, new), "delivery_events", T), fact


def found(rows):
    return sorted((r.delivery_event_sk, r.file_id, r.record_hash_sha256) for r in rows.collect())


@pytest.fixture()
def little(spark):
    """A session that broadcasts nothing by itself."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield spark
    spark.conf.set(name, old)


HEX = [f"{i:064x}" for i in range(12)]
# hex, odd, upper case, no hex, empty; far places, places without record, rows without hash or place, copies
OLD = [(1, 0, HEX[10]), (1, 1, HEX[11]), (1, 2, "ab"), (2, 70000, "x y"), (2, 70001, "abc"), (3, 5, "")]
NEW = [*OLD, (1, 3, "AB"), (1, 5, "0ab"), (4, 0, HEX[1]), (2, 32768, HEX[2]), (2, 0, HEX[3]), (2, 70002, HEX[10].upper()),
       (5, 0, HEX[3]), (5, 1, HEX[10]), (5, 2, HEX[4]), (None, 1, HEX[5]), (5, None, HEX[6]), (5, 3, None)]
WANT = [(7, 1, "AB"), (8, 1, "0ab"), (9, 2, HEX[3]), (10, 2, HEX[2]), (11, 2, HEX[10].upper()), (12, 4, HEX[1]), (13, 5, HEX[4])]


def test_rows_do_not_move_onto_an_existing_fact(little):
    got, fact = loaded(little, OLD, NEW)
    assert "SortMergeJoin" not in plan(got) and "rangepartitioning" not in plan(got) and "hashpartitioning" not in plan(got)
    assert [r[0] for r in found(fact)] == list(range(1, 7)) and found(got) == WANT


def test_large_bitmaps_give_the_same_rows(little, monkeypatch):
    monkeypatch.setattr(staging, "BROADCAST_BYTES", 0)
    assert staging.without_known(staged(little, NEW), staged(little, OLD)) is None
    assert found(loaded(little, OLD, NEW)[0]) == WANT


def test_rows_that_share_the_place_of_a_known_one_are_kept(little):
    new = [(1, 0, HEX[0]), (1, 0, HEX[1]), (1, 1, HEX[2])]
    assert staging.without_known(staged(little, new), staged(little, new[:1])) is None
    got = loaded(little, new[:1], new)[0]
    assert found(got) == [(2, 1, HEX[1]), (3, 1, HEX[2])]
    # the same row twice in a place is known or not as one
    again = staging.without_known(staged(little, [*new[1:], new[2]]), staged(little, new[2:]))
    assert [r.record_hash_sha256 for r in again.collect()] == [HEX[1]]


def test_nothing_or_all_is_known(little):
    for known, want in (([], 6), (OLD, 0)):
        assert staging.without_known(staged(little, OLD), staged(little, known)).count() == want


def test_second_load_writes_the_rows_where_they_lie(spark, tmp_path, monkeypatch):
    plans, parquet = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **k: (
        plans.append(plan(self._df)) if "/second_load_" in path else None, parquet(self, path, *a, **k))[1])
    sc = Scenario(spark, str(tmp_path / "no tables here"), Store(spark))
    sc.__dict__["staged_raw_deliveries"] = staged(spark, [(f, i, f"{f}{i:063x}") for f in (1, 2, 3, 4) for i in range(50)] + [(4, 50, f"{1}{0:063x}")])
    got = sc.second_load("delivery_events")
    assert len(plans) == 2 and not any("Exchange" in p.replace("BroadcastExchange", "") for p in plans)
    assert [(r[0], r[1]) for r in found(got)] == [(1 + 50 * (f - 1) + i, f) for f in (1, 2, 3, 4) for i in range(50)]


def test_a_pipeline_load_writes_the_rows_where_they_lie(spark, monkeypatch):
    from depotlens.plans.pipeline import Pipeline

    plans, parquet = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **k: (
        plans.append(plan(self._df)) if "/fact_delivery_event/" in path else None, parquet(self, path, *a, **k))[1])
    p = Pipeline(spark)
    for rows in (OLD, NEW):
        got = p.load_facts("delivery_events", staged(spark, rows), T)
    assert len(plans) == 2 and not any("Exchange" in x.replace("BroadcastExchange", "") for x in plans)
    assert found(got)[6:] == WANT
    # rows are observed once, while they are written
    p.write_volumes(T.date())
    assert [r["value"] for r in p.volumes().where("metric = 'rows_loaded'").collect()] == [len(OLD) + len(WANT)]
