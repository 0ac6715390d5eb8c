"""Steps that every delivery takes move and write the wide rows no more often
than they must (round 3: disk findings), with the same results."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from depotlens.operators.ids import assign_ids
from depotlens.operators.staging import dedupe_staged, stage_from_files
from depotlens.plans.scenario import Scenario
from depotlens.session import written
from depotlens.sources import testdata as td
from depotlens.sources.store import Store

BATCH = "file_id long, record_index int, record_hash_sha256 string, what string"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedupe_leaves_the_rows_where_they_are(spark):
    batch = written(spark.createDataFrame(
        [(1, 0, "a", "kept"), (1, 1, "b", "kept"), (2, 0, "a", "copy"), (2, 1, "c", "kept"), (3, 0, "a", "copy"),
         (1, 1, "b", "kept"), (None, 0, "d", "no place"), (4, None, "e", "no place"), (4, 0, None, "no hash"),
         (None, 1, "c", "no place")], BATCH))
    got = dedupe_staged(batch)
    assert "hashpartitioning" not in plan(got)
    # a row that stands twice in one place is kept twice
    assert sorted(tuple(r) for r in got.collect()) == [(1, 0, "a", "kept"), (1, 1, "b", "kept"), (1, 1, "b", "kept"), (2, 1, "c", "kept")]
    old = spark.createDataFrame([("c",)], "record_hash_sha256 string")
    assert {r.record_hash_sha256 for r in dedupe_staged(batch, old).collect()} == {"a", "b"}


def test_numbered_rows_come_from_pruned_files(spark):
    got = assign_ids(spark.range(10).select(F.col("id").alias("k"), F.lit("wide").alias("w")), ["k"], "n")
    assert "ExistingRDD" not in plan(got)
    assert [(r.k, r.n) for r in got.orderBy("k").collect()] == [(i, i + 1) for i in range(10)]


def test_records_are_not_shuffled_to_find_their_file(spark):
    t = dt.datetime(2024, 3, 1)
    day = t.date()
    fields = "ingest_dt date, source_format string, k int, delivered_at timestamp_ntz, " + ", ".join(
        f"{c} string" for c in ("pickup_station_external_id", "driver_id", "parcel_id", "purchase_order_id", "recipient_name", "recipient_address"))
    rows = written(spark.createDataFrame([(day, f, i, t, *"sdpona") for i in range(4) for f in ("csv", "xml")], fields))
    files = spark.createDataFrame([(7, day, "csv"), (8, day, "xml"), (9, day, "csv")], "file_id long, ingest_dt date, source_format string")
    got = stage_from_files(rows, files, "delivery_events", ["k"], t)
    assert "SortMergeJoin" not in plan(got)
    assert sorted((r.file_id, r.record_index) for r in got.collect()) == [(f, i) for f in (7, 8, 9) for i in range(4)]


def test_complaints_are_loaded_without_staging_deliveries(spark, tmp_path):
    sc = Scenario(spark, str(tmp_path / "no tables here"), Store(spark))
    columns = "file_id long, record_index int, record_hash_sha256 string, complained_at timestamp_ntz, " + ", ".join(
        f"{c} string" for c in ("pickup_station_external_id", "recipient_name", "recipient_address", "parcel_id", "purchase_order_id",
                                "complaint_text", "recipient_name_norm", "recipient_address_norm")) + ", ingested_at timestamp_ntz"
    t = dt.datetime(2024, 3, 1)
    sc.__dict__["staged_raw_complaints"] = spark.createDataFrame(
        [(f, 0, h, t, *[None] * 8, t) for f, h in ((1, "a"), (2, "b"), (3, "a"))], columns)
    got = sc.second_load("complaints")
    assert sorted((r.complaint_sk, r.record_hash_sha256) for r in got.collect()) == [(1, "a"), (2, "b")]


@pytest.fixture()
def tables(spark, tmp_path):
    t = dt.datetime(2024, 3, 5)
    line = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, " \
           "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    spark.createDataFrame([(o, 1, 3, i, 1.0, 1.0, 0.0, 0.0, "N", "O", t) for i, o in enumerate([1, 1, 2, 3, 4, None])], line) \
        .write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(1, 10), (2, 11), (2, 12), (3, None), (None, 10)], "o_orderkey long, o_custkey long") \
        .write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame([(10, "Ann", "M", 1), (11, "Bo", "M", 1), (11, "Cy", "M", 1), (None, "Di", "M", 1)],
                          "c_custkey long, c_name string, c_mktsegment string, c_nationkey int") \
        .write.parquet(str(tmp_path / "customer.parquet"))
    return str(tmp_path)


def test_line_items_move_once(spark, tables):
    got = td.delivery_records(spark, tables)
    assert "RoundRobin" not in plan(got) and plan(got).count("SortMergeJoin") == 1
    # orders and customers that stand twice give a row each, unknown ones none
    rows = sorted((r.l_linenumber, r.recipient_name or "") for r in got.collect())
    assert rows == [(0, "Ann"), (1, "Ann"), (2, ""), (2, "Bo"), (2, "Cy"), (3, ""), (4, ""), (5, "")]


def test_records_without_part_make_no_file(spark, tmp_path):
    from depotlens.sources.files import list_landing, write_landing

    day = dt.date(2024, 3, 1)
    rows = spark.createDataFrame([(day, "csv", 1, 0), (day, "csv", 2, None), (None, "xml", 3, 0), (day, None, 4, 0)],
                                 "ingest_dt date, source_format string, k int, p int")
    write_landing(rows, str(tmp_path), "complaints", ["k"], "", ["k"], part=F.col("p"), damage_day=day)
    names = sorted(r.source_file_path.rsplit("/", 1)[1] for r in list_landing(spark, str(tmp_path), "complaints").collect())
    assert names == ["complaints_20240301_0.csv", "complaints_20240301_2.csv"]


def test_lines_of_landing_files_are_made_after_the_move(spark, tmp_path, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    from depotlens.sources.files import write_landing

    plans, text = [], DataFrameWriter.text
    monkeypatch.setattr(DataFrameWriter, "text", lambda self, *a, **k: (plans.append(plan(self._df)), text(self, *a, **k))[1])
    day = dt.date(2024, 3, 1)
    rows = written(spark.createDataFrame([(day, f, k, p, None if k == 3 else "a, b") for f in ("csv", "json", "xml") for k in (3, 1, 2) for p in (0, 1)],
                                         "ingest_dt date, source_format string, k int, p int, what string"))
    write_landing(rows, str(tmp_path), "complaints", ["k", "what"], "", ["k"], part=F.col("p"))
    # one move of the records; the lines are above it
    assert plans[0].count("Exchange hashpartitioning") == 1 and plans[0].index("to_csv") < plans[0].index("Exchange hashpartitioning")
    read = {p.suffix: p.read_text().rstrip("\n").split("\n") for p in tmp_path.glob("complaints/*/complaints_*_0.*")}
    assert read[".csv"] == ["k,what", '1,"a, b"', '2,"a, b"', "3,"]
    assert read[".json"] == ['{"k":1,"what":"a, b"}', '{"k":2,"what":"a, b"}', '{"k":3}']
    assert read[".xml"][0] == "<records>" and read[".xml"][-1] == "</records>"
    assert [line.strip() for line in read[".xml"] if "<k>" in line] == ["<k>1</k>", "<k>2</k>", "<k>3</k>"]
