"""Steps that hold no more than a few rows in memory at once (round 6: memory
findings), with the same results."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from depotlens.session import written
from depotlens.sources import testdata as td
from depotlens.sources.files import write_landing

DAY = dt.date(2024, 3, 1)


@pytest.fixture()
def sunk(monkeypatch):
    """The frames that the text sink gets."""
    frames, text = [], DataFrameWriter.text
    monkeypatch.setattr(DataFrameWriter, "text", lambda self, *a, **k: (frames.append(self._df), text(self, *a, **k))[1])
    return frames


def texts(root):
    return {p.name: p.read_text() for p in Path(root).glob("*/*/*") if not p.name.endswith(".crc")}


def test_lines_of_landing_files_are_rows(spark, tmp_path, sunk):
    n = 500
    rows = written(spark.range(n).select(F.lit(DAY).alias("ingest_dt"), F.explode(F.array(*map(F.lit, ("csv", "json", "xml")))).alias("source_format"),
                                         (F.lit(n) - F.col("id")).alias("k"), F.col("id").cast("string").alias("what")))
    write_landing(rows, str(tmp_path), "complaints", ["k", "what"], "", ["k"], part=F.lit(0), damage_day=DAY)
    tree = sunk[0]._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in tree and tree.count("Sort [") == 1
    # a row per record, the broken copies, and first and last lines (three of two files each)
    assert sunk[0].count() == 3 * n + 3 + 2 * 3
    assert sunk[0].agg(F.max(F.length("value"))).first()[0] < 100
    got = texts(tmp_path)
    assert got["complaints_20240301_0.csv"] == "\n".join(["k,what", *[f"{k},{n - k}" for k in range(1, n + 1)], ""])
    assert got["complaints_20240301_0.json"] == "".join(f'{{"k":{k},"what":"{n - k}"}}\n' for k in range(1, n + 1))
    xml = got["complaints_20240301_0.xml"]
    assert xml.startswith("<records>\n<record>") and xml.endswith("</record>\n</records>\n") and xml.count("<k>") == n
    assert got["complaints_20240301_2.csv"] == f"k,what\n1,{n - 1},EXTRA\n"
    assert got["complaints_20240301_2.json"] == f'{{"k":1,"what":"{n - 1}"\n'
    assert got["complaints_20240301_2.xml"].count("<record>") == 1 and "</record>" not in got["complaints_20240301_2.xml"]


def test_fields_made_after_the_move_give_the_same_files(spark, tmp_path, sunk):
    line = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, " \
           "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz, c_name string, c_mktsegment string, c_nationkey int"
    t = dt.datetime(2024, 3, 5)
    some = [(o, i, 1, 3, 1.0, 1.0, 0.0, 0.0, "N", None, t, name, "M", 1) for o in (2, 1, 3) for i in (1, 2, 4, None) for name in ("Bo, B.", None, "Ann")]
    rows = written(spark.createDataFrame([*some, (1, 1, 1, 3, 1.0, 1.0, 0.0, 0.0, "N", None, None, "no day", "M", 1)], line))
    order, fields = td.DELIVERY_FILE_ORDER, ["delivered_at", "driver_id", "parcel_id", "recipient_name", "recipient_address"]
    for name, records, more in (("a", td.with_delivery_fields(rows), {}), ("b", rows, {"derived": td.delivery_fields()})):
        write_landing(records, str(tmp_path / name), "delivery_events", fields, "delivered_at", order, part=F.col("l_linenumber") % 2, damage_day=DAY, **more)
    assert texts(tmp_path / "a") == texts(tmp_path / "b") and len(texts(tmp_path / "a")) == 5
    # the fields are made above the move
    tree = sunk[1]._jdf.queryExecution().executedPlan().toString()
    assert -1 < tree.rfind(" AS parcel_id") < tree.index("Exchange hashpartitioning")
