"""Column expressions against plain-Python statements of the same rules."""

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from depotlens.functions.text import norm_text, record_hash
from depotlens.operators.matching import match_stations
from depotlens.operators import station_dim
from helpers import D1, T1, stations

TEXT = st.text(alphabet=st.sampled_from(list("abcXYZ  \t\n-.")), max_size=12)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), min_size=1, max_size=60))
def test_norm_text_rule(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = {r.i: r.n for r in df.select("i", norm_text("v").alias("n")).collect()}
    for i, v in enumerate(values):
        want = None if v is None else (" ".join(v.split()).upper() or None)
        assert got[i] == want


def test_record_hash_rule(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05.000006", "a", None)], "t string, x string, y string") \
              .withColumn("t", F.col("t").cast("timestamp_ntz"))
    got = df.select(record_hash("complaints", "t", ["x", "y"]).alias("h")).first().h
    micros = 1704164645000006
    text = "\x1f".join(["complaints", str(micros), "a", "\x1e"])
    assert got == hashlib.sha256(text.encode()).hexdigest()


def test_station_match_crosswalk_and_ties(spark):
    dim = station_dim.apply_snapshot(
        station_dim.empty_dim(spark),
        station_dim.snapshot_rows(stations(spark, [("PS42", "a", "c", "1", "s1"), ("PSN42", "b", "c", "2", "s2"),
                                                   ("QS7", "q", "c", "3", "s3"), ("PT7", "t", "c", "4", "s4"),
                                                   ("PA7", "u", "c", "5", "s5")]), D1),
        T1)
    ids = spark.createDataFrame([("S-000042",), ("P-7",), ("WAREHOUSE-7",), ("S-000042",), ("zz",), (None,), ("K-9",)], "e string")
    cw = spark.createDataFrame([("K-9", "QS7")], "external_id string, ref_identifier string")
    got = {r.external_id: (r.ref_identifier, r.match_method, r.score)
           for r in match_stations(ids, dim, crosswalk=cw).collect()}
    assert got["S-000042"] == ("PS42", "fuzzy", 1)
    assert got["P-7"] == ("PA7", "fuzzy", 1)  # tie on score 1: smaller reference wins
    assert got["WAREHOUSE-7"] == (None, None, None)  # too far from every station
    assert got["K-9"] == ("QS7", "crosswalk", None)
    assert got["zz"] == (None, None, None) and None not in got
