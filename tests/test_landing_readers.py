"""Ledger (L1-L4) and file readers (L5-L7) on hand-written files."""

import datetime as dt
import os

import pytest

from pyspark.sql import functions as F

from depotlens.operators import landing
from depotlens.plans.pipeline import Pipeline
from depotlens.schemas import COMPLAINT_FIELDS, FILE_LISTING
from helpers import T1, T2

HEADER = ("complained_at,pickup_station_external_id,recipient_name,recipient_address,"
          "parcel_id,purchase_order_id,complaint_text")


def listing(spark, rows):
    return spark.createDataFrame(rows, FILE_LISTING)


def test_register_once_and_resent_file_is_new(spark):
    m = dt.datetime(2024, 3, 1, 5, 0)
    a = ("complaints", "x/a.json", m, 10, "landing/complaints/ingest_dt=2024-03-01/a.json")
    b = ("complaints", "x/b.csv", m, 20, "landing/complaints/ingest_dt=2024-03-01/b.csv")
    led = landing.register_files(landing.empty_ledger(spark), listing(spark, [a, b, a]), T1).cache()
    assert sorted((r.file_id, r.source_file_path, r.status) for r in led.collect()) == \
        [(1, "x/a.json", "RECEIVED"), (2, "x/b.csv", "RECEIVED")]
    a2 = ("complaints", "x/a.json", m, 11, a[4])  # same path, new size
    led2 = landing.register_files(led, listing(spark, [a, b, a2]), T2).cache()
    assert led2.count() == 3
    new = led2.where("file_id = 3").first()
    assert new.file_size_bytes == 11 and new.received_at == T2 and new.parsed_at is None


def test_batch_claim_outcomes(spark):
    m = dt.datetime(2024, 3, 1, 5, 0)
    rows = [("complaints", f"x/{i}.json", m, i, f"l/{i}.json") for i in range(5)]
    led = landing.register_files(landing.empty_ledger(spark), listing(spark, rows), T1).cache()
    batch = landing.next_batch(led, 3)
    assert [r.file_id for r in batch.orderBy("file_id").collect()] == [1, 2, 3]
    led = landing.claim(led, batch).cache()
    assert led.where("status = 'PARSING'").count() == 3
    out = spark.createDataFrame([(1, True, None), (2, False, "bad")], "file_id long, ok boolean, error_message string")
    led = landing.apply_outcomes(led, out, T2).cache()
    got = {r.file_id: (r.status, r.parsed_at, r.error_message) for r in led.collect()}
    assert got[1] == ("PARSED", T2, None) and got[2] == ("FAILED", None, "bad")
    assert got[3][0] == "PARSING" and got[4][0] == "RECEIVED"
    assert landing.release_stale_claims(led).where("status = 'PARSING'").count() == 0


def _write(root, name, text):
    d = os.path.join(root, "complaints", "ingest_dt=2024-03-01")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as f:
        f.write(text)


def test_readers_fail_whole_files_and_keep_empty_ones(spark, tmp_root):
    good_csv = HEADER + "\n2024-03-01 10:00:00,PS1, anna ,Street 1,P1,O1,\"late, \"\"very\"\"\"\n" \
                        "not a time,PS2,Bob,Street 2,P2,O2,lost\n"
    _write(tmp_root, "good.csv", good_csv)
    _write(tmp_root, "long.csv", HEADER + "\n2024-03-01 10:00:00,PS1,A,S,P,O,t,EXTRA\n")
    swapped = "pickup_station_external_id,complained_at" + HEADER[HEADER.index(",recipient_name"):]
    _write(tmp_root, "swapped.csv", swapped + "\nPS1,2024-03-01 10:00:00,A,S,P,O,t\n")
    _write(tmp_root, "header_only.csv", HEADER + "\n")
    _write(tmp_root, "good.json", '{"complained_at":"2024-03-01 11:00:00","recipient_name":"Carl"}\n'
                                  '{"complained_at":"2024-03-01 12:00:00","recipient_name":"Dora"}\n')
    _write(tmp_root, "broken.json", '{"complained_at":"2024-03-01 11:00:00"}\n{"recipient_name": \n')
    _write(tmp_root, "empty.json", "")
    _write(tmp_root, "brackets.json", "[]\n")
    _write(tmp_root, "good.xml", "<records>\n<record><recipient_name> Eve</recipient_name>"
                                 "<complained_at>2024-03-01 13:00:00</complained_at></record>\n</records>\n")
    _write(tmp_root, "half.xml", "<records>\n<record><recipient_name>F</recipient_name></record>\n"
                                 "<record><recipient_name>G</recipient_name>\n</records>\n")
    p = Pipeline(spark)
    added = p.ingest(tmp_root, T1, systems=("complaints",))
    led = {os.path.basename(r.landing_file_path): (r.status, r.error_message) for r in p.ledger().collect()}
    assert led["good.csv"] == ("PARSED", None)
    assert led["long.csv"][0] == "FAILED" and led["long.csv"][1].startswith("CORRUPT_RECORDS")
    assert led["swapped.csv"] == ("FAILED", "HEADER_MISMATCH")
    assert led["header_only.csv"] == ("PARSED", None)
    assert led["empty.json"] == ("PARSED", None)
    assert led["brackets.json"] == ("PARSED", None)
    assert led["broken.json"][0] == "FAILED" and led["half.xml"][0] == "FAILED"
    assert led["good.json"] == ("PARSED", None) and led["good.xml"] == ("PARSED", None)
    rows = added["complaints"].join(p.ledger().select("file_id", "landing_file_path"), "file_id").collect()
    by = {(os.path.basename(r.landing_file_path), r.record_index): r for r in rows}
    assert len(rows) == 5  # 2 csv + 2 json + 1 xml
    first = by[("good.csv", 0)]
    assert first.recipient_name == " anna " and first.recipient_name_norm == "ANNA"
    assert first.complaint_text == 'late, "very"' and first.complained_at == dt.datetime(2024, 3, 1, 10)
    assert by[("good.csv", 1)].complained_at is None  # unreadable time kept as null (K14)
    assert by[("good.json", 1)].recipient_name == "Dora"
    assert by[("good.xml", 0)].recipient_name == " Eve"
    # a second run finds nothing new
    again = p.ingest(tmp_root, T2, systems=("complaints",))
    assert again == {} and p.ledger().count() == 10


def test_record_index_across_splits(spark, tmp_root):
    """A JSON Lines file larger than the split size is read by several
    tasks; positions still follow the file."""
    n = 3000
    lines = "\n".join('{"complained_at":"2024-03-01 10:00:00","parcel_id":"P%05d"}' % i for i in range(n))
    _write(tmp_root, "big.json", lines + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        p = Pipeline(spark)
        added = p.ingest(tmp_root, T1, systems=("complaints",))
        got = {r.record_index: r.parcel_id for r in added["complaints"].collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == {i: "P%05d" % i for i in range(n)}


def test_event_ledger_view_equals_update_semantics(spark):
    m = dt.datetime(2024, 3, 1, 5, 0)
    rows = [("complaints", f"x/{i}.json", m, i, f"l/{i}.json") for i in range(4)]
    led = landing.register_files(landing.empty_ledger(spark), listing(spark, rows), T1).cache()
    batch = landing.next_batch(led, 3)
    out = spark.createDataFrame([(1, True, None), (2, False, "bad"), (3, True, None)],
                                "file_id long, ok boolean, error_message string")
    want = landing.apply_outcomes(landing.claim(led, batch), out, T2)
    files = led.select(*landing.FILE_COLUMNS)
    events = landing.claim_events(batch, T2).unionByName(landing.outcome_events(out, T2))
    got = landing.ledger_view(files, events)
    cols = landing.LEDGER_COLUMNS
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))
    # a dead run's claim is released at the next run
    stale = landing.ledger_view(files, landing.claim_events(batch, T1))
    rel = landing.ledger_view(files, landing.claim_events(batch, T1).unionByName(landing.release_events(stale, T2)))
    assert rel.where("status = 'RECEIVED'").count() == 4


def test_files_in_old_arrival_folders_are_listed(spark, tmp_root):
    from depotlens.sources.files import list_landing

    for day in ("2024-02-01", "2024-02-27", "2024-03-01"):
        d = os.path.join(tmp_root, "complaints", f"ingest_dt={day}")
        os.makedirs(d, exist_ok=True)
        with open(os.path.join(d, "a.json"), "w") as f:
            f.write("")
    assert list_landing(spark, tmp_root, "complaints").count() == 3
    assert list_landing(spark, tmp_root, "delivery_events").count() == 0


def test_odd_names_missing_and_unreadable_files(spark, tmp_root):
    row = '{"complained_at":"2024-03-01 11:00:00","recipient_name":"%s"}\n'
    names = ["with space.json", "pct%20x.json", "brack[1].json", "a+b.json", "star{1,2}.json", "plain.json"]
    for n in names:
        _write(tmp_root, n, row % n)
    _write(tmp_root, "sp ace.csv", HEADER + "\n2024-03-01 10:00:00,PS1,csv,S,P,O,t\n")
    _write(tmp_root, "x[2] %41.xml", "<records><record><recipient_name>xml</recipient_name></record></records>")
    _write(tmp_root, "gone.json", row % "gone")
    day = os.path.join(tmp_root, "complaints", "ingest_dt=2024-03-01")
    p = Pipeline(spark)
    from depotlens.sources import readers
    exists = readers._exists
    try:  # the file goes away between the listing and the read
        readers._exists = lambda s, path: "gone" not in path and exists(s, path)
        added = p.ingest(tmp_root, T1, systems=("complaints",))["complaints"]
    finally:
        readers._exists = exists
    led = {os.path.basename(r.landing_file_path): (r.status, r.error_message) for r in p.ledger().collect()}
    assert led.pop("gone.json")[0] == "FAILED"
    assert set(led.values()) == {("PARSED", None)} and len(led) == 8
    assert sorted(r.recipient_name for r in added.collect()) == sorted([*names, "csv", "xml"])
    assert p.ingest(tmp_root, T2, systems=("complaints",)) == {}
    assert os.path.isdir(day)


def test_one_unreadable_file_fails_alone(spark, tmp_root, monkeypatch):
    from depotlens.sources import readers

    for i in range(5):
        _write(tmp_root, f"f{i}.json", '{"complained_at":"2024-03-01 11:00:00","recipient_name":"r%d"}\n' % i)
    real = readers.read_records

    def read(spark, by_fmt, fields, options=None):
        if any("f3" in p for ps in by_fmt.values() for p in ps):
            raise OSError("[FAILED_READ_FILE.NO_HINT] cannot open f3")
        return real(spark, by_fmt, fields, options)

    monkeypatch.setattr(readers, "read_records", read)
    p = Pipeline(spark)
    added = p.ingest(tmp_root, T1, systems=("complaints",))["complaints"]
    led = {os.path.basename(r.landing_file_path): (r.status, r.error_message) for r in p.ledger().collect()}
    assert led["f3.json"] == ("FAILED", "UNREADABLE: [FAILED_READ_FILE.NO_HINT] cannot open f3")
    assert sorted(r.recipient_name for r in added.collect()) == ["r0", "r1", "r2", "r4"]


def test_a_lost_cluster_fails_no_file(spark, tmp_root, monkeypatch):
    """An error of the cluster ends the run; its files are read by the next one."""
    from depotlens.sources import readers

    for i in range(3):
        _write(tmp_root, f"f{i}.json", '{"complained_at":"2024-03-01 11:00:00","recipient_name":"r%d"}\n' % i)
    real = readers.read_records

    def lost(spark, by_fmt, fields, options=None):
        raise RuntimeError("Job aborted due to stage failure: ExecutorLostFailure (executor 3 exited); [FAILED_READ_FILE.NO_HINT] f1")

    monkeypatch.setattr(readers, "read_records", lost)
    p = Pipeline(spark)
    with pytest.raises(RuntimeError, match="ExecutorLost"):
        p.ingest(tmp_root, T1, systems=("complaints",))
    assert {r.status for r in p.ledger().collect()} == {"PARSING"}
    monkeypatch.setattr(readers, "read_records", real)
    added = p.ingest(tmp_root, T2, systems=("complaints",))["complaints"]
    assert added.count() == 3 and {r.status for r in p.ledger().collect()} == {"PARSED"}


@pytest.mark.parametrize("text, expected", [
    ("[FAILED_READ_FILE.FILE_NOT_EXIST] x", True), ("java.io.EOFException", True), ("not in gzip format", True),
    ("Job aborted: OutOfMemoryError while [FAILED_READ_FILE.NO_HINT]", False), ("No space left on device", False),
    ("some programming error", False)])
def test_which_errors_are_a_files_own(text, expected):
    from depotlens.sources.readers import is_file_error

    assert is_file_error(RuntimeError(text)) == expected


def test_arrays_over_lines_zones_and_unreadable_times(spark, tmp_root):
    _write(tmp_root, "array.json", '[\n  {\n    "complained_at": "2024-01-01T10:00:00+02:00",\n    "recipient_name": "A"\n  },\n'
                                   '  {"complained_at": "2024-01-01T10:00:00Z", "recipient_name": "B"}\n]\n')
    _write(tmp_root, "bad_array.json", '[\n  {"recipient_name": "C"},\n  {"recipient_name": \n]\n')
    _write(tmp_root, "times.json", '{"complained_at":"some day","recipient_name":"D"}\n{"complained_at":"other day","recipient_name":"D"}\n'
                                   '{"complained_at":"10:15","recipient_name":"D"}\n{"complained_at":"some day","recipient_name":"D"}\n')
    p = Pipeline(spark)
    rows = p.ingest(tmp_root, T1, systems=("complaints",))["complaints"].collect()
    led = {os.path.basename(r.landing_file_path): r.status for r in p.ledger().collect()}
    assert led == {"array.json": "PARSED", "bad_array.json": "FAILED", "times.json": "PARSED"}
    by = {r.recipient_name: r for r in rows}
    assert by["A"].complained_at == dt.datetime(2024, 1, 1, 8) and by["B"].complained_at == dt.datetime(2024, 1, 1, 10)
    assert (by["A"].record_index, by["B"].record_index) == (0, 1)
    unread = [r for r in rows if r.recipient_name == "D"]
    assert len(unread) == 3 and all(r.complained_at is None for r in unread)  # the repeated one is dropped


def test_two_layouts_in_one_claim(spark, tmp_root):
    """Other names, order, time format and a missing field; a partner's files
    with their columns in another order or with the standard ones fail alone."""
    from depotlens.sources.readers import Layout

    partner = Layout("/p_", {"recipient_name": "Name", "complained_at": "Zeit", "parcel_id": "Nr"}, "dd.MM.yyyy HH:mm")
    head = ",".join(COMPLAINT_FIELDS)
    _write(tmp_root, "s.csv", head + "\n" + ",".join("2024-03-01 11:00:00" if c == "complained_at" else c for c in COMPLAINT_FIELDS) + "\n")
    _write(tmp_root, "p_1.csv", "Name,Zeit,Nr\nAnna,02.03.2024 09:30,77\nBen,later,78\n")
    _write(tmp_root, "p_2.json", '{"Nr":"79","Name":"Cora","Zeit":"03.03.2024 10:00","parcel_id":"no field of theirs"}\n')
    _write(tmp_root, "p_3.csv", "Name,Nr,Zeit\nDora,80,04.03.2024 11:00\n")
    _write(tmp_root, "p_4.csv", head + "\n")
    p = Pipeline(spark, layouts={"complaints": [partner]})
    got = {r.recipient_name: r for r in p.ingest(tmp_root, T1, systems=("complaints",))["complaints"].collect()}
    assert set(got) == {"recipient_name", "Anna", "Ben", "Cora"}
    assert (got["Anna"].complained_at, got["Anna"].parcel_id, got["Anna"].complaint_text) == (dt.datetime(2024, 3, 2, 9, 30), "77", None)
    assert got["Ben"].complained_at is None and got["Cora"].parcel_id == "79"
    status = {os.path.basename(r.landing_file_path): (r.status, r.error_message) for r in p.ledger().collect()}
    assert status["p_3.csv"] == ("FAILED", "HEADER_MISMATCH") and status["p_4.csv"] == ("FAILED", "CORRUPT_RECORDS: 1")
    assert {status[n][0] for n in ("s.csv", "p_1.csv", "p_2.json")} == {"PARSED"}
