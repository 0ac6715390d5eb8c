"""The two-day test scenario over the driver's tables (FIXTURES.md).

Day 1 (2024-01-30): files registered, staged and loaded; station list loaded
as first history; complaints linked. Day 2 (2024-01-31): re-sent files
registered; day-2 station list applied; unlinked complaints retried.
Reports are asked for as of 2024-01-31.

Every state table is written to the store once and read back, so each query
starts from written tables instead of one long lineage. A scenario is shared
by all queries of one session and one input folder.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotlens.operators import facts as fx
from depotlens.operators import landing, staging, station_dim
from depotlens.operators.monitoring import complaint_monitoring, upsert_by_date
from depotlens.sources import testdata as td
from depotlens.sources.store import Store, lie_by

_CACHE: dict = {}
_LOCK = threading.Lock()


def scenario(spark: SparkSession, sf_dir: str) -> "Scenario":
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _LOCK:
        if key not in _CACHE:
            _CACHE[key] = Scenario(spark, sf_dir)
        return _CACHE[key]


class _lazy:
    """Compute an attribute once (the store keeps the written result)."""

    def __init__(self, fn):
        self.fn, self.name = fn, fn.__name__

    def __get__(self, obj, owner=None):
        if obj is None:
            return self
        # one step at a time per scenario (queries may come from several
        # threads); re-entrant because steps ask for earlier steps
        with obj._step_lock:
            if self.name not in obj.__dict__:
                obj.__dict__[self.name] = self.fn(obj)
        return obj.__dict__[self.name]


class Scenario:
    def __init__(self, spark: SparkSession, sf_dir: str, store: Store | None = None):
        self.spark, self.sf_dir = spark, sf_dir
        self.store = store or Store(spark)
        self._step_lock = threading.RLock()

    # ---------------------------------------------------------------- inputs
    # The derived inputs are written once: every later step reads them
    # instead of joining the test tables again.
    @_lazy
    def complaint_records(self) -> DataFrame:
        return self.store.put("complaint_records", td.complaint_records(self.spark, self.sf_dir))

    @_lazy
    def delivery_rows(self) -> DataFrame:
        return self.store.put("delivery_records", td.delivery_rows(self.spark, self.sf_dir))

    @_lazy
    def delivery_records(self) -> DataFrame:
        return td.with_delivery_fields(self.delivery_rows)

    @_lazy
    def listing_day1(self) -> DataFrame:
        c = td.derived_listing(self.complaint_records, "complaints", "received_at")
        d = td.derived_listing(self.delivery_records, "delivery_events", "delivered_at")
        return c.unionByName(d)

    @_lazy
    def listing_resent(self) -> DataFrame:
        return td.resent_listing(td.derived_listing(self.complaint_records, "complaints", "received_at"))

    # ---------------------------------------------------------------- ledger
    @_lazy
    def ledger_day1(self) -> DataFrame:
        led = landing.register_files(landing.empty_ledger(self.spark), self.listing_day1, td.RUN1)
        return self.store.put("ledger", led)

    @_lazy
    def ledger(self) -> DataFrame:
        """Ledger after day 2: the day-1 listing is seen again with the
        re-sent files; only the re-sent ones are new."""
        listing = self.listing_day1.unionByName(self.listing_resent)
        led = landing.register_files(self.ledger_day1, listing, td.RUN2)
        return self.store.put("ledger", led)

    @_lazy
    def files(self) -> DataFrame:
        """(file_id, source_system, ingest_dt, source_format) of every file."""
        listing = self.listing_day1.unionByName(self.listing_resent)
        key = ["source_system", "source_file_path", "source_modified_at", "file_size_bytes"]
        return self.ledger.join(listing.select(*key, "ingest_dt", "source_format"), key) \
                   .select("file_id", "source_system", "ingest_dt", "source_format")

    # --------------------------------------------------------------- staging
    def _files_of(self, system: str) -> DataFrame:
        return self.files.where(F.col("source_system") == system)

    @_lazy
    def staged_raw_complaints(self) -> DataFrame:
        return staging.stage_from_files(self.complaint_records, self._files_of("complaints"), "complaints",
                                        td.COMPLAINT_FILE_ORDER, td.RUN1)

    @_lazy
    def staged_raw_deliveries(self) -> DataFrame:
        return staging.stage_from_files(self.delivery_rows, self._files_of("delivery_events"),
                                        "delivery_events", td.DELIVERY_FILE_ORDER, td.RUN1, td.delivery_fields())

    @_lazy
    def stg_complaint(self) -> DataFrame:
        return self.store.put("stg_complaint", staging.dedupe_staged(self.staged_raw_complaints))

    @_lazy
    def stg_delivery(self) -> DataFrame:
        # the written rows without the written places to drop
        return staging.dedupe_staged(self.staged_raw_deliveries)

    # ------------------------------------------------------------- stations
    @_lazy
    def snap1(self) -> DataFrame:
        snap = station_dim.snapshot_rows(td.station_list_day1(self.spark, self.sf_dir), td.DAY1)
        return self.store.put("snapshot_day1", snap)

    @_lazy
    def snap2(self) -> DataFrame:
        snap = station_dim.snapshot_rows(td.station_list_day2(self.spark, self.sf_dir), td.DAY2)
        return self.store.put("snapshot_day2", snap)

    @_lazy
    def snapshots(self) -> DataFrame:
        """Staging snapshot table after day 1, day 2 and a re-run of day 2
        with the day-1 list (D1 upsert: overlapping keys replaced, others kept)."""
        t = station_dim.upsert_snapshot(station_dim.empty_snapshot(self.spark), self.snap1)
        t = self.store.put("stg_pickup_station", t)
        t = self.store.put("stg_pickup_station", station_dim.upsert_snapshot(t, self.snap2))
        rerun = station_dim.snapshot_rows(td.station_list_day1(self.spark, self.sf_dir), td.DAY2)
        return self.store.put("stg_pickup_station", station_dim.upsert_snapshot(t, rerun))

    @_lazy
    def dim1(self) -> DataFrame:
        d = station_dim.first_load(self.spark, self.snap1, td.RUN1)
        return self.store.put("dim_pickup_station", d, partition_by=["is_current"])

    @_lazy
    def dim2_parts(self) -> dict:
        parts: dict = {}
        d = station_dim.apply_snapshot(self.dim1, self.snap2, td.RUN2, parts=parts)
        parts["dim"] = self.store.put("dim_pickup_station", d, partition_by=["is_current"])
        return parts

    @property
    def dim2(self) -> DataFrame:
        return self.dim2_parts["dim"]

    @_lazy
    def partner_list(self) -> DataFrame:
        return self.store.put("partner_stations", td.partner_stations(self.spark, self.sf_dir))

    # ----------------------------------------------------------------- facts
    @_lazy
    def fact_complaint(self) -> DataFrame:
        # Each complaint counts as loaded when it was made (M1 load date).
        created = F.coalesce(F.col("complained_at"), F.lit(td.RUN1.isoformat(sep=" ")).cast("timestamp_ntz"))
        rows = fx.load_facts(None, self.stg_complaint, "complaints", td.RUN1, created_at=created)
        return self.store.append("fact_complaint", rows, partition_by=["complained_month"], sort_by=["complained_at"],
                                 deal=not lie_by(rows, "complained_month"))

    @_lazy
    def fact_delivery(self) -> DataFrame:
        rows = fx.load_facts(None, self.stg_delivery, "delivery_events", td.RUN1)
        return self.store.append("fact_delivery_event", rows, partition_by=["delivered_month"], sort_by=["delivered_at"],
                                 deal=not lie_by(rows, "delivered_month"))

    def first_half(self, raw: DataFrame) -> DataFrame:
        """The rows of the first half of the files that hold any (by file id)."""
        middle = raw.select("file_id").distinct().agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY file_id)")).first()[0]
        return raw.where(F.col("file_id") <= F.lit(middle))

    @_lazy
    def first_hashes(self) -> DataFrame:
        """The hashes of the first half of the files, bucketed by hash."""
        old = self.first_half(self.staged_raw_complaints).select("record_hash_sha256").distinct()
        return self.store.append_bucketed("staged_hashes", old, "record_hash_sha256", 16).hint("merge")

    @_lazy
    def history(self) -> DataFrame:
        """The station history after both days as stored by changes: current
        rows as a version, closed rows added once (D10)."""
        none = station_dim.empty_dim(self.spark)
        first = station_dim.apply_changes(none, self.snap1, td.RUN1, 0, 0)
        self.store.put_history("station_history", first["current"], first["newly_closed"])
        top = first["current"].agg(F.max("pickup_station_id"), F.max("pickup_station_sk")).first()
        second = station_dim.apply_changes(self.store.version("station_history"), self.snap2, td.RUN2, *top)
        return self.store.put_history("station_history", second["current"], second["newly_closed"])

    def second_load(self, system: str) -> DataFrame:
        """The fact after two loads: the first half of the files, then all
        rows of all files again."""
        # the other system's rows are not staged for it
        raw = self.staged_raw_complaints if system == "complaints" else self.staged_raw_deliveries
        name, month = f"second_load_{system}", fx.SPECS[system]["month"]
        if not self.store.has(name):
            first = None
            for staged, run_ts in ((self.first_half(raw), td.RUN1), (raw, td.RUN2)):
                rows = fx.load_facts(first, staged, system, run_ts)
                first = self.store.append(name, rows, partition_by=[month], deal=not lie_by(rows, month))
        return self.store.get(name)

    @_lazy
    def retained_load(self) -> DataFrame:
        """The complaint fact after the same two loads, each as a staged batch
        of a pipeline that retires all it can after each of them (L12)."""
        from depotlens.plans.pipeline import Pipeline

        p, raw, end = Pipeline(self.spark), self.staged_raw_complaints, td.RUN2.replace(year=9999)
        p.apply_stations(td.station_list_day1(self.spark, self.sf_dir).drop("s_suppkey"), td.DAY1, td.RUN1)
        for rows, run_ts in ((self.first_half(raw), td.RUN1), (raw, td.RUN2)):
            no = p._last_batch_no() + 1
            rows = staging.dedupe_staged(rows, p.staged_hashes("complaints"))
            p.store.append("stg_complaint", rows.withColumn("load_batch", F.lit(no)), partition_by=["load_batch"])
            p.load_pending(run_ts)
            p.link(run_ts)
            p.monitor(run_ts.date(), run_ts)
            p.retire(end, keep=1)
        return p.store.get("fact_complaint")

    @_lazy
    def links_day1(self) -> DataFrame:
        rows = fx.link_complaints(self.fact_complaint, None, self.dim1, td.RUN1)
        return self.store.append("complaint_station_link", rows, partition_by=["complained_month"], sort_by=["complained_date"])

    @_lazy
    def monitoring_day1(self) -> DataFrame:
        row = complaint_monitoring(fx.complaint_view(self.fact_complaint, self.links_day1), td.DAY1, td.RUN1)
        return self.store.put("monitoring_complaints", row)

    @_lazy
    def links(self) -> DataFrame:
        _ = self.monitoring_day1  # day 1 is counted before day 2 links
        rows = fx.link_complaints(self.fact_complaint, self.links_day1, self.dim2, td.RUN2)
        return self.store.append("complaint_station_link", rows, partition_by=["complained_month"], sort_by=["complained_date"])

    @_lazy
    def correlation(self) -> DataFrame:
        from depotlens.operators.correlation import complaint_delivery_link
        return self.store.put("complaint_delivery_link",
                              complaint_delivery_link(self.fact_complaint, self.fact_delivery))

    @_lazy
    def delay_sketch(self) -> DataFrame:
        from depotlens.operators.correlation import delay_sketch
        return self.store.append("delay_sketch", delay_sketch(self.correlation), partition_by=["complaint_day"])

    @_lazy
    def monitoring(self) -> DataFrame:
        row = complaint_monitoring(fx.complaint_view(self.fact_complaint, self.links), td.DAY2, td.RUN2)
        return self.store.put("monitoring_complaints", upsert_by_date(self.monitoring_day1, row))


_FILE_CACHE: dict = {}


def file_scenario(spark: SparkSession, sf_dir: str) -> "FileScenario":
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _LOCK:
        if key not in _FILE_CACHE:
            _FILE_CACHE[key] = FileScenario(spark, sf_dir)
        return _FILE_CACHE[key]


class FileScenario:
    """Day-1 intake from real landing files written from the derived records.

    Two files per day and format; on the first arrival day of the complaints
    one damaged extra file per format, which must fail as a whole.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        from depotlens.plans.pipeline import Pipeline
        from depotlens.session import new_scratch_path

        self.spark, self.sf_dir = spark, sf_dir
        self.root = new_scratch_path(spark, "landing")
        self.pipeline = Pipeline(spark)
        self._step_lock = threading.RLock()

    @_lazy
    def damage_day(self):
        return td.complaint_records(self.spark, self.sf_dir).select(F.min("ingest_dt")).first()[0]

    @_lazy
    def written(self) -> str:
        """The landing files (test fixture: stands in for the file server)."""
        from depotlens.schemas import COMPLAINT_FIELDS, DELIVERY_FIELDS
        from depotlens.sources.files import write_landing

        write_landing(td.complaint_records(self.spark, self.sf_dir), self.root, "complaints",
                      COMPLAINT_FIELDS, "complained_at", td.COMPLAINT_FILE_ORDER,
                      part=F.col("event_id") % 2, damage_day=self.damage_day)
        write_landing(td.delivery_rows(self.spark, self.sf_dir), self.root, "delivery_events", DELIVERY_FIELDS, "delivered_at",
                      td.DELIVERY_FILE_ORDER, part=F.col("l_linenumber") % 2, derived=td.delivery_fields())
        return self.root

    @_lazy
    def staged(self) -> dict:
        return self.pipeline.ingest(self.written, td.RUN1)

    @_lazy
    def volumes(self) -> DataFrame:
        """Volumes of the whole day-1 run (its intake is the one above)."""
        _ = self.staged
        stations = td.station_list_day1(self.spark, self.sf_dir).drop("s_suppkey")
        self.pipeline.run(td.DAY1, td.RUN1, self.root, stations)
        return self.pipeline.volumes()

    @property
    def ledger(self) -> DataFrame:
        _ = self.staged
        return self.pipeline.ledger()

    def staged_with_file(self, system: str) -> DataFrame:
        """Staged rows with the arrival day and format read off the path."""
        led = self.ledger.select("file_id", "landing_file_path")
        rows = self.pipeline.store.get(
            {"complaints": "stg_complaint", "delivery_events": "stg_delivery_event"}[system])
        return rows.join(led, "file_id").select(
            F.to_date(F.regexp_extract("landing_file_path", r"ingest_dt=([0-9-]+)", 1)).alias("ingest_dt"),
            F.regexp_extract("landing_file_path", r"\.([a-z]+)$", 1).alias("source_format"),
            *[c for c in rows.columns if c not in ("file_id", "load_batch")])


#: the complaint files of a source with other names, order and time format
PARTNER_COLUMNS = {
    "complaint_text": "beschwerde", "purchase_order_id": "bestellung", "parcel_id": "sendung", "recipient_address": "anschrift",
    "recipient_name": "empfaenger", "pickup_station_external_id": "station", "complained_at": "zeit"}
PARTNER_TIME = "dd.MM.yyyy HH:mm:ss.SSSSSS"


class LayoutScenario(FileScenario):
    """Complaint files of two sources in one intake: even events in the
    standard layout, odd ones (file part 1) in the partner's."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        from depotlens.sources.readers import Layout

        super().__init__(spark, sf_dir)
        self.pipeline.layouts = {"complaints": [Layout(r"_1 \[%20\]\.[a-z]+$", PARTNER_COLUMNS, PARTNER_TIME)]}

    @_lazy
    def written(self) -> str:
        from depotlens.schemas import COMPLAINT_FIELDS
        from depotlens.sources.files import write_landing

        records, odd = td.complaint_records(self.spark, self.sf_dir), F.col("event_id") % 2
        write_landing(records.where(odd == 0), self.root, "complaints", COMPLAINT_FIELDS, "complained_at",
                      td.COMPLAINT_FILE_ORDER, part=F.lit(0))
        partner = records.where(odd == 1).withColumn("complained_at", F.date_format("complained_at", PARTNER_TIME))
        write_landing(partner.withColumnsRenamed(PARTNER_COLUMNS), self.root, "complaints", list(PARTNER_COLUMNS.values()),
                      "", td.COMPLAINT_FILE_ORDER, part=F.lit(1))
        return self.root

    @_lazy
    def staged(self) -> dict:
        return self.pipeline.ingest(self.written, td.RUN1, systems=("complaints",))


def layout_scenario(spark: SparkSession, sf_dir: str) -> LayoutScenario:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), "layouts")
    with _LOCK:
        if key not in _FILE_CACHE:
            _FILE_CACHE[key] = LayoutScenario(spark, sf_dir)
        return _FILE_CACHE[key]
