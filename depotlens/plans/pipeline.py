"""The daily run, step by step (each step is a function of written tables).

``Pipeline.run`` strings the steps together for one day:
  1. landing: list files, register new ones, claim batches of at most
     ``batch_size`` files, read them, record outcomes (L1-L7),
  2. staging: normalise, hash, dedupe against what is staged (L8-L10),
  3. stations: upsert today's snapshot, apply it to the history (D1-D11),
  4. facts: load today's staged rows (F1, F3), link complaints (F2),
  5. monitoring row for the day (M1).
Reports are functions evaluated on the written tables (R1, R2, S1-S8).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from depotlens.operators import facts as fx
from depotlens.operators import landing, station_dim
from depotlens.operators.ids import lit_ts
from depotlens.operators.monitoring import complaint_monitoring, upsert_by_date
from depotlens.operators.staging import dedupe_staged
from depotlens.schemas import MONITORING, STATION_SNAPSHOT
from depotlens.sources.files import list_landing
from depotlens.sources.readers import Layout, stage_batch
from depotlens.sources.store import Store, lie_by

STATION_KEYS = "apply int, last_id long, last_sk long"
LOADED_MONTHS = "created_at timestamp_ntz, months array<date>"
VOLUMES = "volume_date date, stage string, source_system string, metric string, value long"
SYSTEMS = ("complaints", "delivery_events")
STAGING_TABLE = {"complaints": "stg_complaint", "delivery_events": "stg_delivery_event"}
#: buckets of the staged hashes of a new store: a cluster takes about one per GB of hashes
HASH_BUCKETS = 16
HASH = "record_hash_sha256"
#: landing bytes that a task stages at least
STAGED_BYTES = 64 << 20
FACT_TABLE = {"complaints": "fact_complaint", "delivery_events": "fact_delivery_event"}
FACT_DATE = {"complaints": "complained_month", "delivery_events": "delivered_month"}
FACT_TIME = {"complaints": "complained_at", "delivery_events": "delivered_at"}


def metrics_of(seen: Observation) -> dict:
    """What was observed; nothing where Spark found at run time that there are
    no rows, and left out the step that takes the metrics."""
    return seen.get if seen._jo.getRow().length() else {}


class Pipeline:
    def __init__(self, spark: SparkSession, store: Store | None = None, batch_size: int = landing.INTAKE_BATCH,
                 layouts: dict[str, list[Layout]] | None = None, hash_buckets: int = HASH_BUCKETS):
        self.spark = spark
        self.store = store or Store(spark)
        self.batch_size = batch_size
        self.hash_buckets = hash_buckets
        self.layouts = layouts or {}  # by source system: files with other columns (L5, L6)
        self._said: list[tuple] = []
        self._seen: list[tuple] = []

    # ---------------------------------------------------------------- state
    def _get(self, name: str) -> DataFrame | None:
        return self.store.get(name) if self.store.has(name) else None

    def ledger(self) -> DataFrame:
        """Current ledger: a view of appended file rows and status events."""
        if not self.store.has("ledger_files"):
            return landing.empty_ledger(self.spark)
        return landing.ledger_view(self._get("ledger_files"), self._get("ledger_events"))

    def _last_batch_no(self) -> int:
        """Largest load batch number in the store (kept across drivers). The
        numbers of retired batches are still in the tables of done ones."""
        return max((b for s in SYSTEMS for b in self._staged_batches(s) | self._done("hashed_batches_" + s)
                    | self._done("loaded_batches_" + s)), default=0)

    def _done(self, name: str) -> set[int]:
        """Load batches that a step is done with: one number per claim."""
        return {r[0] for r in self.store.get(name).collect()} if self.store.has(name) else set()

    def _staged_batches(self, system: str) -> set[int]:
        """Load batches with staged rows, from the folders (no rows are read)."""
        return {int(v) for v in self.store.partitions(STAGING_TABLE[system], "load_batch")}

    def staged_hashes(self, system: str) -> DataFrame | None:
        """The hashes of all staged rows, bucketed by hash, so that the
        anti join of a new batch shuffles the batch alone. Batches that are
        staged but not in the table yet (as after a stopped run) are added
        first; a batch added twice does no harm."""
        name, done_t = "staged_hashes_" + system, "hashed_batches_" + system
        done = self._done(done_t)
        new = sorted(self._staged_batches(system) - done)
        if not new and not done:
            return None
        rows = self.store.get(STAGING_TABLE[system]).where(F.col("load_batch").isin(new)).select(HASH)
        if not new:
            return self.store.bucketed(name, HASH).hint("merge")
        hashes = self.store.append_bucketed(name, rows, HASH, self.hash_buckets)
        self.store.append(done_t, self.spark.createDataFrame([(b,) for b in new], "load_batch int"))
        return hashes.hint("merge")

    def pending_batches(self, system: str) -> list[int]:
        """Staged load batches whose rows are not yet in the facts (e.g. a
        driver stopped between staging and loading). Partition values only."""
        return sorted(self._staged_batches(system) - self._done("loaded_batches_" + system))

    # -------------------------------------------------------------- volumes
    def _observed(self, df: DataFrame, stage: str, system: str | None = None, **metrics: Column) -> DataFrame:
        """df, with metrics taken while it is written (no extra scan). Without
        a system, metrics are named ``system:metric``."""
        seen = Observation()
        self._seen.append((stage, system, seen, list(metrics)))
        return df.observe(seen, *[m.alias(k) for k, m in metrics.items()])

    def _say(self, stage: str, system: str, metric: str, value: int) -> None:
        self._said.append((stage, system, metric, int(value)))

    def write_volumes(self, day: dt.date) -> None:
        """What was observed since the last call, one row per (day, stage,
        system, metric), appended. A day's runs add up."""
        rows = list(self._said)
        for stage, system, seen, names in self._seen:
            values = metrics_of(seen)
            for key in names:
                own, _, metric = key.rpartition(":")
                rows.append((stage, system or own, metric, int(values.get(key) or 0)))
        self._said, self._seen = [], []
        if rows:
            df = self.spark.createDataFrame([(day, *r) for r in rows], VOLUMES)
            self.store.append("pipeline_volumes", df.coalesce(1))

    def volumes(self) -> DataFrame | None:
        """Volumes per (stage, date): the sums of each day's runs."""
        rows = self._get("pipeline_volumes")
        return None if rows is None else rows.groupBy("volume_date", "stage", "source_system", "metric").agg(
            F.sum("value").alias("value"))

    # -------------------------------------------------------------- landing
    def ingest(self, landing_root: str, run_ts: dt.datetime, systems=SYSTEMS) -> dict[str, DataFrame]:
        """Register and parse every new landing file. Returns, per system, the
        staging rows added by this run."""
        listing = None
        for s in systems:
            part = list_landing(self.spark, landing_root, s)
            listing = part if listing is None else listing.unionByName(part)
        led = self.ledger()
        if self.store.has("ledger_events"):  # no events yet: nothing to release
            stale = landing.release_events(led, run_ts)
            if not stale.isEmpty():
                self.store.append("ledger_events", stale)
        new = landing.new_files(self.ledger(), listing, run_ts)
        self.store.append("ledger_files", self._observed(new.select(*landing.FILE_COLUMNS), "landing", **{
            f"{s}:files_registered": F.count_if(F.col("source_system") == s) for s in systems}))
        led = self.ledger()
        batches: dict[str, list[int]] = {s: [] for s in systems}
        self.last_outcomes = []
        while True:
            # a claim is at most batch_size rows: held as a small local frame
            claimed = landing.next_batch(led, self.batch_size).collect()
            if not claimed:
                break
            self._batch_no = self._last_batch_no() + 1
            batch = self.spark.createDataFrame(claimed, landing.BATCH_SCHEMA)
            self.store.append("ledger_events", landing.claim_events(batch, run_ts))
            held = dict(led.join(F.broadcast(batch.select("file_id")), "file_id", "left_semi")
                        .groupBy("source_system").agg(F.sum("file_size_bytes")).collect())
            outs = []
            for s in systems:
                if not any(r["source_system"] == s for r in claimed):
                    continue
                b = batch.where(F.col("source_system") == s)
                rows, out = stage_batch(self.spark, b, s, run_ts, self.layouts.get(s, ()))
                rows = dedupe_staged(rows, self.staged_hashes(s))
                rows = self._observed(
                    rows.withColumn("load_batch", F.lit(self._batch_no)), "staging", s, rows_kept=F.count(F.lit(1)),
                    rows_without_time=F.count_if(F.col(FACT_TIME[s]).isNull()))
                # all rows are of one batch: they are written by the tasks that read them, few where the files are small
                rows = rows.coalesce(-(-(held.get(s) or 1) // STAGED_BYTES))
                self.store.append(STAGING_TABLE[s], rows, partition_by=["load_batch"], deal=False)
                batches[s].append(self._batch_no)
                outs.append(out)
            out = outs[0]
            for o in outs[1:]:
                out = out.unionByName(o)
            # one row per claimed file: bounded by the claim size
            said = out.collect()
            out = self.spark.createDataFrame(said, out.schema)
            self.last_outcomes.append(out)
            system_of = {r["file_id"]: r["source_system"] for r in claimed}
            for s in sorted(set(system_of.values())):
                own = [r for r in said if system_of[r["file_id"]] == s]
                self._say("landing", s, "files_parsed", sum(r["ok"] for r in own))
                self._say("landing", s, "files_failed", sum(not r["ok"] for r in own))
                self._say("staging", s, "rows_read", sum(r["records"] for r in own if r["ok"]))
            self.store.append("ledger_events", landing.outcome_events(out, run_ts))
            led = self.ledger()
        self.write_volumes(run_ts.date())
        result = {}
        for s, nos in batches.items():
            if nos:
                # this run's rows, read back by partition (pruned), not re-parsed
                result[s] = self.store.get(STAGING_TABLE[s]).where(F.col("load_batch").isin(nos)).drop("load_batch")
        return result

    # ------------------------------------------------------------- stations
    def apply_stations(self, station_list: DataFrame, snapshot_date: dt.date, run_ts: dt.datetime,
                       allow_empty: bool = False) -> DataFrame:
        snap = station_dim.snapshot_rows(station_list, snapshot_date)
        # the upsert key starts with the day: only that day's table changes
        name = f"stg_pickup_station/snapshot_date={snapshot_date.isoformat()}"
        old = self._get(name)
        old = station_dim.empty_snapshot(self.spark) if old is None else old
        snaps = self.store.put(name, station_dim.upsert_snapshot(old, snap))
        # the current rows alone; closed rows are neither read nor written again
        name, applied = "dim_pickup_station", self.store.latest("dim_pickup_station")
        dim = self.store.version(name) if applied else station_dim.empty_dim(self.spark)
        last = self._last_station_keys(applied)
        p = station_dim.apply_changes(dim, snaps, run_ts, *last, snapshot_date=snapshot_date, allow_empty=allow_empty)
        # a version written whole still holds closed rows: they move over now
        current, closed = p["current"], p["newly_closed"].unionByName(p["history"])
        broken = {r[0]: r[1] for r in station_dim.check_keys(current.unionByName(closed)).where("violations > 0").collect()}
        if broken:  # nothing is published
            raise ValueError(f"station history would break its keys: {broken}")
        top = p["fresh"].agg(F.max("pickup_station_id"), F.max("pickup_station_sk")).first()
        row = (applied + 1, max(last[0], top[0] or 0), max(last[1], top[1] or 0))
        self.store.append("last_station_keys", self.spark.createDataFrame([row], STATION_KEYS).coalesce(1))
        return self.store.put_history(name, current, closed)

    def _last_station_keys(self, applied: int) -> tuple[int, int]:
        """The largest station id and surrogate key given up to a published
        version: a row per run; a store without them is scanned once."""
        if not applied:
            return 0, 0
        keys = self._get("last_station_keys")
        found = None if keys is None else keys.where(F.col("apply") == applied).agg(F.max("last_id"), F.max("last_sk")).first()
        if found is None or found[0] is None:
            found = self.store.get("dim_pickup_station").agg(F.max("pickup_station_id"), F.max("pickup_station_sk")).first()
        return int(found[0] or 0), int(found[1] or 0)

    def snapshots(self) -> DataFrame | None:
        """The station lists of all days (each day is a table of its own)."""
        return self.store.union("stg_pickup_station", STATION_SNAPSHOT)

    # ---------------------------------------------------------------- facts
    def load_facts(self, system: str, staged: DataFrame, run_ts: dt.datetime,
                   created_at: Column | None = None) -> DataFrame:
        # the largest key given so far is a row of its own; a store without
        # it, or one whose last load was stopped, is scanned once
        fact, keys, sk = self._get(FACT_TABLE[system]), "last_key_" + system, fx.SPECS[system]["sk"]
        last = self.store.get(keys).first() if self.store.has(keys) else None
        start = None if last is None or last["loading"] else last["last_key"]
        if fact is not None:
            self._put_key(keys, start, True)
        months, loads = fx.event_months(staged, system), "loaded_months_" + system
        # M1: where the rows created at a time lie, written before them; null: anywhere, any time
        known = created_at is None and (fact is None or self.store.has(loads))
        self.store.append(loads, self.spark.createDataFrame(
            [(None if created_at is not None else run_ts, months if known else None)], LOADED_MONTHS).coalesce(1))
        rows = fx.load_facts(fact, staged, system, run_ts, created_at=created_at, start=start, months=months)
        deal = not lie_by(rows, FACT_DATE[system])  # asked before the rows are observed
        rows = self._observed(rows, "dw", system, rows_loaded=F.count(F.lit(1)))
        top = Observation()
        out = self.store.append(FACT_TABLE[system], rows.observe(top, F.max(sk).alias("top")),
                                partition_by=[FACT_DATE[system]], sort_by=[FACT_TIME[system]], deal=deal)
        given = metrics_of(top).get("top")
        if given is not None or start is not None:
            self._put_key(keys, start if given is None else given, False)
        return out

    def _put_key(self, name: str, last_key: int | None, loading: bool) -> None:
        self.store.put(name, self.spark.createDataFrame([(last_key, loading)], "last_key long, loading boolean").coalesce(1))

    def load_pending(self, run_ts: dt.datetime) -> None:
        """the staged batches that are not yet in the facts."""
        for s in SYSTEMS:
            pending = self.pending_batches(s)
            if not pending:
                continue
            rows = (self.store.get(STAGING_TABLE[s]).where(F.col("load_batch").isin(pending))
                    .drop("load_batch"))
            # insert-if-new by hash: loading a batch again adds nothing
            self.load_facts(s, rows, run_ts)
            done = self.spark.createDataFrame([(b,) for b in pending], "load_batch int")
            self.store.append("loaded_batches_" + s, done)

    def link(self, run_ts: dt.datetime) -> DataFrame:
        """F2 for the complaints of the load batches not yet linked, whatever
        their run time, and for those still without a station; facts and links
        of other months are not read (batches and months prune partitions)."""
        fact, month = self._get("fact_complaint"), "complained_month"
        batches = None
        if self.store.has("loaded_batches_complaints"):  # else facts without batches: all
            batches = sorted(self._done("loaded_batches_complaints") - self._done("linked_batches_complaints"))
            staged = (self.store.get(STAGING_TABLE["complaints"]).where(F.col("load_batch").isin(batches))
                      .select("record_hash_sha256", F.trunc("complained_at", "month").alias(month)))
            fact = fx.same_months(fact, staged, month).join(
                staged.select("record_hash_sha256"), "record_hash_sha256", "left_semi")
        cand = fx.link_candidates(fact, self._get("complaint_unlinked")).checkpoint(eager=True)
        links = self._get("complaint_station_link")
        rows = fx.link_complaints(cand, None if links is None else fx.same_months(links, cand, month),
                                  self._get("dim_pickup_station"), run_ts)
        rows = self._observed(rows, "dw", "complaints", complaints_linked=F.count(F.lit(1)))
        links = self.store.append("complaint_station_link", rows, partition_by=[month], sort_by=["complained_date"])
        linked = fx.same_months(links, cand, month).select("record_hash_sha256")
        waiting = cand.join(linked, "record_hash_sha256", "left_anti").select(*fx.LINK_COLUMNS)
        self.store.put("complaint_unlinked", self._observed(waiting, "dw", "complaints", complaints_waiting=F.count(F.lit(1))))
        if batches:
            self.store.append("linked_batches_complaints", self.spark.createDataFrame([(b,) for b in batches], "load_batch int"))
        return links

    def monitor(self, day: dt.date, run_ts: dt.datetime) -> DataFrame:
        # the day's load only, and links of its months only
        today = ((F.col("created_at") >= lit_ts(dt.datetime.combine(day, dt.time())))
                 & (F.col("created_at") < lit_ts(dt.datetime.combine(day + dt.timedelta(days=1), dt.time()))))
        loaded, month, loads = self._get("fact_complaint").where(today), "complained_month", self._get("loaded_months_complaints")
        months = None if loads is None else [r[0] for r in loads.where(today | F.col("created_at").isNull()).select("months").collect()]
        if months is not None and None not in months:  # partitions of the fact's months
            loaded = loaded.where(fx.in_months(sorted({m for ms in months for m in ms}, key=str), month))
        links = self._get("complaint_station_link")
        view = fx.complaint_view(loaded, None if links is None else fx.same_months(links, loaded, month))
        row = complaint_monitoring(view, day, run_ts)
        old = self._get("monitoring_complaints")
        old = self.spark.createDataFrame([], MONITORING) if old is None else old
        return self.store.put("monitoring_complaints", upsert_by_date(old, row))

    # ------------------------------------------------------------ retention
    def retire(self, before: dt.datetime, keep: int = 2) -> dict[str, list]:
        """Removes what no later run reads and was replaced or written
        before ``before``: versions of state tables but the newest ``keep``,
        and staged batches that are hashed, loaded and (complaints) linked.
        Facts, links, hashes and the station history stay whole. Not part of
        a run: readers of older versions and batches have until ``before``."""
        gone = {}
        for system in SYSTEMS:
            if self.staged_hashes(system) is None:  # adds the batches not hashed yet
                continue
            done = self._done("hashed_batches_" + system) & self._done("loaded_batches_" + system)
            if system == "complaints":
                done &= self._done("linked_batches_complaints")
            name = STAGING_TABLE[system]
            gone[name] = self.store.retire_partitions(name, "load_batch", done, before)
        for name in self.store.versioned():
            gone[name] = self.store.retire_versions(name, before, keep)
        return {name: what for name, what in gone.items() if what}

    # ------------------------------------------------------------------ day
    def run(self, day: dt.date, run_ts: dt.datetime, landing_root: str, station_list: DataFrame,
            allow_empty_snapshot: bool = False) -> None:
        """One daily run (idempotent: a second run with the same inputs
        registers no file, stages no row, changes no station, loads no fact)."""
        self.ingest(landing_root, run_ts)
        self.apply_stations(station_list, day, run_ts, allow_empty=allow_empty_snapshot)
        self.load_pending(run_ts)
        if self.store.has("fact_complaint"):
            self.link(run_ts)
            self.monitor(day, run_ts)
        self.write_volumes(run_ts.date())
