"""File ledger (L1-L4): register each file once, claim batches, record outcomes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotlens.operators.ids import assign_ids, lit_ts, max_value
from depotlens.schemas import FILE_LISTING, LEDGER, LEDGER_NATURAL_KEY

RECEIVED, PARSING, PARSED, FAILED = "RECEIVED", "PARSING", "PARSED", "FAILED"
LISTING_COLUMNS = [f.name for f in FILE_LISTING.fields]
LEDGER_COLUMNS = [f.name for f in LEDGER.fields]
BATCH_SCHEMA = "file_id bigint, source_system string, landing_file_path string"
DEFAULT_BATCH = 100  # files per parse batch in the reference (L2)
# The pipeline's own claim size. Results do not depend on it (claims follow
# file_id order and dedupe keeps the smallest file_id); a larger claim only
# means fewer, larger Spark jobs.
INTAKE_BATCH = 1000


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LEDGER)


def new_files(ledger: DataFrame, listing: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """L1, the new rows only: listing rows whose natural key (system, path,
    modified time, size) is not in the ledger. A path whose time or size
    changed is a new file. file_id continues after the largest one, in
    natural-key order."""
    key = LEDGER_NATURAL_KEY
    new = (listing.select(*LISTING_COLUMNS).dropDuplicates(key)
           .join(ledger.select(*key), key, "left_anti"))
    new = assign_ids(new, key, "file_id", start=max_value(ledger, "file_id"))
    return (new.withColumn("received_at", lit_ts(run_ts))
            .withColumn("parsed_at", F.lit(None).cast("timestamp_ntz"))
            .withColumn("status", F.lit(RECEIVED))
            .withColumn("error_message", F.lit(None).cast("string"))
            .select(*LEDGER_COLUMNS))


def register_files(ledger: DataFrame, listing: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """L1: the ledger with the new files appended (status RECEIVED)."""
    return ledger.select(*LEDGER_COLUMNS).unionByName(new_files(ledger, listing, run_ts))


def next_batch(ledger: DataFrame, limit: int = DEFAULT_BATCH) -> DataFrame:
    """L2: the oldest ``limit`` RECEIVED files (ties by file_id); top-k, so
    Spark plans it as TakeOrderedAndProject, no global sort."""
    return (ledger.where(F.col("status") == RECEIVED)
            .orderBy("received_at", "file_id").limit(limit)
            .select("file_id", "source_system", "landing_file_path"))


def claim(ledger: DataFrame, batch: DataFrame) -> DataFrame:
    """L2 second half: the claimed files become PARSING. ``batch`` is at most
    ``limit`` rows, so broadcasting it is bounded."""
    ids = F.broadcast(batch.select("file_id", F.lit(True).alias("_claimed")))
    j = ledger.join(ids, "file_id", "left")
    return j.withColumn("status", F.when(F.col("_claimed"), F.lit(PARSING)).otherwise(F.col("status"))) \
            .select(*LEDGER_COLUMNS)


def release_stale_claims(ledger: DataFrame) -> DataFrame:
    """With a single writer, PARSING rows at the start of a run belong to
    a run that died; they go back to RECEIVED."""
    return ledger.withColumn("status", F.when(F.col("status") == PARSING, F.lit(RECEIVED))
                             .otherwise(F.col("status")))


def apply_outcomes(ledger: DataFrame, outcomes: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """L3/L4: outcomes(file_id, ok, error_message) -> PARSED (parsed_at = run
    time, error cleared) or FAILED (error kept, parsed_at unchanged). Other
    files are untouched. Outcomes cover one claimed batch (bounded)."""
    o = F.broadcast(outcomes.select("file_id", F.col("ok").alias("_ok"),
                                    F.col("error_message").alias("_err")))
    j = ledger.join(o, "file_id", "left")
    ok, failed = F.col("_ok") == F.lit(True), F.col("_ok") == F.lit(False)
    return (j.withColumn("status", F.when(ok, F.lit(PARSED)).when(failed, F.lit(FAILED)).otherwise(F.col("status")))
            .withColumn("parsed_at", F.when(ok, lit_ts(run_ts)).otherwise(F.col("parsed_at")))
            .withColumn("error_message", F.when(ok, F.lit(None).cast("string"))
                        .when(failed, F.col("_err")).otherwise(F.col("error_message")))
            .select(*LEDGER_COLUMNS))


# ---------------------------------------------------------------------------
# Stored form: append-only. Files are appended once; every status change is
# an appended event. The ledger above is a view of the two, so a claim or an
# outcome writes only its own rows (bounded by the claim), never the ledger.

FILE_COLUMNS = ["file_id", "source_system", "source_file_path", "source_modified_at", "file_size_bytes",
                "landing_file_path", "received_at"]
EVENT_SCHEMA = "file_id bigint, status string, at timestamp_ntz, error_message string, seq int"
# order of events written by one run at one run time
_SEQ = {RECEIVED: 0, PARSING: 1, PARSED: 2, FAILED: 2}


def status_events(rows: DataFrame, status_col, run_ts: dt.datetime, error_col=None) -> DataFrame:
    """Events (file_id, status, at, error_message, seq) for ``rows``."""
    st = F.col(status_col) if isinstance(status_col, str) else status_col
    seq = F.when(st == RECEIVED, 0).when(st == PARSING, 1).otherwise(2)
    err = F.lit(None).cast("string") if error_col is None else F.col(error_col)
    return rows.select("file_id", st.alias("status"), lit_ts(run_ts).alias("at"), err.alias("error_message"),
                       seq.cast("int").alias("seq"))


def claim_events(batch: DataFrame, run_ts: dt.datetime) -> DataFrame:
    return status_events(batch, F.lit(PARSING), run_ts)


def outcome_events(outcomes: DataFrame, run_ts: dt.datetime) -> DataFrame:
    o = outcomes.withColumn("_st", F.when(F.col("ok"), F.lit(PARSED)).otherwise(F.lit(FAILED)))
    o = o.withColumn("_err", F.when(F.col("ok"), F.lit(None).cast("string")).otherwise(F.col("error_message")))
    return status_events(o, "_st", run_ts, "_err")


def release_events(ledger: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """K13 in stored form: PARSING files get a RECEIVED event."""
    return status_events(ledger.where(F.col("status") == PARSING), F.lit(RECEIVED), run_ts)


def ledger_view(files: DataFrame, events: DataFrame | None) -> DataFrame:
    """The ledger (L1-L4 columns) from file rows and status events: status
    from the latest event (by time, then seq), parsed_at from the latest
    PARSED event, error_message from the latest outcome. A partial aggregate
    per file (a few events each)."""
    if events is None:
        return files.select(*FILE_COLUMNS, F.lit(None).cast("timestamp_ntz").alias("parsed_at"),
                            F.lit(RECEIVED).alias("status"), F.lit(None).cast("string").alias("error_message"))
    is_outcome = F.col("status").isin(PARSED, FAILED)
    last = events.groupBy("file_id").agg(
        F.max_by("status", F.struct("at", "seq")).alias("_status"),
        F.max(F.when(F.col("status") == PARSED, F.col("at"))).alias("_parsed_at"),
        F.max_by("error_message", F.when(is_outcome, F.struct("at", "seq"))).alias("_error"))
    j = files.join(last, "file_id", "left")
    return j.select(*FILE_COLUMNS, F.col("_parsed_at").alias("parsed_at"),
                    F.coalesce("_status", F.lit(RECEIVED)).alias("status"),
                    F.col("_error").alias("error_message"))
