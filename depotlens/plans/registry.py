"""Registered queries: name -> (Spark job over the test tables, DuckDB SQL).

Each Spark callable takes (spark, sf_dir) and returns a DataFrame over the
whole derived tables. Column names equal the oracle's.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotlens.functions.text import norm_text
from depotlens.operators import facts as fx
from depotlens.operators import landing, reports, station_dim
from depotlens.operators.ids import lit_ts
from depotlens.plans import oracle as o
from depotlens.plans.scenario import file_scenario, layout_scenario, scenario
from depotlens.schemas import STATION_DIM_COLUMNS
from depotlens.session import prepare
from depotlens.sources import testdata as td

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle_sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(scenario(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle_sql is not None:
            ORACLE[name] = oracle_sql
        return fn
    return deco


# ------------------------------------------------------------------ reports
@register("rpt_station_claims_14d", o.sql(f"""
SELECT d.ref_identifier AS pickup_identifier, d.name, d.zip_code, count(*) AS claims_last_14_days
  FROM fact_c f JOIN links l USING (record_hash_sha256)
  JOIN dim2 d ON d.pickup_station_id = l.pickup_station_id AND d.is_current
 WHERE f.complained_at >= {o.AS_OF} - INTERVAL 14 DAY
 GROUP BY d.ref_identifier, d.name, d.zip_code""", "fact_c", "links", "dim2"))
def _r1(sc):
    """Complaints per current station in the last 14 days."""
    return reports.station_claims(sc.fact_complaint, sc.links, sc.dim2, td.AS_OF)


@register("rpt_recipients_over5_2m", o.sql(f"""
SELECT min(f.recipient_name) AS recipient_name, min(f.recipient_address) AS recipient_address,
       count(*) AS complaints_2m,
       string_agg(DISTINCT f.pickup_station_external_id, ' | ' ORDER BY f.pickup_station_external_id)
         FILTER (WHERE f.pickup_station_external_id IS NOT NULL) AS pickup_locations_given,
       string_agg(DISTINCT d.ref_identifier || ' - ' || coalesce(d.name, '') || ' (' || coalesce(d.zip_code, '') || ')', ' | '
                  ORDER BY d.ref_identifier || ' - ' || coalesce(d.name, '') || ' (' || coalesce(d.zip_code, '') || ')')
         FILTER (WHERE d.pickup_station_id IS NOT NULL) AS pickup_locations_enriched
  FROM cview f LEFT JOIN dim2 d ON d.pickup_station_id = f.pickup_station_id AND d.is_current
 WHERE f.complained_at >= {o.AS_OF} - INTERVAL 2 MONTH
 GROUP BY f.recipient_name_norm, f.recipient_address_norm
HAVING count(*) > 5""", "cview", "dim2"))
def _r2(sc):
    """R2: recipients with more than five complaints in two months."""
    return reports.frequent_recipients(sc.fact_complaint, sc.links, sc.dim2, td.AS_OF)


@register("monitoring_complaints", o.sql(f"""
SELECT {o.DAY1} AS monitoring_date,
       count(*) FILTER (WHERE CAST(f.created_at AS DATE) = {o.DAY1}) AS complaints_loaded,
       count(*) FILTER (WHERE CAST(f.created_at AS DATE) = {o.DAY1} AND l.pickup_station_id IS NULL) AS complaints_unresolved,
       {o.RUN1} AS updated_at
  FROM fact_c f LEFT JOIN links1 l USING (record_hash_sha256)
UNION ALL
SELECT {o.DAY2}, count(*) FILTER (WHERE CAST(created_at AS DATE) = {o.DAY2}),
       count(*) FILTER (WHERE CAST(created_at AS DATE) = {o.DAY2} AND pickup_station_id IS NULL), {o.RUN2}
  FROM cview""", "fact_c", "links1", "cview"))
def _m1(sc):
    """M1: complaints loaded per day and those without a station (2 days)."""
    return sc.monitoring


# ------------------------------------------------------------------ ledger
@register("landing_register", o.sql(f"SELECT {o.LEDGER_COLS} FROM ledger", "ledger"))
def _l1(sc):
    """L1: ledger after two registrations (re-sent files are new entries)."""
    return sc.ledger


@register("landing_next_batch", o.sql("""
SELECT file_id, source_system, landing_file_path FROM ledger WHERE status = 'RECEIVED'
 ORDER BY received_at, file_id LIMIT 100""", "ledger"))
def _l2(sc):
    """L2: the next parse batch (100 oldest RECEIVED files)."""
    return landing.next_batch(sc.ledger, landing.DEFAULT_BATCH)


@register("landing_claim", o.sql("""
SELECT file_id, source_system, source_file_path, source_modified_at, file_size_bytes, landing_file_path,
       received_at, parsed_at,
       CASE WHEN file_id IN (SELECT file_id FROM ledger WHERE status = 'RECEIVED'
                              ORDER BY received_at, file_id LIMIT 100) THEN 'PARSING' ELSE status END AS status,
       error_message
  FROM ledger""", "ledger"))
def _l2b(sc):
    """L2: ledger after the batch is claimed (status PARSING)."""
    return landing.claim(sc.ledger, landing.next_batch(sc.ledger, landing.DEFAULT_BATCH))


# ----------------------------------------------------------------- staging
@register("stage_dedup", o.sql("SELECT * FROM stg_c", "stg_c"))
def _l10(sc):
    """Staged complaints, one row per hash, smallest (file_id, record_index)."""
    return sc.stg_complaint


@register("record_hash", o.sql("SELECT file_id, record_index, record_hash_sha256 FROM craw", "craw"))
def _l9(sc):
    """Record hash of every staged complaint (re-sent copies share it)."""
    return sc.staged_raw_complaints.select("file_id", "record_index", "record_hash_sha256")


@register("norm_recipient", o.sql(f"""
SELECT DISTINCT recipient_name, recipient_address, {o._NORM.format(c='recipient_name')} AS recipient_name_norm,
       {o._NORM.format(c='recipient_address')} AS recipient_address_norm
  FROM (SELECT recipient_name, recipient_address FROM crec UNION ALL SELECT recipient_name, recipient_address FROM drec)""",
          "crec", "drec"))
def _l8(sc):
    """Normalised recipient names and addresses (complaints and deliveries)."""
    both = (sc.complaint_records.select("recipient_name", "recipient_address")
            .unionByName(sc.delivery_records.select("recipient_name", "recipient_address")))
    return both.select("recipient_name", "recipient_address",
                       norm_text("recipient_name").alias("recipient_name_norm"),
                       norm_text("recipient_address").alias("recipient_address_norm")).distinct()


# ---------------------------------------------------------------- stations
@register("station_fingerprint", o.sql("""SELECT snapshot_date, ref_identifier, fingerprint FROM snap1
UNION ALL SELECT snapshot_date, ref_identifier, fingerprint FROM snap2""", "snap1", "snap2"))
def _d2(sc):
    """Fingerprint of each station of both days' lists."""
    return sc.snap1.unionByName(sc.snap2).select("snapshot_date", "ref_identifier", "fingerprint")


@register("station_attr_hash", o.sql("""SELECT snapshot_date, ref_identifier, attr_hash_sha256 FROM snap1
UNION ALL SELECT snapshot_date, ref_identifier, attr_hash_sha256 FROM snap2""", "snap1", "snap2"))
def _d3(sc):
    """D3: attribute hash of each station of both days' lists."""
    return sc.snap1.unionByName(sc.snap2).select("snapshot_date", "ref_identifier", "attr_hash_sha256")


_SNAP_COLS = "snapshot_date, ref_identifier, name, city, zip_code, street, fingerprint, attr_hash_sha256"


@register("station_snapshot", o.sql(f"""
SELECT {_SNAP_COLS} FROM snap1
UNION ALL
SELECT {_SNAP_COLS} FROM snap2 WHERE ref_identifier NOT IN (SELECT identifier FROM st1)
UNION ALL
SELECT {o.DAY2} AS snapshot_date, ref_identifier, name, city, zip_code, street, fingerprint, attr_hash_sha256
  FROM snap1""", "snap1", "snap2", "st1"))
def _d1(sc):
    """Snapshot table after day 1, day 2 and a re-run of day 2."""
    return sc.snapshots


_DIM = o.DIM_COLS


@register("scd2_first_load", o.sql(f"SELECT {_DIM} FROM dim1", "dim1"))
def _d4(sc):
    """The history after the first load."""
    return sc.dim1


@register("scd2_resolve", o.sql("SELECT * FROM res2", "res2"))
def _d6(sc):
    """Day-2 snapshot rows with their resolved station id (K2)."""
    return sc.dim2_parts["resolved"]


@register("scd2_add", o.sql(f"""SELECT {_DIM} FROM dim2 WHERE valid_from = {o.RUN2}
  AND pickup_station_id NOT IN (SELECT pickup_station_id FROM dim1)""", "dim1", "dim2"))
def _d5(sc):
    """Stations added on day 2."""
    return (sc.dim2.where(F.col("valid_from") == lit_ts(td.RUN2))
            .join(sc.dim1.select("pickup_station_id"), "pickup_station_id", "left_anti")
            .select(*STATION_DIM_COLUMNS))


@register("scd2_close", o.sql(f"SELECT {_DIM} FROM dim2 WHERE valid_to = {o.RUN2} AND is_active", "dim2"))
def _d7(sc):
    """Rows closed on day 2 because the station changed."""
    return sc.dim2.where((F.col("valid_to") == lit_ts(td.RUN2)) & F.col("is_active"))


@register("scd2_new_version", o.sql(f"""SELECT {_DIM} FROM dim2 WHERE valid_from = {o.RUN2}
  AND pickup_station_id IN (SELECT pickup_station_id FROM dim1)""", "dim1", "dim2"))
def _d8(sc):
    """New versions of changed stations (same id, K1)."""
    return (sc.dim2.where(F.col("valid_from") == lit_ts(td.RUN2))
            .join(sc.dim1.select("pickup_station_id").distinct(), "pickup_station_id", "left_semi")
            .select(*STATION_DIM_COLUMNS))


@register("scd2_remove", o.sql(f"SELECT {_DIM} FROM dim2 WHERE valid_to = {o.RUN2} AND NOT is_active", "dim2"))
def _d9(sc):
    """Stations removed on day 2 (closed and inactive)."""
    return sc.dim2.where((F.col("valid_to") == lit_ts(td.RUN2)) & ~F.col("is_active"))


@register("scd2_apply", o.sql(f"SELECT {_DIM} FROM dim2", "dim2"))
def _d10(sc):
    """The whole history after the day-2 run."""
    return sc.dim2


@register("scd2_history_stored", o.sql(f"SELECT {_DIM} FROM dim2", "dim2"))
def _d10b(sc):
    """The stored history after both days, written as current rows and
    once-added closed rows."""
    return sc.history


@register("check_station_keys", o.sql("""
SELECT 'one_current' AS check_name, (SELECT count(*) FROM (SELECT 1 FROM dim2 WHERE is_current GROUP BY pickup_station_id HAVING count(*) > 1)) AS violations
UNION ALL
SELECT 'unique_sk', (SELECT count(*) FROM (SELECT 1 FROM dim2 GROUP BY pickup_station_sk HAVING count(*) > 1))""", "dim2"))
def _c1b(sc):
    """C1 and the dimension's primary key: stations with several current
    rows, surrogate keys given twice (0 each)."""
    return station_dim.check_keys(sc.dim2)


@register("check_one_current", o.sql("""
SELECT count(*) AS stations, CAST(coalesce(sum(c), 0) AS BIGINT) AS current_rows,
       count(*) FILTER (WHERE c > 1) AS violations
  FROM (SELECT pickup_station_id, count(*) FILTER (WHERE is_current) AS c FROM dim2 GROUP BY pickup_station_id)""",
          "dim2"))
def _c1(sc):
    """At most one current row per station."""
    return station_dim.check_one_current(sc.dim2)


# ------------------------------------------------------------------- facts
@register("fact_complaint_load", o.sql("SELECT * FROM fact_c", "fact_c"))
def _f1(sc):
    """complaint fact (insert if hash new, surrogate keys in file order)."""
    return sc.fact_complaint


@register("fact_delivery_load", o.sql("SELECT * FROM fact_d", "fact_d"))
def _f3(sc):
    """delivery-event fact."""
    return sc.fact_delivery


def _insert_new(fact: str, staged: str, sk: str) -> str:
    """The fact after a second load: the first holds the rows of the first half
    of the files, the second brings all rows of all files again."""
    half = f"file_id <= (SELECT quantile_disc(file_id, 0.5) FROM (SELECT DISTINCT file_id FROM {staged}))"
    return f"""
WITH places AS (SELECT record_hash_sha256, min(file_id * 2147483648 + record_index) AS place FROM {staged} GROUP BY ALL),
old_rows AS (SELECT record_hash_sha256, min(file_id * 2147483648 + record_index) AS place FROM {staged} WHERE {half} GROUP BY ALL),
old AS (SELECT f.* REPLACE (row_number() OVER (ORDER BY place) AS {sk}, CAST(place // 2147483648 AS BIGINT) AS file_id, {o.RUN1} AS created_at)
          FROM {fact} f JOIN old_rows USING (record_hash_sha256)),
new AS (SELECT f.* REPLACE ((SELECT max({sk}) FROM old) + row_number() OVER (ORDER BY place) AS {sk}, CAST(place // 2147483648 AS BIGINT) AS file_id,
                            {o.RUN2} AS created_at)
          FROM {fact} f JOIN places USING (record_hash_sha256) WHERE record_hash_sha256 NOT IN (SELECT record_hash_sha256 FROM old_rows))
SELECT * FROM old UNION ALL SELECT * FROM new"""


@register("fact_complaint_insert_new", o.sql(_insert_new("fact_c", "craw", "complaint_sk"), "fact_c", "craw"))
def _f1b(sc):
    """complaints loaded onto an existing fact: only new hashes, keys go on."""
    return sc.second_load("complaints")


@register("fact_delivery_insert_new", o.sql(_insert_new("fact_d", "draw", "delivery_event_sk"), "fact_d", "draw"))
def _f3b(sc):
    """delivery events loaded onto an existing fact."""
    return sc.second_load("delivery_events")


@register("fact_complaint_after_retention", o.sql(_insert_new("fact_c", "craw", "complaint_sk"), "fact_c", "craw"))
def _l12(sc):
    """The fact after both loads, where staged batches and old versions are retired after each."""
    return sc.retained_load


@register("stage_dedup_existing", o.sql("""
WITH old AS (SELECT record_hash_sha256 FROM craw WHERE file_id <= (SELECT quantile_disc(file_id, 0.5) FROM (SELECT DISTINCT file_id FROM craw)))
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY record_hash_sha256 ORDER BY file_id, record_index) AS rn FROM craw)
 WHERE rn = 1 AND record_hash_sha256 NOT IN (SELECT record_hash_sha256 FROM old)""", "craw"))
def _l10b(sc):
    """All complaints staged again after the first half of the files: the
    rows whose hash is not staged yet."""
    from depotlens.operators.staging import dedupe_staged
    return dedupe_staged(sc.staged_raw_complaints, sc.first_hashes)


@register("fact_complaint_enrich", o.sql("SELECT * FROM links", "links"))
def _f2(sc):
    """complaint-station links of day 1 and day 2 (sticky)."""
    return sc.links


@register("check_unique_hash", o.sql("""
SELECT t AS table_name, CAST(sum(n) AS BIGINT) AS rows, count(*) AS distinct_hashes,
       count(*) FILTER (WHERE n > 1) AS duplicated_hashes
  FROM (SELECT t, record_hash_sha256, count(*) AS n FROM (
          SELECT 'staged_raw_complaints' AS t, record_hash_sha256 FROM craw
          UNION ALL SELECT 'stg_complaint', record_hash_sha256 FROM stg_c
          UNION ALL SELECT 'fact_complaint', record_hash_sha256 FROM fact_c
          UNION ALL SELECT 'fact_delivery_event', record_hash_sha256 FROM fact_d)
        GROUP BY t, record_hash_sha256)
 GROUP BY t""", "craw", "stg_c", "fact_c", "fact_d"))
def _c2(sc):
    """Unique record hash per table (the raw staging keeps re-sent copies)."""
    parts = [("staged_raw_complaints", sc.staged_raw_complaints), ("stg_complaint", sc.stg_complaint),
             ("fact_complaint", sc.fact_complaint), ("fact_delivery_event", sc.fact_delivery)]
    out = None
    for name, df in parts:
        one = fx.check_unique_hash(df).select(F.lit(name).alias("table_name"), "*")
        out = one if out is None else out.unionByName(one)
    return out


@register("check_file_fk", o.sql("""
SELECT 'fact_complaint' AS table_name, count(*) AS orphan_rows FROM fact_c WHERE file_id NOT IN (SELECT file_id FROM ledger)
UNION ALL
SELECT 'fact_delivery_event', count(*) FROM fact_d WHERE file_id NOT IN (SELECT file_id FROM ledger)""",
          "fact_c", "fact_d", "ledger"))
def _c3(sc):
    """Fact rows whose file is missing from the ledger (0)."""
    a = fx.check_file_fk(sc.fact_complaint, sc.ledger).select(F.lit("fact_complaint").alias("table_name"), "*")
    b = fx.check_file_fk(sc.fact_delivery, sc.ledger).select(F.lit("fact_delivery_event").alias("table_name"), "*")
    return a.unionByName(b)


_KEYS = [("stg_complaint", "stg_c", ["file_id", "record_index"]), ("stg_delivery_event", "stg_d", ["file_id", "record_index"]),
         ("landing_file", "ledger", ["source_system", "source_file_path", "source_modified_at", "file_size_bytes"]),
         ("stg_pickup_station", "snaps", ["snapshot_date", "ref_identifier"])]


@register("check_primary_keys", o.sql(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS violations FROM (SELECT 1 FROM {v} GROUP BY {', '.join(k)} HAVING count(*) > 1)"
    for t, v, k in _KEYS), "stg_c", "stg_d", "ledger", "snaps"))
def _pk(sc):
    """Natural and primary keys that several rows of a table share (0 each)."""
    tables = {"stg_complaint": sc.stg_complaint, "stg_delivery_event": sc.stg_delivery, "landing_file": sc.ledger,
              "stg_pickup_station": sc.snapshots}
    parts = [fx.repeated_keys(tables[t], k).select(F.lit(t).alias("table_name"), "violations") for t, _, k in _KEYS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --------------------------------------------------------- landing files
def register_files_query(name: str, oracle_sql: str | None = None, source=file_scenario):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(source(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle_sql is not None:
            ORACLE[name] = oracle_sql
        return fn
    return deco


def _file_rows(src: str, system: str, fields: list[str], text: list[str], order: str, part: str) -> str:
    cols = ", ".join(fields)
    return f"""
SELECT * EXCLUDE (rn, part) FROM (
  SELECT *, row_number() OVER (PARTITION BY record_hash_sha256 ORDER BY ingest_dt, part, source_format, record_index) AS rn
    FROM (SELECT ingest_dt, source_format, {part} AS part,
                 CAST(row_number() OVER (PARTITION BY ingest_dt, source_format, {part} ORDER BY {order}) - 1 AS INTEGER) AS record_index,
                 {o._hash(system, fields[0], text)} AS record_hash_sha256, {cols},
                 {o._NORM.format(c='recipient_name')} AS recipient_name_norm,
                 {o._NORM.format(c='recipient_address')} AS recipient_address_norm,
                 {o.RUN1} AS ingested_at
            FROM {src}))
 WHERE rn = 1"""


@register_files_query("stage_complaints", o.sql(
    _file_rows("crec", "complaints", o.C_FIELDS, o.C_TEXT, "event_id", "event_id % 2"), "crec"))
def _l5(fs):
    """Complaints read from CSV, JSON Lines and XML landing files, two
    per day and format (the damaged extra files of the first day fail)."""
    return fs.staged_with_file("complaints")


@register_files_query("stage_complaints_mapped", o.sql(
    _file_rows("crec", "complaints", o.C_FIELDS, o.C_TEXT, "event_id", "event_id % 2"), "crec"), source=layout_scenario)
def _l5b(fs):
    """Complaints of two sources in one intake, one of them with other
    column names, another order and another time format."""
    return fs.staged_with_file("complaints")


@register_files_query("stage_delivery_events", o.sql(
    _file_rows("drec", "delivery_events", o.D_FIELDS, o.D_TEXT,
               "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
               "l_returnflag, l_linestatus, delivered_at", "l_linenumber % 2"), "drec"))
def _l6(fs):
    """Delivery events read from landing files, deduplicated."""
    return fs.staged_with_file("delivery_events")


@register_files_query("landing_apply_outcome", o.sql(f"""
SELECT source_system, ingest_dt, source_format,
       CASE WHEN bad THEN 'FAILED' ELSE 'PARSED' END AS status,
       CASE WHEN bad THEN 'CORRUPT_RECORDS: 1' END AS error_message,
       {o.RUN1} AS received_at,
       CASE WHEN bad THEN CAST(NULL AS TIMESTAMP) ELSE {o.RUN1} END AS parsed_at
  FROM (SELECT DISTINCT 'complaints' AS source_system, ingest_dt, source_format, event_id % 2 AS part, FALSE AS bad FROM crec
        UNION ALL
        SELECT DISTINCT 'complaints', ingest_dt, source_format, 2, TRUE FROM crec WHERE ingest_dt = (SELECT min(ingest_dt) FROM crec)
        UNION ALL
        SELECT DISTINCT 'delivery_events', ingest_dt, source_format, l_linenumber % 2, FALSE FROM drec)""", "crec", "drec"))
def _l3(fs):
    """L3/L4: ledger after parsing: PARSED with time, or FAILED with reason."""
    return fs.ledger.select(
        "source_system",
        F.to_date(F.regexp_extract("landing_file_path", r"ingest_dt=([0-9-]+)", 1)).alias("ingest_dt"),
        F.regexp_extract("landing_file_path", r"\.([a-z]+)$", 1).alias("source_format"),
        "status", "error_message", "received_at", "parsed_at")


_FILES = """SELECT DISTINCT 'complaints' AS system, ingest_dt, source_format, event_id % 2 AS part FROM crec
  UNION ALL SELECT DISTINCT 'delivery_events', ingest_dt, source_format, l_linenumber % 2 FROM drec"""


@register_files_query("pipeline_volumes_daily", o.sql(f"""
WITH landed AS ({_FILES}),
broken AS (SELECT DISTINCT source_format FROM crec WHERE ingest_dt = (SELECT min(ingest_dt) FROM crec)),
counts AS (
  SELECT 'landing' AS stage, system AS source_system, 'files_parsed' AS metric, count(*) AS value FROM landed GROUP BY system
  UNION ALL SELECT 'landing', 'complaints', 'files_failed', count(*) FROM broken
  UNION ALL SELECT 'landing', 'delivery_events', 'files_failed', 0
  UNION ALL SELECT 'landing', system, 'files_registered', count(*) + CASE system WHEN 'complaints' THEN (SELECT count(*) FROM broken) ELSE 0 END
              FROM landed GROUP BY system
  UNION ALL SELECT 'staging', 'complaints', 'rows_read', count(*) FROM crec
  UNION ALL SELECT 'staging', 'delivery_events', 'rows_read', count(*) FROM drec
  UNION ALL SELECT 'staging', 'complaints', 'rows_kept', count(*) FROM fact_c
  UNION ALL SELECT 'staging', 'delivery_events', 'rows_kept', count(*) FROM fact_d
  UNION ALL SELECT 'staging', 'complaints', 'rows_without_time', count(*) FILTER (complained_at IS NULL) FROM fact_c
  UNION ALL SELECT 'staging', 'delivery_events', 'rows_without_time', count(*) FILTER (delivered_at IS NULL) FROM fact_d
  UNION ALL SELECT 'dw', 'complaints', 'rows_loaded', count(*) FROM fact_c
  UNION ALL SELECT 'dw', 'delivery_events', 'rows_loaded', count(*) FROM fact_d
  UNION ALL SELECT 'dw', 'complaints', 'complaints_linked', count(*) FROM links1
  UNION ALL SELECT 'dw', 'complaints', 'complaints_waiting', count(*) FILTER (pickup_station_external_id IS NOT NULL) - (SELECT count(*) FROM links1) FROM fact_c)
SELECT {o.DAY1} AS volume_date, stage, source_system, metric, value FROM counts""", "crec", "drec", "fact_c", "fact_d", "links1"))
def _s1b(fs):
    """Volumes per (stage, date), observed while a whole daily run writes."""
    return fs.volumes


# ------------------------------------------------------------ further steps
@register("complaint_alerts", o.sql(f"""
SELECT d.ref_identifier AS pickup_identifier, d.name, d.zip_code, f.complained_date AS complaint_date,
       count(*) AS complaints, CAST(1 AS BIGINT) AS threshold
  FROM fact_c f JOIN links l USING (record_hash_sha256)
  JOIN dim2 d ON d.pickup_station_id = l.pickup_station_id AND d.is_current
 WHERE f.complained_at >= {o.AS_OF} - INTERVAL 14 DAY
 GROUP BY d.ref_identifier, d.name, d.zip_code, f.complained_date
HAVING count(*) > 1""", "fact_c", "links", "dim2"))
def _s7(sc):
    """Station-days in the 14-day window with more than one complaint."""
    return reports.complaint_alerts(sc.fact_complaint, sc.links, sc.dim2, td.AS_OF, threshold=1)


@register("complaint_delivery_link", o.sql("SELECT * FROM s2", "s2"))
def _s2(sc):
    """Each complaint with its delivery (parcel first, then order; as-of)."""
    return sc.correlation


@register("complaint_rate", o.sql("""
SELECT coalesce(a.delivery_month, b.delivery_month) AS delivery_month, coalesce(a.deliveries, 0) AS deliveries,
       coalesce(b.complaints, 0) AS complaints,
       CASE WHEN coalesce(a.deliveries, 0) > 0 THEN coalesce(b.complaints, 0) / coalesce(a.deliveries, 0) END AS complaint_rate
  FROM (SELECT CAST(date_trunc('month', delivered_at) AS DATE) AS delivery_month, count(*) AS deliveries
          FROM fact_d WHERE delivered_at IS NOT NULL GROUP BY 1) a
  FULL JOIN (SELECT CAST(date_trunc('month', delivered_at) AS DATE) AS delivery_month, count(*) AS complaints
          FROM s2 WHERE delivery_record_hash IS NOT NULL GROUP BY 1) b ON a.delivery_month = b.delivery_month""",
          "fact_d", "s2"))
def _s3(sc):
    """S3: complaints per delivery, by delivery month."""
    from depotlens.operators.correlation import complaint_rate
    return complaint_rate(sc.correlation, sc.fact_delivery)


@register("driver_complaints", o.sql("""
SELECT coalesce(a.driver_id, b.driver_id) AS driver_id, coalesce(a.deliveries, 0) AS deliveries,
       coalesce(b.complaints, 0) AS complaints, coalesce(b.complained_deliveries, 0) AS complained_deliveries,
       CASE WHEN coalesce(a.deliveries, 0) > 0 THEN coalesce(b.complaints, 0) / coalesce(a.deliveries, 0) END AS complaint_rate
  FROM (SELECT driver_id, count(*) AS deliveries FROM fact_d GROUP BY driver_id) a
  FULL JOIN (SELECT driver_id, count(*) AS complaints, count(DISTINCT delivery_record_hash) AS complained_deliveries
               FROM s2 WHERE delivery_record_hash IS NOT NULL GROUP BY driver_id) b ON a.driver_id IS NOT DISTINCT FROM b.driver_id""",
          "fact_d", "s2"))
def _s4(sc):
    """Drivers with their deliveries and the complaints traced to them."""
    from depotlens.operators.correlation import driver_complaints
    return driver_complaints(sc.correlation, sc.fact_delivery)


@register("recipient_behavior", o.sql("""
SELECT coalesce(a.n, b.n) AS recipient_name_norm, coalesce(a.ad, b.ad) AS recipient_address_norm,
       coalesce(a.deliveries, 0) AS deliveries, coalesce(b.complaints, 0) AS complaints,
       CASE WHEN coalesce(a.deliveries, 0) > 0 THEN coalesce(b.complaints, 0) / coalesce(a.deliveries, 0) END AS complaint_rate
  FROM (SELECT recipient_name_norm AS n, recipient_address_norm AS ad, count(*) AS deliveries FROM fact_d GROUP BY 1, 2) a
  FULL JOIN (SELECT recipient_name_norm AS n, recipient_address_norm AS ad, count(*) AS complaints FROM fact_c GROUP BY 1, 2) b
    ON a.n IS NOT DISTINCT FROM b.n AND a.ad IS NOT DISTINCT FROM b.ad""", "fact_d", "fact_c"))
def _s5(sc):
    """Per recipient, deliveries versus complaints."""
    from depotlens.operators.correlation import recipient_behavior
    return recipient_behavior(sc.fact_complaint, sc.fact_delivery)


_STATION_MATCH = """
WITH ids AS (SELECT DISTINCT pickup_station_external_id AS external_id FROM fact_d WHERE pickup_station_external_id IS NOT NULL),
x AS (SELECT external_id, TRY_CAST(regexp_extract(upper(regexp_replace(external_id, '[^A-Za-z0-9]', '', 'g')), '([0-9]+)$', 1) AS BIGINT) AS num,
             regexp_replace(upper(regexp_replace(external_id, '[^A-Za-z0-9]', '', 'g')), '[0-9]+$', '') AS letters FROM ids),
s AS (SELECT pickup_station_id, ref_identifier,
             TRY_CAST(regexp_extract(upper(regexp_replace(ref_identifier, '[^A-Za-z0-9]', '', 'g')), '([0-9]+)$', 1) AS BIGINT) AS num,
             regexp_replace(upper(regexp_replace(ref_identifier, '[^A-Za-z0-9]', '', 'g')), '[0-9]+$', '') AS letters
        FROM dim2 WHERE is_current),
best AS (SELECT * FROM (SELECT x.external_id, s.pickup_station_id, s.ref_identifier,
                               CAST(levenshtein(x.letters, s.letters) AS INTEGER) AS score,
                               row_number() OVER (PARTITION BY x.external_id ORDER BY levenshtein(x.letters, s.letters), s.ref_identifier) AS rn
                          FROM x JOIN s ON s.num = x.num
                           AND levenshtein(x.letters, s.letters) <= 0.6 * greatest(length(x.letters), length(s.letters))) WHERE rn = 1),
cross_ids AS (SELECT 'S-' || lpad(substr(ref_identifier, 4), 6, '0') AS external_id, pickup_station_id, ref_identifier
                FROM dim2 WHERE is_current AND ref_identifier LIKE 'PSX%')
"""


@register("station_match", o.sql(_STATION_MATCH + """
SELECT ids.external_id, b.pickup_station_id, b.ref_identifier, CASE WHEN b.external_id IS NOT NULL THEN 'fuzzy' END AS match_method,
       b.score
  FROM ids LEFT JOIN best b USING (external_id)""", "fact_d", "dim2"))
def _s6(sc):
    """Delivery-event station identifiers mapped to current stations."""
    from depotlens.operators.matching import match_stations
    return match_stations(sc.fact_delivery.select("pickup_station_external_id"), sc.dim2)


@register("station_match_crosswalk", o.sql(_STATION_MATCH + """
SELECT ids.external_id, coalesce(c.pickup_station_id, b.pickup_station_id) AS pickup_station_id,
       coalesce(c.ref_identifier, b.ref_identifier) AS ref_identifier,
       CASE WHEN c.external_id IS NOT NULL THEN 'crosswalk' WHEN b.external_id IS NOT NULL THEN 'fuzzy' END AS match_method,
       CASE WHEN c.external_id IS NULL THEN b.score END AS score
  FROM ids LEFT JOIN best b USING (external_id) LEFT JOIN cross_ids c USING (external_id)""", "fact_d", "dim2"))
def _s6b(sc):
    """The same with a crosswalk for the stations that changed identifiers."""
    from depotlens.operators.matching import match_stations
    cross = station_dim.current_rows(sc.dim2).where(F.col("ref_identifier").startswith("PSX")).select(
        F.concat(F.lit("S-"), F.lpad(F.expr("substr(ref_identifier, 4)"), 6, "0")).alias("external_id"), "ref_identifier")
    return match_stations(sc.fact_delivery.select("pickup_station_external_id"), sc.dim2, crosswalk=cross)


@register("station_crosswalk_conflict", o.sql(_STATION_MATCH + """,
double AS (SELECT external_id, ref_identifier FROM cross_ids
  UNION ALL SELECT 'S-' || lpad(substr(ref_identifier, 4), 6, '0'), ref_identifier FROM dim2 WHERE is_current AND ref_identifier LIKE 'PSN%'
  UNION ALL SELECT external_id, (SELECT max(ref_identifier) FROM dim2 WHERE is_current) FROM ids
  UNION ALL SELECT external_id, 'PS' || CAST(1 + CAST(substr(external_id, 3) AS BIGINT) AS VARCHAR) FROM ids),
chosen AS (SELECT c.external_id, arg_min(d.pickup_station_id, (d.ref_identifier, d.pickup_station_id)) AS pickup_station_id,
                  min(d.ref_identifier) AS ref_identifier
             FROM double c JOIN dim2 d ON d.is_current AND d.ref_identifier = c.ref_identifier GROUP BY c.external_id)
SELECT ids.external_id, c.pickup_station_id, c.ref_identifier, 'crosswalk' AS match_method, CAST(NULL AS INTEGER) AS score
  FROM ids JOIN chosen c USING (external_id)""", "fact_d", "dim2"))
def _s6c(sc):
    """A crosswalk that gives ids several references: id and reference
    come from one station."""
    from depotlens.operators.matching import match_stations
    cur = station_dim.current_rows(sc.dim2).select("ref_identifier")
    ids = sc.fact_delivery.select(F.col("pickup_station_external_id").alias("external_id")).distinct()
    last = cur.agg(F.max("ref_identifier").alias("ref_identifier"))
    renamed = cur.where(F.col("ref_identifier").rlike("^PS[XN]")).select(
        F.concat(F.lit("S-"), F.lpad(F.expr("substr(ref_identifier, 4)"), 6, "0")).alias("external_id"), "ref_identifier")
    following = ids.select("external_id", F.concat(F.lit("PS"), (F.expr("substr(external_id, 3)").cast("long") + 1)
                                                   .cast("string")).alias("ref_identifier"))
    greatest = ids.withColumn("ref_identifier", F.lit(last.first()[0]))  # one value
    return match_stations(sc.fact_delivery.select("pickup_station_external_id"), sc.dim2,
                          crosswalk=renamed.unionByName(following).unionByName(greatest))


#: S6 with given weights (whole numbers, so that sums are exact)
FIXED_WEIGHTS = {"name": {0: -3, 1: 4, 2: 6}, "zip": {0: -3, 2: 3}, "street": {0: -4, 1: 2, 2: 6}, "number": {0: -4, 2: 6}}
_COMPARED = """SELECT {ident} AS identifier, nullif(regexp_replace(upper(name), '[^A-Z0-9]', '', 'g'), '') AS name,
    nullif(trim(zip_code), '') AS zip, nullif(regexp_replace(upper(street), '[^A-Z0-9]', '', 'g'), '') AS street,
    nullif(regexp_extract(street, '([0-9]+)', 1), '') AS street_rough,
    CAST(TRY_CAST(regexp_extract({ident}, '([0-9]+)$', 1) AS BIGINT) AS VARCHAR) AS number FROM {src}"""
_ROUGH = """SELECT *, CASE WHEN name IS NOT NULL THEN array_to_string(list_transform(list_filter(
    list_zip(string_split(plain, ''), [''] || string_split(plain, '')), lambda x: x[1] IS NOT NULL AND (x[1] <> x[2] OR x[1] BETWEEN '0' AND '9')), lambda x: x[1]), '') END AS name_rough
  FROM (SELECT *, left(name, 1) || regexp_replace(substr(name, 2), '[AEIOU]', '', 'g') AS plain FROM ({0}))"""
_PARTNER = """SELECT 'S-' || lpad(CAST(CASE WHEN s_suppkey % 7 = 6 THEN s_suppkey + 500000 ELSE s_suppkey END AS VARCHAR), 6, '0') AS identifier,
    CASE s_suppkey % 4 WHEN 1 THEN lower(name) WHEN 2 THEN replace(name, 'i', '') WHEN 3 THEN 'Depot ' || (s_suppkey * 3) ELSE name END AS name,
    CASE s_suppkey % 5 WHEN 0 THEN NULL WHEN 1 THEN lpad(CAST((CAST(zip_code AS INTEGER) + 1) % 25 AS VARCHAR), 5, '0') ELSE zip_code END AS zip_code,
    CASE s_suppkey % 3 WHEN 1 THEN 'STREET  ' || s_suppkey WHEN 2 THEN 'Str. ' || s_suppkey ELSE street END AS street,
    identifier AS true_ref FROM st1
  UNION ALL SELECT 'S-9' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0'), 'Partner Depot ' || s_suppkey, zip_code, 'Harbour ' || s_suppkey, NULL
    FROM st1 WHERE s_suppkey % 6 = 0"""


def _levels(field: str, rough: bool) -> str:
    w = FIXED_WEIGHTS[field]
    middle = f"WHEN l.{field}_rough = r.{field}_rough THEN {w[1]} " if rough else ""
    return f"CASE WHEN l.{field} IS NULL OR r.{field} IS NULL THEN 0 WHEN l.{field} = r.{field} THEN {w[2]} {middle}ELSE {w[0]} END"


@register("station_link_fixed", o.sql(f"""
WITH l AS ({_ROUGH.replace("{0}", _COMPARED.format(ident="identifier", src=f"({_PARTNER})"))}),
r AS ({_ROUGH.replace("{0}", _COMPARED.format(ident="ref_identifier", src="(SELECT * FROM dim2 WHERE is_current)"))}),
pairs AS (SELECT l.identifier, r.identifier AS ref_identifier,
    {_levels("name", True)} + {_levels("zip", False)} + {_levels("street", True)} + {_levels("number", False)} AS score
  FROM l JOIN r ON l.number = r.number OR l.name_rough = r.name_rough OR (l.zip = r.zip AND l.street_rough = r.street_rough)),
best AS (SELECT *, row_number() OVER (PARTITION BY identifier ORDER BY score DESC, ref_identifier) AS rn FROM pairs WHERE score >= 5)
SELECT l.identifier, b.ref_identifier, b.score FROM l LEFT JOIN (SELECT * FROM best WHERE rn = 1) b USING (identifier)""", "st1", "dim2"))
def _s6d(sc):
    """Another system's station list linked to the current stations by
    agreement of name, zip, street and number, with given weights."""
    from depotlens.operators import linkage
    left = linkage.comparable(sc.partner_list, "identifier")
    right = linkage.comparable(station_dim.current_rows(sc.dim2), "ref_identifier")
    return linkage.link_stations(left, right, FIXED_WEIGHTS, 5)


@register("station_link_learned")
def _s6e(sc):
    """The same with weights learned by expectation maximisation, held
    against the planted truth: one row per partner station."""
    from depotlens.operators import linkage
    left = linkage.comparable(sc.partner_list, "identifier")
    right = linkage.comparable(station_dim.current_rows(sc.dim2), "ref_identifier")
    weights, prior = linkage.learn_weights(left, right)
    # more likely than not: the weights outweigh the odds of a random pair
    return linkage.link_stations(left, right, weights, -prior)


_AT = "TIMESTAMP '2024-01-31 00:00:00'"


@register("station_as_of", o.sql(f"""SELECT {o.DIM_COLS} FROM dim2
 WHERE valid_from <= {_AT} AND (valid_to IS NULL OR valid_to > {_AT})""", "dim2"))
def _s8(sc):
    """The station rows valid at 2024-01-31 00:00 (the day-1 state)."""
    import datetime as dt
    return station_dim.state_as_of(sc.dim2, dt.datetime(2024, 1, 31))


@register("complaint_station_at_link", o.sql("""
SELECT * EXCLUDE (rn) FROM (
  SELECT l.record_hash_sha256, l.pickup_station_id, l.linked_at, d.pickup_station_sk AS v_pickup_station_sk,
         d.ref_identifier AS v_ref_identifier, d.name AS v_name, d.zip_code AS v_zip_code,
         row_number() OVER (PARTITION BY l.record_hash_sha256 ORDER BY d.valid_from DESC, d.pickup_station_sk DESC) AS rn
    FROM links l LEFT JOIN dim2 d ON d.pickup_station_id = l.pickup_station_id AND d.valid_from <= l.linked_at)
 WHERE rn = 1""", "links", "dim2"))
def _s8b(sc):
    """Each link with the station version valid when it was made (as-of join)."""
    from depotlens.operators.asof import asof_join
    links = sc.links.select("record_hash_sha256", "pickup_station_id", "linked_at")
    return asof_join(links, sc.dim2, "pickup_station_id", "linked_at", "valid_from",
                     ["pickup_station_sk", "ref_identifier", "name", "zip_code"], tie="pickup_station_sk",
                     prefix="v_")


@register("pipeline_volumes", o.sql("""
SELECT 'landing' AS stage, source_system, 'files_' || lower(status) AS metric, count(*) AS value
  FROM ledger GROUP BY source_system, status
UNION ALL SELECT 'staging', 'complaints', 'rows_read', count(*) FROM craw
UNION ALL SELECT 'staging', 'complaints', 'rows_kept', count(*) FROM stg_c
UNION ALL SELECT 'staging', 'complaints', 'rows_without_time', count(*) FILTER (WHERE complained_at IS NULL) FROM stg_c
UNION ALL SELECT 'staging', 'complaints', 'rows_rejected_duplicate', (SELECT count(*) FROM craw) - (SELECT count(*) FROM stg_c)
UNION ALL SELECT 'staging', 'delivery_events', 'rows_read', count(*) FROM draw
UNION ALL SELECT 'staging', 'delivery_events', 'rows_kept', count(*) FROM stg_d
UNION ALL SELECT 'staging', 'delivery_events', 'rows_without_time', count(*) FILTER (WHERE delivered_at IS NULL) FROM stg_d
UNION ALL SELECT 'staging', 'delivery_events', 'rows_rejected_duplicate', (SELECT count(*) FROM draw) - (SELECT count(*) FROM stg_d)
UNION ALL SELECT 'dw', 'complaints', 'rows_loaded', count(*) FROM fact_c
UNION ALL SELECT 'dw', 'delivery_events', 'rows_loaded', count(*) FROM fact_d
UNION ALL SELECT 'dw', 'complaints', 'complaints_linked', count(*) FILTER (WHERE pickup_station_id IS NOT NULL) FROM cview
UNION ALL SELECT 'dw', 'complaints', 'complaints_unlinked', count(*) FILTER (WHERE pickup_station_id IS NULL) FROM cview""",
          "ledger", "craw", "stg_c", "draw", "stg_d", "fact_c", "fact_d", "cview"))
def _s1(sc):
    """Volumes and quality per pipeline stage."""
    from depotlens.operators.monitoring import pipeline_volumes
    return pipeline_volumes(
        sc.ledger,
        {"complaints": sc.staged_raw_complaints, "delivery_events": sc.staged_raw_deliveries},
        {"complaints": sc.stg_complaint, "delivery_events": sc.stg_delivery},
        {"complaints": sc.fact_complaint, "delivery_events": sc.fact_delivery},
        fx.complaint_view(sc.fact_complaint, sc.links))


# ------------------------------------------------- ratios, delays, episodes
_WILSON = "sqrt(p * (1.0 - p) / n + 9.0 / (4.0 * n * n))"


@register("complaint_rate_limits", o.sql(f"""
WITH hit AS (SELECT DISTINCT delivery_record_hash AS h FROM s2 WHERE delivery_record_hash IS NOT NULL),
per AS (SELECT CAST(date_trunc('month', delivered_at) AS DATE) AS delivery_month, pickup_station_external_id AS station,
               count(*) AS deliveries, count(h) AS complained
          FROM fact_d LEFT JOIN hit ON h = record_hash_sha256 WHERE delivered_at IS NOT NULL GROUP BY 1, 2),
month AS (SELECT delivery_month, sum(complained)::DOUBLE / sum(deliveries)::DOUBLE AS month_rate FROM per GROUP BY 1),
x AS (SELECT *, deliveries::DOUBLE AS n, complained::DOUBLE / deliveries::DOUBLE AS p FROM per JOIN month USING (delivery_month)),
y AS (SELECT delivery_month, station, deliveries, complained, p AS complaint_rate, month_rate,
             ((p + 9.0::DOUBLE / (2.0::DOUBLE * n)) - 3.0::DOUBLE * {_WILSON.replace("9.0", "9.0::DOUBLE").replace("4.0", "4.0::DOUBLE").replace("1.0", "1.0::DOUBLE")}) / (1.0::DOUBLE + 9.0::DOUBLE / n) AS lower_limit,
             ((p + 9.0::DOUBLE / (2.0::DOUBLE * n)) + 3.0::DOUBLE * {_WILSON.replace("9.0", "9.0::DOUBLE").replace("4.0", "4.0::DOUBLE").replace("1.0", "1.0::DOUBLE")}) / (1.0::DOUBLE + 9.0::DOUBLE / n) AS upper_limit FROM x)
SELECT *, CASE WHEN lower_limit > month_rate THEN 'high' WHEN upper_limit < month_rate THEN 'low' ELSE 'normal' END AS flag FROM y""",
          "fact_d", "s2"))
def _s3b(sc):
    """S3: abnormal complaint ratios per delivery month and station (funnel limits)."""
    from depotlens.operators.correlation import complaint_rate_limits
    return complaint_rate_limits(sc.correlation, sc.fact_delivery)


_SKETCH = """
sizes AS (SELECT driver_id, CAST(complained_at AS DATE) AS complaint_day, CAST(trunc(delay_seconds) AS BIGINT) AS delay FROM s2 WHERE delay_seconds IS NOT NULL),
cut AS (SELECT *, greatest(length(bin(abs(delay))) - 7, 0) AS bits FROM sizes),
sketch AS (SELECT complaint_day, driver_id, CASE WHEN delay < 0 THEN -((abs(delay) >> bits) << bits) ELSE (delay >> bits) << bits END AS bucket,
                  count(*) AS n FROM cut GROUP BY ALL)"""


@register("delay_sketch", o.sql(f"WITH {_SKETCH} SELECT * FROM sketch", "s2"))
def _s2b(sc):
    """Mergeable delay sketches per complaint day and driver."""
    return sc.delay_sketch


@register("delay_quantiles", o.sql(f"""
WITH {_SKETCH},
merged AS (SELECT driver_id, bucket, sum(n)::BIGINT AS n FROM sketch WHERE complaint_day >= {o.AS_OF} - INTERVAL 60 DAY GROUP BY 1, 2),
held AS (SELECT *, (sum(n) OVER (PARTITION BY driver_id))::BIGINT AS total,
                (sum(n) OVER (PARTITION BY driver_id ORDER BY bucket))::BIGINT AS upto FROM merged)
SELECT driver_id, max(total) AS delays, min(bucket) FILTER (upto >= ceil(total * 0.5::DOUBLE)) AS p50_seconds,
       min(bucket) FILTER (upto >= ceil(total * 0.9::DOUBLE)) AS p90_seconds, min(bucket) FILTER (upto >= ceil(total * 0.99::DOUBLE)) AS p99_seconds
  FROM held GROUP BY driver_id""", "s2"))
def _s2c(sc):
    """Delays per driver over the last 60 days, merged from the daily sketches."""
    import datetime as dt

    from depotlens.operators.correlation import delay_quantiles
    return delay_quantiles(sc.delay_sketch, since=td.AS_OF - dt.timedelta(days=60))


@register("missing_deliveries", o.sql("""
SELECT parcel_id, count(*) AS complaints, min(complained_at) AS first_complained_at, max(complained_at) AS last_complained_at,
       coalesce(bool_or(matched_by = 'purchase_order'), FALSE) AS order_delivered
  FROM s2 WHERE parcel_id IS NOT NULL AND matched_by IS DISTINCT FROM 'parcel' GROUP BY parcel_id""", "s2"))
def _s2d(sc):
    """Complained parcels without a delivery event."""
    from depotlens.operators.correlation import missing_deliveries
    return missing_deliveries(sc.correlation)


ALERT_THRESHOLD, QUIET_DAYS = 1, 2


@register("alert_episodes", o.sql(f"""
WITH days AS (SELECT pickup_station_id, complained_date AS d, count(*) AS n FROM cview
               WHERE pickup_station_id IS NOT NULL AND complained_date <= {o.DAY2} GROUP BY 1, 2 HAVING count(*) > {ALERT_THRESHOLD}),
marked AS (SELECT *, CASE WHEN d - lag(d) OVER (PARTITION BY pickup_station_id ORDER BY d) <= {QUIET_DAYS} THEN 0 ELSE 1 END AS new FROM days),
islands AS (SELECT *, sum(new) OVER (PARTITION BY pickup_station_id ORDER BY d) AS island FROM marked)
SELECT pickup_station_id, min(d) AS episode_start, max(d) AS episode_last, count(*) AS breach_days, sum(n)::BIGINT AS complaints,
       max(n) AS peak, {o.DAY2} - max(d) <= {QUIET_DAYS} AS is_open
  FROM islands GROUP BY pickup_station_id, island""", "cview"))
def _s7b(sc):
    """Alert episodes after both days: the state of day 1 and the
    breaches of day 2 merged."""
    from depotlens.operators import episodes
    new = episodes.breaches(sc.fact_complaint, sc.links, ALERT_THRESHOLD)
    first = episodes.advance(None, new.where(F.col("episode_start") <= F.lit(td.DAY1)), QUIET_DAYS)
    state = sc.store.put("alert_episodes", first)
    day2 = new.where((F.col("episode_start") > F.lit(td.DAY1)) & (F.col("episode_start") <= F.lit(td.DAY2)))
    return episodes.with_status(episodes.advance(state, day2, QUIET_DAYS), td.DAY2, QUIET_DAYS)
