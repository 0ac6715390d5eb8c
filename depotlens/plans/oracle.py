"""DuckDB oracle SQL for the registered queries.

The same scenario as :mod:`depotlens.plans.scenario`, written independently
as plain SQL over the driver's tables. ``sql(final, *needs)`` assembles the
named CTEs a final SELECT depends on.
"""

from __future__ import annotations

# Fixed values of the test scenario (equal to depotlens.sources.testdata).
DAY1, DAY2, AS_OF = "DATE '2024-01-30'", "DATE '2024-01-31'", "DATE '2024-01-31'"
RUN1, RUN2 = "TIMESTAMP '2024-01-30 23:00:00'", "TIMESTAMP '2024-01-31 23:00:00'"

_FMT = "CASE {x} % 3 WHEN 0 THEN 'csv' WHEN 1 THEN 'json' ELSE 'xml' END"
_NORM = "NULLIF(upper(trim(regexp_replace({c}, '\\s+', ' ', 'g'))), '')"


def _hash(system: str, time_col: str, cols: list[str]) -> str:
    parts = [f"'{system}'", f"coalesce(CAST(epoch_us({time_col}) AS VARCHAR), chr(30))"]
    parts += [f"coalesce({c}, chr(30))" for c in cols]
    return f"sha256(concat_ws(chr(31), {', '.join(parts)}))"


C_TEXT = ["pickup_station_external_id", "recipient_name", "recipient_address", "parcel_id",
          "purchase_order_id", "complaint_text"]
D_TEXT = ["pickup_station_external_id", "driver_id", "parcel_id", "purchase_order_id",
          "recipient_name", "recipient_address"]
C_FIELDS = ["complained_at", *C_TEXT]
D_FIELDS = ["delivered_at", *D_TEXT]
DIM_COLS = ("pickup_station_sk, pickup_station_id, ref_identifier, name, city, zip_code, street, "
            "fingerprint, attr_hash_sha256, valid_from, valid_to, is_current, is_active")
ATTRS = "ref_identifier, name, city, zip_code, street, fingerprint, attr_hash_sha256"
LEDGER_COLS = ("file_id, source_system, source_file_path, source_modified_at, file_size_bytes, "
               "landing_file_path, received_at, parsed_at, status, error_message")


def _snap(src: str, day: str) -> str:
    return f"""SELECT {day} AS snapshot_date, identifier AS ref_identifier, name, city, zip_code, street,
        upper(coalesce(zip_code, '') || '|' || coalesce(street, '')) AS fingerprint,
        sha256(coalesce(name, '') || '|' || coalesce(city, '') || '|' || coalesce(zip_code, '') || '|' || coalesce(street, '')) AS attr_hash_sha256,
        (trim(coalesce(zip_code, '')) = '' AND trim(coalesce(street, '')) = '') AS fp_blank
      FROM {src}"""


def _listing(system: str, src: str, tcol: str) -> str:
    fname = f"'{system}_' || strftime(ingest_dt, '%Y%m%d') || '.' || source_format"
    return f"""SELECT '{system}' AS source_system,
        '//fileserver/incoming/{system}/' || {fname} AS source_file_path,
        max({tcol}) AS source_modified_at, count(*) * 64 AS file_size_bytes,
        'landing/{system}/ingest_dt=' || strftime(ingest_dt, '%Y-%m-%d') || '/' || {fname} AS landing_file_path,
        ingest_dt, source_format
      FROM {src} GROUP BY ingest_dt, source_format"""


def _staged(system: str, src: str, fields: list[str], text: list[str], order: str) -> str:
    tcol = fields[0]
    cols = ", ".join(f"r.{c}" for c in fields)
    return f"""SELECT f.file_id,
        CAST(row_number() OVER (PARTITION BY f.file_id ORDER BY {order}) - 1 AS INTEGER) AS record_index,
        {_hash(system, 'r.' + tcol, ['r.' + c for c in text])} AS record_hash_sha256,
        {cols},
        {_NORM.format(c='r.recipient_name')} AS recipient_name_norm,
        {_NORM.format(c='r.recipient_address')} AS recipient_address_norm,
        {RUN1} AS ingested_at
      FROM {src} r JOIN files f ON f.source_system = '{system}' AND f.ingest_dt = r.ingest_dt
        AND f.source_format = r.source_format"""


def _dedup(src: str) -> str:
    return f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY record_hash_sha256
        ORDER BY file_id, record_index) AS rn FROM {src}) WHERE rn = 1"""


def _dim_new(prev: str, resolved: str, run: str) -> str:
    """Rows of a dimension after one snapshot (classes from one frozen state)."""
    return f"""
    SELECT * FROM {prev} WHERE NOT is_current
    UNION ALL
    SELECT d.pickup_station_sk, d.pickup_station_id, d.ref_identifier, d.name, d.city, d.zip_code, d.street,
           d.fingerprint, d.attr_hash_sha256, d.valid_from,
           CASE WHEN r.pickup_station_id IS NULL OR r.attr_hash_sha256 <> d.attr_hash_sha256
                     OR r.ref_identifier <> d.ref_identifier THEN {run} ELSE d.valid_to END,
           (r.pickup_station_id IS NOT NULL AND r.attr_hash_sha256 = d.attr_hash_sha256
                     AND r.ref_identifier = d.ref_identifier),
           r.pickup_station_id IS NOT NULL
      FROM {prev} d LEFT JOIN (SELECT * FROM {resolved} WHERE pickup_station_id IS NOT NULL) r
        ON r.pickup_station_id = d.pickup_station_id
     WHERE d.is_current
    UNION ALL
    SELECT (SELECT coalesce(max(pickup_station_sk), 0) FROM {prev})
             + row_number() OVER (ORDER BY n.pickup_station_id) AS pickup_station_sk,
           n.pickup_station_id, {', '.join('n.' + a.strip() for a in ATTRS.split(','))},
           {run} AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current, TRUE AS is_active
      FROM (
        SELECT d.pickup_station_id, {', '.join('r.' + a.strip() for a in ATTRS.split(','))}
          FROM {prev} d JOIN {resolved} r ON r.pickup_station_id = d.pickup_station_id
         WHERE d.is_current AND (r.attr_hash_sha256 <> d.attr_hash_sha256 OR r.ref_identifier <> d.ref_identifier)
        UNION ALL
        SELECT (SELECT coalesce(max(pickup_station_id), 0) FROM {prev})
                 + row_number() OVER (ORDER BY r.ref_identifier) AS pickup_station_id,
               {', '.join('r.' + a.strip() for a in ATTRS.split(','))}
          FROM {resolved} r WHERE r.pickup_station_id IS NULL
      ) n"""


def _resolve(prev: str, snap: str) -> str:
    """K2: ref match first; then one-to-one fingerprint pairs of leftovers."""
    return f"""
    WITH cur AS (SELECT * FROM {prev} WHERE is_current),
    by_ref AS (SELECT ref_identifier, min(pickup_station_id) AS ref_id FROM cur GROUP BY ref_identifier),
    t AS (SELECT s.*, b.ref_id FROM {snap} s LEFT JOIN by_ref b USING (ref_identifier)),
    cur_left AS (SELECT * FROM cur WHERE pickup_station_id NOT IN
                   (SELECT ref_id FROM t WHERE ref_id IS NOT NULL)
                 AND NOT (trim(coalesce(zip_code, '')) = '' AND trim(coalesce(street, '')) = '')),
    snap_left AS (SELECT * FROM t WHERE ref_id IS NULL AND NOT fp_blank),
    pairs AS (
      SELECT s.ref_identifier, c.pickup_station_id AS fp_id
        FROM (SELECT * FROM snap_left WHERE fingerprint IN
                (SELECT fingerprint FROM snap_left GROUP BY fingerprint HAVING count(*) = 1)) s
        JOIN (SELECT * FROM cur_left WHERE fingerprint IN
                (SELECT fingerprint FROM cur_left GROUP BY fingerprint HAVING count(*) = 1)) c
          ON c.fingerprint = s.fingerprint)
    SELECT t.* EXCLUDE (ref_id, fp_blank), coalesce(t.ref_id, p.fp_id) AS pickup_station_id,
           CASE WHEN t.ref_id IS NOT NULL THEN 'ref' WHEN p.fp_id IS NOT NULL THEN 'fingerprint' END AS match
      FROM t LEFT JOIN pairs p USING (ref_identifier)"""


CTES: dict[str, tuple[list[str], str]] = {
    "st1": ([], """SELECT 'PS' || CAST(s_suppkey AS VARCHAR) AS identifier, s_name AS name, n_name AS city,
        lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS zip_code, 'Street ' || CAST(s_suppkey AS VARCHAR) AS street,
        s_suppkey FROM supplier JOIN nation ON n_nationkey = s_nationkey"""),
    "st2": (["st1"], """SELECT CASE WHEN s_suppkey % 10 = 2 THEN 'PSX' || CAST(s_suppkey AS VARCHAR) ELSE identifier END AS identifier,
        CASE WHEN s_suppkey % 10 = 1 THEN name || ' NEW' ELSE name END AS name, city, zip_code, street, s_suppkey
        FROM st1 WHERE s_suppkey % 10 <> 0
      UNION ALL
      SELECT 'PSN' || CAST(s_suppkey AS VARCHAR), name, city, zip_code, 'New Street ' || CAST(s_suppkey AS VARCHAR), s_suppkey
        FROM st1 WHERE s_suppkey % 10 = 3"""),
    "crec": ([], f"""SELECT e.event_id, e.ts AS received_at, CAST(e.ts AS DATE) AS ingest_dt,
        {_FMT.format(x='e.event_id')} AS source_format,
        e.ts - to_days(CAST((e.event_id % 4) * 25 AS INTEGER)) AS complained_at,
        CASE WHEN e.event_id % 11 = 10 THEN 'XX' || CAST(e.event_id % 3 AS VARCHAR)
             WHEN e.event_id % 11 = 9 THEN NULL
             ELSE 'PS' || CAST((e.user_id * 7 + e.event_id % 3) % (SELECT count(*) FROM supplier) AS VARCHAR) END
          AS pickup_station_external_id,
        CASE WHEN e.event_id % 2 = 0 THEN c.c_name ELSE ' ' || lower(c.c_name) END AS recipient_name,
        c.c_mktsegment || ' ' || CAST(c.c_nationkey AS VARCHAR) AS recipient_address,
        CAST(e.event_id % (SELECT count(*) FROM orders) AS VARCHAR) || '-' || CAST(e.event_id % 7 + 1 AS VARCHAR) AS parcel_id,
        CAST(e.event_id % (SELECT count(*) FROM orders) AS VARCHAR) AS purchase_order_id,
        'Parcel ' || CAST(e.event_id % (SELECT count(*) FROM orders) AS VARCHAR) || '-' || CAST(e.event_id % 7 + 1 AS VARCHAR)
          || ' late ' || coalesce(e.props, '') AS complaint_text
      FROM events e JOIN customer c ON c.c_custkey = e.user_id WHERE e.event_type = 'error'"""),
    "drec": ([], f"""SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice,
        l.l_discount, l.l_tax, l.l_returnflag, l.l_linestatus,
        CAST(date_trunc('month', l.l_shipdate) AS DATE) AS ingest_dt,
        {_FMT.format(x='l.l_linenumber')} AS source_format,
        l.l_shipdate AS delivered_at,
        'S-' || lpad(CAST(l.l_suppkey AS VARCHAR), 6, '0') AS pickup_station_external_id,
        'D' || CAST(l.l_suppkey % 7 AS VARCHAR) AS driver_id,
        CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS parcel_id,
        CAST(l.l_orderkey AS VARCHAR) AS purchase_order_id,
        c.c_name AS recipient_name,
        c.c_mktsegment || ' ' || CAST(c.c_nationkey AS VARCHAR) AS recipient_address
      FROM lineitem l LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey
        LEFT JOIN customer c ON c.c_custkey = o.o_custkey"""),
    "clist": (["crec"], _listing("complaints", "crec", "received_at")),
    "dlist": (["drec"], _listing("delivery_events", "drec", "delivered_at")),
    "resent": (["clist"], """SELECT source_system, source_file_path, source_modified_at + INTERVAL 1 HOUR AS source_modified_at,
        file_size_bytes + 64 AS file_size_bytes, landing_file_path, ingest_dt, source_format
      FROM clist WHERE ingest_dt = (SELECT max(ingest_dt) FROM clist)"""),
    "listing1": (["clist", "dlist"], "SELECT * FROM clist UNION ALL SELECT * FROM dlist"),
    "ledger1": (["listing1"], f"""SELECT row_number() OVER (ORDER BY source_system, source_file_path, source_modified_at,
        file_size_bytes) AS file_id, source_system, source_file_path, source_modified_at, file_size_bytes,
        landing_file_path, {RUN1} AS received_at, CAST(NULL AS TIMESTAMP) AS parsed_at, 'RECEIVED' AS status,
        CAST(NULL AS VARCHAR) AS error_message FROM listing1"""),
    "ledger": (["ledger1", "resent"], f"""SELECT {LEDGER_COLS} FROM ledger1
      UNION ALL
      SELECT (SELECT max(file_id) FROM ledger1) + row_number() OVER (ORDER BY source_system, source_file_path,
        source_modified_at, file_size_bytes), source_system, source_file_path, source_modified_at, file_size_bytes,
        landing_file_path, {RUN2}, CAST(NULL AS TIMESTAMP), 'RECEIVED', CAST(NULL AS VARCHAR) FROM resent"""),
    "files": (["ledger", "listing1", "resent"], """SELECT l.file_id, l.source_system, x.ingest_dt, x.source_format
      FROM ledger l JOIN (SELECT * FROM listing1 UNION ALL SELECT * FROM resent) x
        ON x.source_system = l.source_system AND x.source_file_path = l.source_file_path
       AND x.source_modified_at = l.source_modified_at AND x.file_size_bytes = l.file_size_bytes"""),
    "craw": (["crec", "files"], _staged("complaints", "crec", C_FIELDS, C_TEXT, "r.event_id")),
    "draw": (["drec", "files"], _staged("delivery_events", "drec", D_FIELDS, D_TEXT,
                                        "r.l_orderkey, r.l_linenumber, r.l_partkey, r.l_suppkey, r.l_quantity, "
                                        "r.l_extendedprice, r.l_discount, r.l_tax, r.l_returnflag, r.l_linestatus, "
                                        "r.delivered_at")),
    "stg_c": (["craw"], _dedup("craw")),
    "stg_d": (["draw"], _dedup("draw")),
    "fact_c": (["stg_c"], """SELECT row_number() OVER (ORDER BY file_id, record_index) AS complaint_sk,
        record_hash_sha256, file_id, complained_at, CAST(complained_at AS DATE) AS complained_date,
        CAST(date_trunc('month', complained_at) AS DATE) AS complained_month,
        pickup_station_external_id, recipient_name, recipient_address, recipient_name_norm, recipient_address_norm,
        complaint_text, purchase_order_id, parcel_id,
        coalesce(complained_at, TIMESTAMP '2024-01-30 23:00:00') AS created_at FROM stg_c"""),
    "fact_d": (["stg_d"], f"""SELECT row_number() OVER (ORDER BY file_id, record_index) AS delivery_event_sk,
        record_hash_sha256, file_id, delivered_at, CAST(delivered_at AS DATE) AS delivered_date,
        CAST(date_trunc('month', delivered_at) AS DATE) AS delivered_month,
        pickup_station_external_id, driver_id, parcel_id, purchase_order_id, recipient_name, recipient_address,
        recipient_name_norm, recipient_address_norm, {RUN1} AS created_at FROM stg_d"""),
    "snap1": (["st1"], _snap("st1", DAY1)),
    "snap2": (["st2"], _snap("st2", DAY2)),
    "snaps": (["snap1", "snap2"], f"""SELECT {DAY1} AS snapshot_date, ref_identifier FROM snap1
      UNION ALL SELECT DISTINCT {DAY2}, ref_identifier FROM (SELECT ref_identifier FROM snap1 UNION ALL SELECT ref_identifier FROM snap2)"""),
    "dim0": ([], f"""SELECT CAST(NULL AS BIGINT) AS pickup_station_sk, CAST(NULL AS BIGINT) AS pickup_station_id,
        CAST(NULL AS VARCHAR) AS ref_identifier, CAST(NULL AS VARCHAR) AS name, CAST(NULL AS VARCHAR) AS city,
        CAST(NULL AS VARCHAR) AS zip_code, CAST(NULL AS VARCHAR) AS street, CAST(NULL AS VARCHAR) AS fingerprint,
        CAST(NULL AS VARCHAR) AS attr_hash_sha256, CAST(NULL AS TIMESTAMP) AS valid_from,
        CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current, TRUE AS is_active WHERE FALSE"""),
    "res1": (["dim0", "snap1"], _resolve("dim0", "snap1")),
    "dim1": (["dim0", "res1"], _dim_new("dim0", "res1", RUN1)),
    "res2": (["dim1", "snap2"], _resolve("dim1", "snap2")),
    "dim2": (["dim1", "res2"], _dim_new("dim1", "res2", RUN2)),
    "links1": (["fact_c", "dim1"], f"""SELECT f.record_hash_sha256, f.complained_date, f.complained_month, d.pickup_station_id,
        {RUN1} AS linked_at FROM fact_c f
        JOIN (SELECT ref_identifier, min(pickup_station_id) AS pickup_station_id FROM dim1 WHERE is_current
              GROUP BY ref_identifier) d ON d.ref_identifier = f.pickup_station_external_id"""),
    "links": (["fact_c", "dim2", "links1"], f"""SELECT * FROM links1 UNION ALL
      SELECT f.record_hash_sha256, f.complained_date, f.complained_month, d.pickup_station_id, {RUN2} AS linked_at
        FROM fact_c f
        JOIN (SELECT ref_identifier, min(pickup_station_id) AS pickup_station_id FROM dim2 WHERE is_current
              GROUP BY ref_identifier) d ON d.ref_identifier = f.pickup_station_external_id
       WHERE f.record_hash_sha256 NOT IN (SELECT record_hash_sha256 FROM links1)"""),
    "s2": (["fact_c", "fact_d"], """
    WITH c AS (SELECT record_hash_sha256, complained_at, parcel_id, purchase_order_id FROM fact_c),
    d AS (SELECT record_hash_sha256 AS d_hash, delivered_at, driver_id, parcel_id, purchase_order_id
            FROM fact_d WHERE delivered_at IS NOT NULL),
    bp AS (SELECT * FROM (SELECT c.record_hash_sha256, d.d_hash, d.delivered_at, d.driver_id,
                 row_number() OVER (PARTITION BY c.record_hash_sha256 ORDER BY
                   coalesce(d.delivered_at <= c.complained_at, FALSE) DESC, d.delivered_at DESC, d.d_hash DESC) AS rn
            FROM c JOIN d ON d.parcel_id = c.parcel_id) WHERE rn = 1),
    bo AS (SELECT * FROM (SELECT c.record_hash_sha256, d.d_hash, d.delivered_at, d.driver_id,
                 row_number() OVER (PARTITION BY c.record_hash_sha256 ORDER BY
                   coalesce(d.delivered_at <= c.complained_at, FALSE) DESC, d.delivered_at DESC, d.d_hash DESC) AS rn
            FROM c JOIN d ON d.purchase_order_id = c.purchase_order_id
           WHERE c.record_hash_sha256 NOT IN (SELECT record_hash_sha256 FROM bp)) WHERE rn = 1)
    SELECT c.record_hash_sha256, c.complained_at, c.parcel_id, c.purchase_order_id,
           CASE WHEN p.d_hash IS NOT NULL THEN 'parcel' WHEN q.d_hash IS NOT NULL THEN 'purchase_order' END AS matched_by,
           coalesce(p.d_hash, q.d_hash) AS delivery_record_hash,
           coalesce(p.delivered_at, q.delivered_at) AS delivered_at,
           coalesce(p.driver_id, q.driver_id) AS driver_id,
           (epoch_us(c.complained_at) - epoch_us(coalesce(p.delivered_at, q.delivered_at))) / 1000000.0 AS delay_seconds
      FROM c LEFT JOIN bp p USING (record_hash_sha256) LEFT JOIN bo q USING (record_hash_sha256)"""),
    "cview": (["fact_c", "links"], """SELECT f.*, l.pickup_station_id FROM fact_c f
        LEFT JOIN links l USING (record_hash_sha256)"""),
}


def sql(final: str, *needs: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    if not order:
        return final
    body = ",\n".join(f"{n} AS (\n{CTES[n][1]}\n)" for n in order)
    head = final.lstrip()
    if head[:5].upper() == "WITH ":
        return f"WITH {body},\n{head[5:]}"
    return f"WITH {body}\n{final}"
