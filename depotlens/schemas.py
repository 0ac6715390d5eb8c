"""Fixed schemas of the pipeline tables (nothing is inferred)."""

from pyspark.sql import types as T

S, L, I, TS, D, B = (T.StringType(), T.LongType(), T.IntegerType(),
                     T.TimestampNTZType(), T.DateType(), T.BooleanType())


def _struct(*cols):
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in cols])


# File listing handed to the ledger (one row per file seen on the file server).
FILE_LISTING = _struct(
    ("source_system", S, False), ("source_file_path", S, False),
    ("source_modified_at", TS, False), ("file_size_bytes", L, False),
    ("landing_file_path", S, False),
)

LEDGER = _struct(
    ("file_id", L, False), ("source_system", S, False), ("source_file_path", S, False),
    ("source_modified_at", TS, False), ("file_size_bytes", L, False),
    ("landing_file_path", S, False), ("received_at", TS, False), ("parsed_at", TS, True),
    ("status", S, False), ("error_message", S, True),
)

LEDGER_NATURAL_KEY = ["source_system", "source_file_path", "source_modified_at", "file_size_bytes"]

# Content columns of one source record, in file order.
COMPLAINT_FIELDS = ["complained_at", "pickup_station_external_id", "recipient_name",
                    "recipient_address", "parcel_id", "purchase_order_id", "complaint_text"]
DELIVERY_FIELDS = ["delivered_at", "pickup_station_external_id", "driver_id", "parcel_id",
                   "purchase_order_id", "recipient_name", "recipient_address"]

COMPLAINT_RECORD = _struct(("complained_at", TS, True), *[(c, S, True) for c in COMPLAINT_FIELDS[1:]])
DELIVERY_RECORD = _struct(("delivered_at", TS, True), *[(c, S, True) for c in DELIVERY_FIELDS[1:]])

STAGING_EXTRA = ["file_id", "record_index", "record_hash_sha256",
                 "recipient_name_norm", "recipient_address_norm", "ingested_at"]

STATION_LIST = _struct(("identifier", S, False), ("name", S, True), ("city", S, True),
                       ("zip_code", S, True), ("street", S, True))

STATION_SNAPSHOT = _struct(
    ("snapshot_date", D, False), ("ref_identifier", S, False), ("name", S, True),
    ("city", S, True), ("zip_code", S, True), ("street", S, True),
    ("fingerprint", S, False), ("attr_hash_sha256", S, False),
)

STATION_DIM = _struct(
    ("pickup_station_sk", L, False), ("pickup_station_id", L, False),
    ("ref_identifier", S, False), ("name", S, True), ("city", S, True),
    ("zip_code", S, True), ("street", S, True), ("fingerprint", S, False),
    ("attr_hash_sha256", S, False), ("valid_from", TS, False), ("valid_to", TS, True),
    ("is_current", B, False), ("is_active", B, False),
)
STATION_DIM_COLUMNS = [f.name for f in STATION_DIM.fields]

FACT_COMPLAINT_COLUMNS = [
    "complaint_sk", "record_hash_sha256", "file_id", "complained_at", "complained_date", "complained_month",
    "pickup_station_external_id", "recipient_name", "recipient_address",
    "recipient_name_norm", "recipient_address_norm", "complaint_text",
    "purchase_order_id", "parcel_id", "created_at",
]

FACT_DELIVERY_COLUMNS = [
    "delivery_event_sk", "record_hash_sha256", "file_id", "delivered_at", "delivered_date", "delivered_month",
    "pickup_station_external_id", "driver_id", "parcel_id", "purchase_order_id",
    "recipient_name", "recipient_address", "recipient_name_norm", "recipient_address_norm",
    "created_at",
]

COMPLAINT_LINK = _struct(("record_hash_sha256", S, False), ("complained_date", D, True),
                         ("complained_month", D, True),
                         ("pickup_station_id", L, False), ("linked_at", TS, False))

MONITORING = _struct(("monitoring_date", D, False), ("complaints_loaded", L, False),
                     ("complaints_unresolved", L, False), ("updated_at", TS, False))
