"""Column expressions shared by the jobs (all JVM built-ins, no UDF)."""

from depotlens.functions.text import (  # noqa: F401
    attr_hash, fingerprint, fingerprint_is_blank, norm_text, record_hash, station_label,
    epoch_micros,
)
