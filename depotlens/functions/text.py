"""Normalisation, fingerprint and hash expressions.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the record hash (our rule K12): a null field is written as
# the "record separator" control character, fields are joined by the
# "unit separator" control character.
NULL_MARK = "\u001e"
FIELD_SEP = "\u001f"
EPOCH_NTZ = "timestamp_ntz'1970-01-01 00:00:00'"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm_text(c) -> Column:
    """Rule K11: collapse white space, trim, upper case; blank becomes null."""
    t = F.upper(F.trim(F.regexp_replace(_c(c), r"\s+", " ")))
    return F.when(t == "", F.lit(None).cast("string")).otherwise(t)


def fingerprint(zip_code="zip_code", street="street") -> Column:
    """upper(coalesce(zip,'') || '|' || coalesce(street,'')), no trim."""
    return F.upper(F.concat(F.coalesce(_c(zip_code), F.lit("")), F.lit("|"),
                            F.coalesce(_c(street), F.lit(""))))


def fingerprint_is_blank(zip_code="zip_code", street="street") -> Column:
    """K3: a fingerprint whose two parts are both blank never matches."""
    return ((F.trim(F.coalesce(_c(zip_code), F.lit(""))) == "")
            & (F.trim(F.coalesce(_c(street), F.lit(""))) == ""))


def attr_hash(name="name", city="city", zip_code="zip_code", street="street") -> Column:
    """D3: hex sha256 of name|city|zip|street, null parts as ''."""
    parts = [F.coalesce(_c(x), F.lit("")) for x in (name, city, zip_code, street)]
    return F.sha2(F.concat_ws("|", *parts), 256)


def epoch_micros(ts) -> Column:
    """Microseconds since 1970-01-01 of a TIMESTAMP_NTZ (no time-zone step)."""
    return F.expr(f"timestampdiff(MICROSECOND, {EPOCH_NTZ}, {ts})") if isinstance(ts, str) \
        else F.timestamp_diff("MICROSECOND", F.expr(EPOCH_NTZ), ts)


def record_hash(source_system: str, time_col: str, text_cols: list[str], time_text: str | None = None) -> Column:
    """sha256 over source system, event time (epoch micros) and the
    content fields; file id and position are left out so a record sent
    twice gets the same hash. ``time_text``: column with the time as sent; it
    stands for a time that could not be read, so unlike records stay unlike."""
    raw = [F.concat(F.lit("text:"), F.col(time_text))] if time_text else []
    parts = [F.lit(source_system),
             F.coalesce(epoch_micros(time_col).cast("string"), *raw, F.lit(NULL_MARK))]
    parts += [F.coalesce(F.col(c), F.lit(NULL_MARK)) for c in text_cols]
    return F.sha2(F.concat_ws(FIELD_SEP, *parts), 256)


def station_label(ref="ref_identifier", name="name", zip_code="zip_code") -> Column:
    """R2 enriched entry: ref || ' - ' || coalesce(name,'') || ' (' || coalesce(zip,'') || ')'."""
    return F.concat(_c(ref), F.lit(" - "), F.coalesce(_c(name), F.lit("")), F.lit(" ("),
                    F.coalesce(_c(zip_code), F.lit("")), F.lit(")"))
