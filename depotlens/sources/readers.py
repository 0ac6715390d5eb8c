"""Readers for landing files (L5-L7): CSV, JSON Lines and XML into staging rows.

Every field is read as text (K14); the event time is converted with
``try_cast`` so unreadable text becomes null instead of failing the job.
A file with any corrupt record, or a CSV file whose header differs from the
expected one, fails as a whole; a file without records is PARSED with zero
rows. A file that is missing or cannot be read fails alone: the others of its
claim go on. A JSON file may be JSON Lines or one array over several lines.

Rows find their file by the decoded URI (``uri_key``), so names may hold
spaces, percent signs, brackets and other characters; a row of no claimed
file is an error, never dropped.

``record_index`` is the position in the file: ``_metadata.file_block_start``
orders the splits of a file and ``monotonically_increasing_id`` the rows of a
split, so it is right also when a large file is read by several tasks
(:func:`with_positions`).
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from depotlens.operators.staging import KINDS, finish_staging
from depotlens.session import written
from depotlens.sources.files import CSV_OPTIONS, ROW_TAG

CORRUPT = "_corrupt_record"


def _schema(fields: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in fields]
                        + [T.StructField(CORRUPT, T.StringType())])


def _reader(spark: SparkSession, fmt: str, fields: list[str]):
    r = (spark.read.schema(_schema(fields)).option("mode", "PERMISSIVE")
         .option("columnNameOfCorruptRecord", CORRUPT))
    if fmt == "csv":
        # header read as a data row, so it can be checked per file
        r = r.option("header", False).option("multiLine", True)
        for k, v in CSV_OPTIONS.items():
            r = r.option(k, v)
        return r.format("csv")
    if fmt == "json":
        return r.format("json")
    return r.option("rowTag", ROW_TAG).option("ignoreSurroundingSpaces", False).format("xml")


def uri_key(path) -> F.Column:
    """One form for a file's plain path and its URI in the metadata column:
    percent codes decoded (the plain path is encoded first), one slash after
    the scheme where there is no host."""
    return F.regexp_replace(path, "^([A-Za-z][A-Za-z0-9+.-]*):/+(?=[^/])", "$1:/")


def metadata_key() -> F.Column:
    # a plus sign stands for itself in a URI path
    return uri_key(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))))


def literal_path(path: str) -> str:
    """The path as a pattern that matches only itself."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def read_records(spark: SparkSession, paths_by_format: dict[str, list[str]], fields: list[str],
                 options: dict | None = None) -> DataFrame:
    """All records of the given files with file path, split start, row id,
    format and corrupt marker. CSV header rows are kept for the check."""
    parts = []
    for fmt, paths in sorted(paths_by_format.items()):
        if not paths:
            continue
        df = _reader(spark, fmt, fields).options(**(options or {})).load([literal_path(p) for p in paths])
        parts.append(df.select(
            metadata_key().alias("file_path"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_m"),
            F.lit(fmt).alias("source_format"), *fields, CORRUPT))
    if not parts:
        return spark.createDataFrame([], T.StructType([
            T.StructField("file_path", T.StringType()), T.StructField("source_format", T.StringType()),
            *[T.StructField(c, T.StringType()) for c in fields],
            T.StructField(CORRUPT, T.StringType()), T.StructField("_block", T.LongType()),
            T.StructField("_m", T.LongType())]))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return rows


def with_positions(rows: DataFrame) -> DataFrame:
    """``_pos``: 0-based position of each record in its file.

    Rows of one split are read in order by one task, so their
    ``monotonically_increasing_id`` values are consecutive. Position = rows
    of the earlier splits of the file + offset inside the split. Only a
    per-split count table is built (one row per split of the claimed files,
    so its broadcast is bounded by the claim); no window over a whole file,
    so one very large file is not sorted in a single task. ``rows`` must be
    materialised (the ids must not be recomputed differently)."""
    splits = rows.groupBy("file_path", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_m").alias("_m0"))
    earlier = Window.partitionBy("file_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("file_path", "_block", "_m0",
                           F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"))
    j = rows.join(F.broadcast(splits), ["file_path", "_block"])
    return j.withColumn("_pos", F.col("_off") + F.col("_m") - F.col("_m0")).drop("_off", "_m0", "_block", "_m")


def file_outcomes(rows: DataFrame, batch: DataFrame, fields: list[str]) -> DataFrame:
    """(file_id, ok, error_message, records) for every claimed file."""
    header_ok = F.lit(True)
    for c in fields:
        header_ok = header_ok & (F.col(c) == F.lit(c))
    is_header = (F.col("source_format") == "csv") & (F.col("_pos") == 0)
    per = rows.groupBy("file_path").agg(
        F.count_if(F.col(CORRUPT).isNotNull()).alias("_bad"),
        F.max(F.when(is_header, F.when(header_ok, 0).otherwise(1))).alias("_hdr_bad"),
        F.count_if(~is_header).alias("records"))
    o = batch.select("file_id", uri_key(F.col("landing_file_path")).alias("file_path")).join(per, "file_path", "left")
    err = (F.when(F.col("_bad") > 0, F.concat(F.lit("CORRUPT_RECORDS: "), F.col("_bad").cast("string")))
           .when(F.col("_hdr_bad") == 1, F.lit("HEADER_MISMATCH")))
    return o.select("file_id", err.isNull().alias("ok"), err.alias("error_message"),
                    F.coalesce("records", F.lit(0)).cast("long").alias("records"))


#: what an error says when a file itself can't be read
FILE_ERROR = re.compile("FAILED_READ_FILE|FileNotFound|AccessControlException|AccessDenied|Permission denied|MALFORMED|Malformed|"
                        "not in gzip format|incorrect header check|unknown compression method|EOFException|ChecksumException", re.I)
#: and when the cluster failed: the run ends, its claim is released by the next one
CLUSTER_ERROR = re.compile("ExecutorLost|executor .* (lost|exited|decommission)|OutOfMemory|No space left|Disk quota|"
                           "FetchFailed|cancelled|SparkContext was shut down|Connection (refused|reset)|Timeout", re.I)


def is_file_error(error: Exception) -> bool:
    """Whether a failed read is the fault of its files, not of the cluster."""
    text = str(error)
    return bool(FILE_ERROR.search(text)) and not CLUSTER_ERROR.search(text)


def _collected(spark: SparkSession, by_fmt: dict[str, list[str]], fields: list[str],
               failed: dict[str, str]) -> list[DataFrame]:
    """The records of the files, read once and written (shared folder). Where
    a read fails, its files are read in halves until the unreadable ones stand
    alone; these go to ``failed`` with the reason."""
    paths = [(f, p) for f, ps in sorted(by_fmt.items()) for p in ps]
    if not paths:
        return []
    try:
        # outcomes and rows both read it, and a query on the corrupt marker
        # alone is not allowed on raw files
        return [written(read_records(spark, by_fmt, fields), "records")]
    except Exception as e:
        if not is_file_error(e):
            raise  # files stay PARSING and return to RECEIVED with the next run (K13)
        if len(paths) == 1:
            failed[paths[0][1]] = "UNREADABLE: " + str(e).strip().split("\n")[0][:300]
            return []
    out = []
    for half in (paths[:len(paths) // 2], paths[len(paths) // 2:]):
        part: dict[str, list[str]] = {}
        for f, p in half:
            part.setdefault(f, []).append(p)
        out += _collected(spark, part, fields, failed)
    return out


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _with_arrays(spark: SparkSession, rows: DataFrame, keys: dict[str, str], fields: list[str]) -> DataFrame:
    """Rows of JSON files that turn out to be one array over several lines
    (first line unreadable and starting with a bracket) are read anew."""
    arrays = [r[0] for r in rows.where((F.col("source_format") == "json") & (F.col("_pos") == 0)
                                       & F.ltrim(F.col(CORRUPT)).startswith("[")).select("file_path").collect()]
    if not arrays:  # one path per claimed file at most
        return rows
    again = written(read_records(spark, {"json": [keys[k] for k in arrays]}, fields, {"multiLine": "true"}), "records")
    return rows.where(~F.col("file_path").isin(arrays)).unionByName(with_positions(again))


def event_time(text, pattern: str | None = None) -> F.Column:
    """UTC wall time of a time text: a zone in the text counts, unreadable
    text gives null (a time without a date too: it would take today's)."""
    if pattern is not None:
        return F.try_to_timestamp(F.col(text), F.lit(pattern)).cast("timestamp_ntz")
    dated = F.when(F.col(text).rlike(r"^\s*[+-]?\d{4,}"), F.col(text))
    return dated.try_cast("timestamp").cast("timestamp_ntz")


@dataclass(frozen=True)
class Layout:
    """How the files of one source differ from the standard record: which of
    their columns holds which field, in the order of their CSV files, and how
    they write the time. Fields without a column are null."""

    pattern: str  # regular expression that the landing path contains
    columns: dict[str, str]  # field -> name in the files, in file order
    time_pattern: str | None = None  # Spark datetime pattern; None: as any readable time


def stage_batch(spark: SparkSession, batch: DataFrame, system: str, run_ts: dt.datetime, layouts: Sequence[Layout] = ()):
    """Read one claimed batch (file_id, source_system, landing_file_path).

    Returns (staging rows of the files that parsed, outcomes). The batch is
    at most one claim (100 files by default), so its path list is small. The
    first layout whose pattern fits a path holds for the file, else the
    standard one.
    """
    standard = Layout("", {c: c for c in KINDS[system]["fields"]})
    rest, rows, outcomes = F.lit(True), None, None
    for layout in [*layouts, standard]:
        fits = F.col("landing_file_path").rlike(layout.pattern) if layout.pattern else F.lit(True)
        own = batch.where(rest & fits)
        rest = rest & ~fits
        if own.isEmpty():
            continue
        more, said = _stage_files(spark, own, system, run_ts, layout)
        rows = more if rows is None else rows.unionByName(more)
        outcomes = said if outcomes is None else outcomes.unionByName(said)
    return rows, outcomes


def _stage_files(spark: SparkSession, batch: DataFrame, system: str, run_ts: dt.datetime, layout: Layout):
    """:func:`stage_batch` for files of one layout."""
    fields = list(layout.columns.values())
    time_col = KINDS[system]["time"]
    claimed = batch.select("landing_file_path", uri_key(F.col("landing_file_path"))).collect()
    keys = {k: p for p, k in claimed}
    failed: dict[str, str] = {}
    by_fmt: dict[str, list[str]] = {}
    for p in keys.values():
        if _exists(spark, p):
            by_fmt.setdefault(p.rsplit(".", 1)[-1].lower(), []).append(p)
        else:
            failed[p] = "MISSING: the file is no longer there"
    parts = _collected(spark, by_fmt, fields, failed) or [read_records(spark, {}, fields)]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    rows = _with_arrays(spark, with_positions(rows), keys, fields)
    strange = [r[0] for r in rows.select("file_path").distinct().collect() if r[0] not in keys]
    if strange:
        raise RuntimeError(f"rows of files that were not claimed: {strange[:3]}")
    outcomes = file_outcomes(rows, batch, fields)
    if failed:
        bad = spark.createDataFrame(list(failed.items()), "landing_file_path string, _why string")
        why = batch.join(F.broadcast(bad), "landing_file_path").select("file_id", "_why")
        outcomes = outcomes.join(F.broadcast(why), "file_id", "left").select(
            "file_id", (F.col("ok") & F.col("_why").isNull()).alias("ok"),
            F.coalesce("_why", "error_message").alias("error_message"), "records")
    good = outcomes.where("ok").select("file_id")
    ids = F.broadcast(batch.select("file_id", uri_key(F.col("landing_file_path")).alias("file_path")))
    data = (rows.where(~((F.col("source_format") == "csv") & (F.col("_pos") == 0)))
            .join(ids, "file_path").join(F.broadcast(good), "file_id", "left_semi")
            .withColumn("record_index",
                        F.when(F.col("source_format") == "csv", F.col("_pos") - 1).otherwise(F.col("_pos")).cast("int"))
            .select("file_id", "record_index",
                    *[F.col(layout.columns[c]).alias(c) if c in layout.columns else F.lit(None).cast("string").alias(c)
                      for c in KINDS[system]["fields"]])
            .withColumn("_time_text", F.col(time_col))
            .withColumn(time_col, event_time("_time_text", layout.time_pattern)))
    return finish_staging(data, system, run_ts), outcomes
