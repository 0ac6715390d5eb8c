"""Landing folder: listing (L1 input) and a writer for landing files.

Layout (L11): ``<root>/<source_system>/ingest_dt=YYYY-MM-DD/<file>``; the
file extension (csv, json, xml) names the format. ``ingest_dt`` is found by
partition discovery, so it can prune.

The writer is the test fixture's stand-in for the file server: it turns
records into CSV (header line + ``to_csv``), JSON Lines (``to_json``) and
XML (``to_xml`` rows inside one root element) text, written by the text
sink, one file per (ingest_dt, format, part), and then gives each part file
its file name.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from depotlens.schemas import FILE_LISTING
from depotlens.session import new_scratch_path, written

TIME_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
ROW_TAG, ROOT_TAG = "record", "records"
FORMATS = ("csv", "json", "xml")
FILES_PER_DAY = 2  # per format, in the fixture
# RFC 4180 quoting (a quote inside a field is doubled); spaces are data.
CSV_OPTIONS = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false",
               "ignoreTrailingWhiteSpace": "false"}


def list_landing(spark: SparkSession, root: str, system: str) -> DataFrame:
    """File listing of one source system (L1 input), from file-system
    metadata: one ``ingest_dt=`` folder per arrival day, all days, so a file
    that arrives late in an old folder is found. Zero-byte files are listed too (a data source
    listing would skip them, but they must be registered and PARSED with no
    rows). Only metadata is read, never file content."""
    base = f"{root.rstrip('/')}/{system}"
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(conf)
    rows = []
    if fs.exists(path):
        for day in fs.listStatus(path):
            name = day.getPath().getName()
            if not day.isDirectory() or not name.startswith("ingest_dt="):
                continue
            for st in fs.listStatus(day.getPath()):
                fname = st.getPath().getName()
                ext = fname.rsplit(".", 1)[-1].lower() if "." in fname else ""
                if not st.isFile() or fname.startswith((".", "_")) or ext not in FORMATS:
                    continue
                rows.append((system, f"{system}/{name}/{fname}",
                             dt.datetime.fromtimestamp(st.getModificationTime() / 1000.0, dt.timezone.utc)
                             .replace(tzinfo=None),
                             int(st.getLen()), st.getPath().toString()))
    return spark.createDataFrame(rows, FILE_LISTING)


def _record_text(fields: list[str], time_col: str) -> dict[str, F.Column]:
    vals = [F.date_format(time_col, TIME_TEXT).alias(time_col) if c == time_col else F.col(c) for c in fields]
    rec = F.struct(*vals)
    return {
        "csv": F.to_csv(rec, CSV_OPTIONS),
        "json": F.to_json(rec),
        "xml": F.to_xml(rec, {"rowTag": ROW_TAG}),
    }


def write_landing(records: DataFrame, root: str, system: str, fields: list[str], time_col: str,
                  order_cols: list[str], part: Column, damage_day=None, derived: dict[str, Column] | None = None) -> str:
    """Write ``records`` (with ingest_dt, source_format) as landing files, one
    per (ingest_dt, source_format, part), where ``part`` is 0 to
    ``FILES_PER_DAY`` - 1 by a rule over the record.

    A file's records move to one task as they are, are sorted there (the sort
    spills where memory is short) and become lines, which are written one by
    one: no row or task holds a file's text. A file's first and last line are
    rows of their own. ``derived``: the record columns that are made of the
    others, after the move.

    ``damage_day``: for that ingest day one more file per format is written,
    part ``FILES_PER_DAY``, which holds a broken copy of one record (CSV: one
    field too many; JSON: missing closing brace; XML: unclosed element), so
    the whole file must become FAILED.
    """
    spark, derived = records.sparkSession, derived or {}
    texts = _record_text(fields, time_col)
    line = (F.when(F.col("source_format") == "csv", texts["csv"])
            .when(F.col("source_format") == "json", texts["json"]).otherwise(texts["xml"]))
    file = ["ingest_dt", "source_format", "part"]
    after = {name: c for name, c in derived.items() if name not in file}
    order = [after.get(c, F.col(c)) for c in order_cols]
    rest = [c for c in records.columns if c not in (*file, *order_cols)]
    records = (records.withColumns({**{name: c for name, c in derived.items() if name in file}, "part": part.cast("int")})
               .dropna(subset=file))  # others have no file
    files = written(records.select(*file).distinct(), "landing-files")
    # ready texts: of one file they stand before its records (_at -1), among them or behind them (1)
    ready = spark.createDataFrame([], "ingest_dt date, source_format string, part int, _at int, _text string")
    if damage_day is not None:
        first = (records.where(F.col("ingest_dt") == F.lit(damage_day)).withColumns(after)
                 .groupBy(*file).agg(F.min(F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(order_cols)], line.alias("value")))["value"].alias("value"))
                 .groupBy("ingest_dt", "source_format").agg(F.min("value").alias("value")))
        broken = (F.when(F.col("source_format") == "csv", F.concat("value", F.lit(",EXTRA")))
                  .when(F.col("source_format") == "json", F.expr("substring(value, 1, length(value) - 1)"))
                  .otherwise(F.regexp_replace("value", "</" + ROW_TAG + ">", "")))
        ready = written(first.select("ingest_dt", "source_format", F.lit(FILES_PER_DAY).alias("part"),
                                     F.lit(0).alias("_at"), broken.alias("_text")), "landing-damage")
        files = files.unionByName(ready.select(*file))
    head = F.when(F.col("source_format") == "csv", F.lit(",".join(fields))).when(F.col("source_format") == "xml", F.lit(f"<{ROOT_TAG}>"))
    tail = F.when(F.col("source_format") == "xml", F.lit(f"</{ROOT_TAG}>"))
    for at, text in ((-1, head), (1, tail)):
        ready = ready.unionByName(files.select(*file, F.lit(at).alias("_at"), text.alias("_text")).where("_text IS NOT NULL"))
    rows = records.withColumn("_at", F.lit(0)).unionByName(ready, allowMissingColumns=True)
    # Never null: else the sink turns empty strings to null and sorts anew, by
    # the file alone, which could reorder lines.
    rows = rows.withColumn("source_format", F.coalesce("source_format", F.lit("")))
    lines = (rows.repartition(*file).sortWithinPartitions(*file, "_at", *order, *rest)
             .withColumns(after).select(*file, F.coalesce("_text", line).alias("value")))
    tmp = new_scratch_path(spark, "landing-tmp")
    lines.write.partitionBy(*file).text(tmp)
    _name_files(spark, tmp, f"{root.rstrip('/')}/{system}", system)
    return f"{root.rstrip('/')}/{system}"


def _name_files(spark: SparkSession, tmp: str, dest: str, system: str) -> None:
    """Move each written part file to ``ingest_dt=<d>/<system>_<yyyymmdd>_<part>.<fmt>``
    (file-system metadata calls, one per file); names of odd parts also hold
    characters that paths and URIs write differently."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    Path = jvm.org.apache.hadoop.fs.Path
    fs = Path(tmp).getFileSystem(conf)
    for st in fs.globStatus(Path(tmp + "/ingest_dt=*/source_format=*/part=*/part-*")) or []:
        p = st.getPath()
        part = int(p.getParent().getName().split("=", 1)[1])
        fmt = p.getParent().getParent().getName().split("=", 1)[1]
        day = p.getParent().getParent().getParent().getName().split("=", 1)[1]
        suffix = f"_{part} [%20]" if part % 2 else f"_{part}"
        target = Path(f"{dest}/ingest_dt={day}/{system}_{day.replace('-', '')}{suffix}.{fmt}")
        fs.mkdirs(target.getParent())
        fs.rename(p, target)
