"""Versioned parquet store in the shared folder.

Parquet has no UPDATE/MERGE, so every state table (ledger, station history,
snapshot, monitoring) is written as a new immutable version folder
``<root>/<name>/v000001`` and read back from there; facts, links and
staging are append-only (``<root>/<name>/data``). Reading a written version
also cuts the lineage of a multi-day run, so a lost executor only recomputes
from the last written table.

The station history is of a third kind: a version holds the current rows only,
rows that a run closes are added once below ``<name>/closed/apply=N``, where N
is the version that they belong to (parts of unpublished versions are not
read). A bucketed table (``<name>/b<n>``) is read by joins on its column
without a shuffle.

Old versions and folders of append-only tables go by ``retire_versions`` and
``retire_partitions`` only. Both remove nothing that the latest state reads,
and may be stopped at any point: the next call goes on.

Nothing lives only in the driver: a version counts once its ``_SUCCESS``
marker exists (the commit protocol writes it last), and each table's schema
is kept next to it, so a new driver on the same root finds the latest state.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depotlens.session import COMPRESSION, new_scratch_path

FILES_EACH = 4
_VERSION = re.compile(r"^v(\d{6,})$")


def _time(status) -> dt.datetime:
    """The time (UTC) of a file or folder."""
    return dt.datetime.fromtimestamp(status.getModificationTime() / 1000.0, dt.timezone.utc).replace(tzinfo=None)


def lie_by(df: DataFrame, column: str) -> bool:
    """Whether the rows, as their tasks read them, make few files when they
    are written by ``column``: ``FILES_EACH`` per task and value at most.
    Reads what the column needs, so for rows that cost little to read twice."""
    pairs = df.select(F.spark_partition_id().alias("_task"), F.col(column).alias("_value")).distinct()
    n, tasks, values = pairs.agg(F.count(F.lit(1)), F.countDistinct("_task"), F.countDistinct("_value")).first()
    return n <= FILES_EACH * (tasks + values)


class Store:
    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = (root or new_scratch_path(spark, "store")).rstrip("/")
        jvm = spark.sparkContext._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # ------------------------------------------------------------ metadata
    def _p(self, path: str):
        return self._Path(path)

    def latest(self, name: str) -> int:
        base = self._p(f"{self.root}/{name}")
        if not self._fs.exists(base):
            return 0
        return max(self._published(name), default=0)

    def _published(self, name: str) -> dict[int, dt.datetime]:
        """The published versions of a table, with the time of their marker."""
        found = {}
        for st in self._fs.listStatus(self._p(f"{self.root}/{name}")):
            m, marker = _VERSION.match(st.getPath().getName()), self._p(f"{st.getPath().toString()}/_SUCCESS")
            if m and self._fs.exists(marker):
                found[int(m.group(1))] = _time(self._fs.getFileStatus(marker))
        return found

    def _save_schema(self, name: str, schema: T.StructType) -> None:
        out = self._fs.create(self._p(f"{self.root}/{name}/_schema.json"), True)
        out.write(bytearray(schema.json().encode("utf-8")))
        out.close()

    def _schema(self, name: str) -> T.StructType | None:
        p = self._p(f"{self.root}/{name}/_schema.json")
        if not self._fs.exists(p):
            return None
        stream = self._fs.open(p)
        reader = self.spark.sparkContext._jvm.java.io.BufferedReader(
            self.spark.sparkContext._jvm.java.io.InputStreamReader(stream, "UTF-8"))
        text = reader.readLine()
        reader.close()
        return T.StructType.fromJson(__import__("json").loads(text))

    def _is_append(self, name: str) -> bool:
        return self._fs.exists(self._p(f"{self.root}/{name}/data/_SUCCESS"))

    # --------------------------------------------------------------- tables
    def path(self, name: str, version: int | None = None) -> str:
        v = self.latest(name) if version is None else version
        return f"{self.root}/{name}/v{v:06d}"

    def has(self, name: str) -> bool:
        return self._is_append(name) or self.latest(name) > 0

    def union(self, name: str, schema: T.StructType) -> DataFrame | None:
        """The latest versions of all tables below ``name`` as one scan."""
        base = self._p(f"{self.root}/{name}")
        if not self._fs.exists(base):
            return None
        parts = [f"{name}/{s.getPath().getName()}" for s in self._fs.listStatus(base) if s.isDirectory()]
        paths = [self.path(p) for p in parts if self.latest(p)]
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{name}").parquet(*paths) if paths else None

    def put(self, name: str, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        """Write ``df`` as the next version of ``name`` and return it read back."""
        v = self.latest(name) + 1
        w = df.write.mode("overwrite").option("compression", COMPRESSION)  # only what a stopped run left of an unpublished version
        if partition_by:
            w = w.partitionBy(*partition_by)
        self._save_schema(name, df.schema)
        w.parquet(self.path(name, v))
        return self.get(name)

    def put_history(self, name: str, current: DataFrame, closed: DataFrame) -> DataFrame:
        """The next version of a history: its current rows, and the rows closed
        since the last version, which are written once and never again."""
        part = f"{self.root}/{name}/closed/apply={self.latest(name) + 1:06d}"
        closed.select(*current.columns).write.mode("overwrite").option("compression", COMPRESSION).parquet(part)
        return self.put(name, current)  # published with the version

    def version(self, name: str) -> DataFrame:
        """The latest version alone, without closed rows."""
        return self._read(name)

    def get(self, name: str) -> DataFrame:
        rows = self._read(name)
        if not self._fs.exists(self._p(f"{self.root}/{name}/closed")):
            return rows
        closed = (self.spark.read.schema(T.StructType([*rows.schema.fields, T.StructField("apply", T.IntegerType())]))
                  .parquet(f"{self.root}/{name}/closed").where(F.col("apply") <= self.latest(name)).drop("apply"))
        # a constant, so that a filter on current rows leaves these files out
        return rows.unionByName(closed.withColumn("is_current", F.lit(False)))

    def _read(self, name: str) -> DataFrame:
        schema = self._schema(name)
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        if self._is_append(name):
            df = reader.parquet(f"{self.root}/{name}/data")
        else:
            df = reader.parquet(self.path(name))
        # partition columns come back last; restore the written order
        return df if schema is None else df.select(*schema.fieldNames())

    def append(self, name: str, df: DataFrame, partition_by: list[str] | None = None,
               sort_by: list[str] | None = None, deal: bool = True) -> DataFrame:
        """Append-only table (facts, links, staging): new files under one folder.

        The rows added are dealt by partition in tasks of about the advisory
        size (a large partition is split, small ones share a task), so that
        one call adds a file per partition or files of that size, not a file
        per task and partition. They are sorted inside each task by
        (partition, ``sort_by``): each file's statistics cover a narrow time
        range, so time filters skip row groups. ``deal=False``: the rows lie
        by partition already (``lie_by``) and are written where they are."""
        path = f"{self.root}/{name}/data"
        order = list(partition_by or []) + list(sort_by or [])
        if partition_by and deal:
            df = df.hint("rebalance", *partition_by)
        if order:
            df = df.sortWithinPartitions(*order)
        w = df.write.mode("append").option("compression", COMPRESSION)
        if partition_by:
            w = w.partitionBy(*partition_by)
        self._save_schema(name, df.schema)
        w.parquet(path)
        return self.get(name)

    def partitions(self, name: str, column: str) -> list[str]:
        """Values of an append-only table's first partition column, from its folders."""
        base = self._p(f"{self.root}/{name}/data")
        names = [st.getPath().getName() for st in self._fs.listStatus(base)] if self._is_append(name) else []
        return [n.removeprefix(f"{column}=") for n in names if n.startswith(f"{column}=")]

    # ------------------------------------------------------------ retention
    def versioned(self) -> list[str]:
        """Names of all tables with versions, one folder deep included (such
        as a table per day)."""
        found = []
        for st in self._folders(self.root):
            inner = self._folders(f"{self.root}/{st}")
            if any(_VERSION.match(n) for n in inner):
                found.append(st)
            else:
                found += [f"{st}/{n}" for n in inner if any(_VERSION.match(v) for v in self._folders(f"{self.root}/{st}/{n}"))]
        return sorted(found)

    def _folders(self, path: str) -> list[str]:
        base = self._p(path)
        return [s.getPath().getName() for s in self._fs.listStatus(base) if s.isDirectory()] if self._fs.exists(base) else []

    def retire_versions(self, name: str, before: dt.datetime, keep: int = 2) -> list[int]:
        """Removes the versions of ``name`` whose next version was published
        before ``before``, except the newest ``keep`` (one at least), and
        what stopped calls left of older ones. A reader of a version that is
        not the latest has time until then."""
        published = self._published(name) if self._fs.exists(self._p(f"{self.root}/{name}")) else {}
        kept = sorted(published)[-max(keep, 1):]
        there = sorted(int(m.group(1)) for n in self._folders(f"{self.root}/{name}") if (m := _VERSION.match(n)))
        gone = []
        for v in there:
            later = [n for n in published if n > v]  # none: the latest, or one that is being written
            if v not in kept and later and published[min(later)] < before:
                self._remove(self.path(name, v))
                gone.append(v)
        return gone

    def retire_partitions(self, name: str, column: str, values: set, before: dt.datetime) -> list[str]:
        """Removes the folders of these values of an append-only table's first
        partition column, where they were written before ``before``. A folder
        first moves out of the table, so none is read by half."""
        aside, gone = f"{self.root}/{name}/retired", []
        for n in self._folders(aside):  # left by a stopped call
            self._remove(f"{aside}/{n}")
        for value in sorted({str(v) for v in values} & set(self.partitions(name, column))):
            n = f"{column}={value}"
            folder = self._p(f"{self.root}/{name}/data/{n}")
            if _time(self._fs.getFileStatus(folder)) < before:
                self._fs.mkdirs(self._p(aside))
                if not self._fs.rename(folder, self._p(f"{aside}/{n}")):
                    raise OSError(f"could not retire {folder.toString()}")
                self._remove(f"{aside}/{n}")
                gone.append(value)
        return gone

    def _remove(self, path: str) -> None:
        self._fs.delete(self._p(path), True)

    # ------------------------------------------------------ bucketed tables
    def _bucketed(self, name: str, schema: T.StructType, column: str, buckets: int) -> str:
        """Catalog name of the bucketed files of ``name``; files that exist
        decide the number of buckets. The catalog entry is made anew by each
        driver, the files are the state."""
        base = self._p(f"{self.root}/{name}")
        found = [st.getPath().getName() for st in self._fs.listStatus(base)] if self._fs.exists(base) else []
        kept = [int(n[1:]) for n in found if re.match(r"^b\d+$", n)]
        buckets = kept[0] if kept else buckets
        path = f"{self.root}/{name}/b{buckets}"
        table = "depotlens_" + hashlib.md5(path.encode()).hexdigest()
        if not self.spark.catalog.tableExists(table):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            where = path.replace("\\", "\\\\").replace("'", "\\'")
            self.spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet OPTIONS (compression '{COMPRESSION}') CLUSTERED BY (`{column}`) INTO {buckets} BUCKETS LOCATION '{where}'")
        return table

    def bucketed(self, name: str, column: str) -> DataFrame:
        return self.spark.table(self._bucketed(name, self._schema(name), column, 0))

    def append_bucketed(self, name: str, df: DataFrame, column: str, buckets: int) -> DataFrame:
        """Adds rows, one file per bucket and call."""
        table = self._bucketed(name, df.schema, column, buckets)
        self._save_schema(name, df.schema)
        n = int(next(r[1] for r in self.spark.sql(f"DESCRIBE EXTENDED {table}").collect() if r[0] == "Num Buckets"))
        df.repartition(n, column).write.insertInto(table)
        return self.spark.table(table)
