"""Operator 2: sharding along a Hilbert curve.

Every metadata dimension is quantised to ``bits`` bits in the order of its
values (categories by the rank of the value among the sorted distinct ones,
sizes by logarithm), the cells are ordered by their index on a Hilbert curve, and the ordered rows are cut into runs of
equal counts (law ``rows``): rows of one shard are close in all dimensions, so
readers can skip shards by the minimum and maximum of any of them.

The order is total in (curve index, doc_id, checksum): rows are range
partitioned and sorted on it, numbered inside each partition, and shifted by
the counts of the earlier partitions (a table of one row per partition). Only
ids and sizes are shuffled, never texts; a crowded cell is split by doc_id.

* null text: size 8, checksum of no bytes; null dimension: cell 0; null
  doc_id: sorts first; a very long text only counts by its size.
* ties and repeated rows: each row has its own place; equal rows may swap.
* an empty table gives no rows; extra columns are not carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from depotlens.llm.common import written

SHARDS = 24
BITS = 5


def _rotl(x: int, k: int, n: int) -> int:
    k %= n
    return ((x << k) | (x >> (n - k))) & ((1 << n) - 1)


def curve_tables(n: int) -> tuple[list[int], list[int]]:
    """State machine of the n-dimensional Hilbert curve: for state * 2^n +
    cell corner, the digit of the index and the next state."""
    size = 1 << n
    gray = [i ^ (i >> 1) for i in range(size)]
    position = {g: i for i, g in enumerate(gray)}

    def entry(w: int) -> int:
        return 0 if w == 0 else gray[2 * ((w - 1) // 2)]

    def axis(w: int) -> int:
        if w == 0:
            return 0
        v = w if w % 2 else w - 1
        return ((v ^ (v + 1)).bit_length() - 1) % n

    digits, following = [], []
    for e in range(size):
        for d in range(n):
            for corner in range(size):
                w = position[_rotl(corner ^ e, n - (d + 1), n)]
                digits.append(w)
                e2 = e ^ _rotl(entry(w), d + 1, n)
                d2 = (d + axis(w) + 1) % n
                following.append(e2 * n + d2)
    return digits, following


def hilbert_index(cells: list[Column], bits: int = BITS) -> Column:
    """Index on the curve of a cell given by one integer column per dimension."""
    n = len(cells)
    digits, following = (F.array(*[F.lit(v) for v in t]) for t in curve_tables(n))
    start = F.struct(F.lit(0).alias("state"), F.lit(0).cast("long").alias("index"))

    def step(acc, c):
        at = acc["state"] * (1 << n) + c
        return F.struct(following[at].alias("state"), (acc["index"] * (1 << n) + digits[at]).alias("index"))

    corners = []
    for b in range(bits - 1, -1, -1):
        corner = F.lit(0)
        for i, c in enumerate(cells):
            corner = corner + F.shiftright(c, b).bitwiseAND(F.lit(1)) * (1 << i)
        corners.append(corner)
    return F.aggregate(F.array(*corners), start, step)["index"]


def _numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """rows with _rank (from 0, by order) and _total, without a global window."""
    # written once: the numbers below must not be computed a second time
    numbered = written(
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id()), name)
    part = F.shiftrightunsigned(F.col("_at"), 33)
    numbered = numbered.withColumn("_part", part)
    counts = numbered.groupBy("_part").agg(F.count("*").alias("_n"))  # one row per partition
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    offsets = counts.select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(everything).alias("_total"))
    rank = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return numbered.join(F.broadcast(offsets), "_part").withColumn("_rank", rank)


def category_cell(df: DataFrame, column: str, bits: int = BITS) -> Column:
    """Cell of a category by the rank of its value among the sorted distinct
    values: equal values share a cell, cells follow the order of the values, and
    up to 2^bits values have cells of their own. Only the first value of each
    cell (at most 2^bits) comes to the driver."""
    values = df.where(F.col(column).isNotNull()).select(F.col(column).alias("_value")).distinct()
    cell = F.expr(f"_rank * {1 << bits} div _total").cast("int")
    cuts = (_numbered(values, ["_value"], "category-order").groupBy(cell.alias("cell"))
            .agg(F.min("_value").alias("first")).orderBy("cell").collect())
    found = F.lit(0)
    for c in cuts:
        found = F.when(F.col(column) >= F.lit(c["first"]), F.lit(c["cell"])).otherwise(found)
    return found


def size_cell(c: Column, bits: int = BITS) -> Column:
    """Logarithmic steps, two per doubling; the last cell is open."""
    return F.coalesce(
        F.least(F.floor(F.log2(F.greatest(c, F.lit(0)) + 1.0) * 2), F.lit((1 << bits) - 1)).cast("int"), F.lit(0))


def document_cells(df: DataFrame) -> list[Column]:
    return [category_cell(df, "lang"), category_cell(df, "source"), size_cell(F.col("n_chars"))]


def place_documents(df: DataFrame, cells: list[Column] | None = None, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, hilbert) per row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = df.select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        hilbert_index(cells or document_cells(df)).alias("hilbert"))
    placed = _numbered(rows, ["hilbert", "doc_id", "text_crc32", "size"], "shard-order")
    placed = placed.withColumn("shard", F.expr(f"_rank * {shards} div _total").cast("int"))
    first = F.expr(f"(shard * _total + {shards - 1}) div {shards}")
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("_rank") - first).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "hilbert")


def write_shards(df: DataFrame, path: str, cells: list[Column] | None = None, shards: int = SHARDS) -> None:
    """The documents as one folder per shard, sorted by slot (doc_id unique)."""
    placed = place_documents(df, cells, shards).select("doc_id", "shard", "slot")
    (df.drop("shard", "slot").join(placed, "doc_id").repartitionByRange("shard", "slot")
     .sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path))
