"""Consecutive id allocation without a single-task window.

``row_number()`` over a global order runs in one task. Here the rows are
range-partitioned on the order, numbered inside each partition from
``monotonically_increasing_id`` (partition index in the high bits, position in
the low bits) and shifted by the row counts of the earlier partitions (one
row per partition, so that table is small by construction).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from depotlens.session import small, written

_LOW_BITS = (1 << 33) - 1
PLACES = 1 << 12  # places of a block (a power of two)


def max_value(df: DataFrame, col: str, default: int = 0) -> int:
    """Largest value of an id column (one scalar to the driver)."""
    v = df.select(F.max(col)).first()[0]
    return default if v is None else int(v)


def assign_ids(df: DataFrame, order_cols: list, id_col: str, start: int = 0,
               num_partitions: int | None = None, finish: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Add ``id_col`` = start + 1, start + 2, ... following ``order_cols``.

    ``order_cols`` should order the rows totally, else ties get ids in an
    arbitrary (but consistent) order. The range-partitioned rows are
    written once (shared folder) so that the count branch, which reads one
    column, and the numbering branch see the same partition bounds, also when
    an executor is lost. Without ``num_partitions`` adaptive execution sizes
    the partitions: few rows become one. ``finish`` is a projection of the rows
    between their move and the write: columns that only order them are left
    out, long ones derived from others are made after the move.
    """
    orders = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    dealt = df.repartitionByRange(num_partitions, *orders) if num_partitions else df.repartitionByRange(*orders)
    ranged = dealt.sortWithinPartitions(*orders)
    ranged = ranged if finish is None else finish(ranged)
    ranged = written(ranged.withColumn("_m", F.monotonically_increasing_id()), "ranged")
    ranged = (ranged.withColumn("_pid", F.shiftright("_m", 33))
              .withColumn("_pos", F.col("_m").bitwiseAND(F.lit(_LOW_BITS))))
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    # one row per partition: the broadcast is bounded by num_partitions
    out = ranged.join(F.broadcast(offsets), "_pid")
    return (out.withColumn(id_col, (F.lit(start) + F.col("_off") + F.col("_pos") + 1).cast("long"))
            .drop("_m", "_pid", "_pos", "_off"))


def ids_by_place(df: DataFrame, group: str, place: str, id_col: str, start: int = 0) -> DataFrame:
    """Add ``id_col`` = start + 1, start + 2, ... in (``group``, ``place``)
    order, where places are whole numbers (neither is null), without moving
    the rows.

    Places are counted in blocks of ``PLACES``. Where a block's places are one
    gapless run, a row's rank is its place less the first one; of the other
    blocks the places are listed. Rows are joined with their block (few and
    small, so they are broadcast; else the rows move as in ``assign_ids``).
    ``df`` is read twice. Rows that share a place are numbered by
    ``assign_ids``."""
    key = [group, "_block"]
    at = F.col(place).cast("long")
    rows = df.withColumn("_block", F.shiftright(at, PLACES.bit_length() - 1))
    spans = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), F.min(at).alias("_lo"), F.max(at).alias("_hi"),
                                   F.bit_xor(F.xxhash64(at)).alias("_x"))
    run = F.aggregate(F.sequence("_lo", "_hi"), F.lit(0).cast("long"), lambda x, p: x.bitwiseXOR(F.xxhash64(p)))
    # as many places as the run has, and the same ones: none is missing, none is there twice
    gapless = F.when(F.col("_n") == F.col("_hi") - F.col("_lo") + 1, F.col("_x") == run).otherwise(F.lit(False))
    spans = written(spans.withColumn("_gapless", gapless), "spans")
    broken = small(spans.where(~F.col("_gapless")).select(*key), 64)
    listed = written(rows.join(broken, key, "left_semi").groupBy(*key)
                     .agg(F.sort_array(F.collect_list(at)).alias("_places")), "places")
    if not listed.where(F.size("_places") > F.size(F.array_distinct("_places"))).isEmpty():
        return assign_ids(df, [group, place], id_col, start=start)
    before = Window.orderBy(group).rowsBetween(Window.unboundedPreceding, -1)  # one row per group
    groups = spans.groupBy(group).agg(F.sum("_n").alias("_held")).select(
        group, F.coalesce(F.sum("_held").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy(group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("_off", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(groups, group).join(listed, key, "left")
    spans = written(spans.select(*key, (F.col("_first") + F.col("_off")).alias("_off"), "_lo", "_places"), "blocks")
    rank = F.when(F.col("_places").isNull(), at - F.col("_lo") + 1).otherwise(F.array_position("_places", at))
    spans = small(spans, 80 + 8 * F.coalesce(F.size("_places"), F.lit(0)))
    return (rows.join(spans, key).withColumn(id_col, (F.lit(start) + F.col("_off") + rank).cast("long"))
            .drop("_block", "_off", "_lo", "_places"))


def lit_ts(value) -> Column:
    """A TIMESTAMP_NTZ literal from a python datetime."""
    text = value.isoformat(sep=" ") if hasattr(value, "isoformat") else str(value)
    return F.lit(text).cast("timestamp_ntz")
