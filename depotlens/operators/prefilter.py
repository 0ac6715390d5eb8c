"""Rows whose key may be among given keys, found without moving the rows.

The keys' hashes are set as bits in bitmaps, which are broadcast; a row is kept
where the bit of its key is set. That keeps every row whose key is among the
keys and, with ``BITS_EACH`` bits per key, about one in 16 of the others, so an
exact join behind it shuffles little else than its matches. Let that be an inner
join with distinct keys: Spark moves a semi join in front of the filter. Its own runtime
filters need a filtered side and a scan of 10 GB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_EACH = 16
MOST_BITS = 1 << 28  # 32 MB of bitmaps


def may_match(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows of ``rows`` whose ``key`` is in ``keys``, and few others (rows
    without key go). ``keys`` is read twice. More keys than a quarter of
    ``MOST_BITS`` would set most bits: then all rows with a key are kept."""
    known, cols = keys.where(F.col(key).isNotNull()), rows.columns
    rows, n = rows.where(F.col(key).isNotNull()), known.count()
    if 4 * n > MOST_BITS:
        return rows
    bits = min(max(1 << (BITS_EACH * n).bit_length(), 1 << 15), MOST_BITS)
    at = F.pmod(F.xxhash64(key), F.lit(bits))
    block, place = F.bitmap_bucket_number(at).alias("_block"), F.bitmap_bit_position(at).alias("_bit")
    # dealt by block first: a task holds the bitmaps of its own blocks only
    bitmaps = (known.select(block, place).repartition("_block").groupBy("_block")
               .agg(F.bitmap_construct_agg("_bit").alias("_bits")))
    held = rows.withColumns({"_block": block, "_bit": place}).join(F.broadcast(bitmaps), "_block")
    return held.where(is_set("_bits", "_bit")).select(*cols)


def is_set(bits: str, bit: str) -> Column:
    """Whether the bit at a place of a bitmap column is set."""
    byte = F.conv(F.hex(F.substring(bits, (F.col(bit) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, (F.col(bit) % 8).cast("int")).bitwiseAND(F.lit(1)) == 1
