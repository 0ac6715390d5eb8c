"""Links among the members of a hub, found by their differences from its set.

Let D(x) be the tokens that x has and the hub lacks, or the other way round. At
a threshold of t per cent, x and y link exactly if the symmetric difference of
their sets holds at most (100 - t) / (100 + t) of the sum of their sizes. With
the margin of x, (100 - t) |x| - (100 + t) |D(x)|, that means: D(x) and D(y)
share at least -(margin of x + margin of y) / (2 (100 + t)) tokens. Two members
whose margins add up to 0 or more link in any case.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from depotlens.llm.common import written

BANDS = 16


def sure_links(apart: DataFrame) -> DataFrame:
    """(u, v): the member with the largest margin, and those that link with it
    by their margins alone. Any two that link so both link with that member.

    apart: (u hub, v member, margin, tokens)."""
    nearest = apart.groupBy("u").agg(F.max_by(F.struct("v", "margin"), F.struct("margin", "v")).alias("top"))
    return apart.join(nearest, "u").where(
        (F.col("margin") + F.col("top.margin") >= 0) & (F.col("v") != F.col("top.v"))).select(
        F.col("top.v").alias("u"), "v").distinct()


def difference_pairs(stars: DataFrame, apart: DataFrame, percent: int) -> DataFrame:
    """(u, v): nodes of a hub (stars: hub, node, component) in different
    components whose differences from the hub's set (apart: u hub, v node,
    margin, tokens) share a first token.

    Against a band of margins, a node needs only its first tokens, rare ones
    first, without as many as it would have to share. Links whose margins alone
    suffice (``sure_links``) are not found here."""
    held = stars.join(apart.select(F.col("u").alias("hub"), F.col("v").alias("node"), "margin", "tokens"), ["hub", "node"])
    width = held.groupBy("hub").agg(F.min("margin").alias("low"), F.greatest(
        F.lit(1), F.ceil((F.max("margin") - F.min("margin") + 1) / BANDS)).alias("width"))
    banded = held.join(width, "hub").withColumn("band", F.floor((F.col("margin") - F.col("low")) / F.col("width")))
    banded = written(banded, "difference-bands")
    tokens = banded.select("hub", "node", "component", "margin", "band", "low", "width", F.explode("tokens").alias("token"))
    freq = tokens.groupBy("hub", "token").agg(F.count("*").alias("freq")).where("freq > 1")
    shared = tokens.join(freq, ["hub", "token"])
    place = Window.partitionBy("hub", "node").orderBy("freq", F.xxhash64("token"), "token")
    ranked = shared.withColumn("rank", F.row_number().over(place)).withColumn(
        "size", F.count("*").over(Window.partitionBy("hub", "node")))
    bands = banded.groupBy("hub").agg(F.collect_set("band").alias("bands"))  # at most BANDS
    asked = ranked.join(bands, "hub").withColumn("other", F.explode("bands"))
    top = F.col("margin") + F.col("low") + (F.col("other") + 1) * F.col("width") - 1
    least = F.greatest(F.lit(1), F.ceil(-top / (2.0 * (100 + percent))))
    keys = asked.where(F.col("rank") <= F.col("size") - least + 1).select(
        "hub", F.least("band", "other").alias("x"), F.greatest("band", "other").alias("y"), "token", "node", "component", "band")
    name = ["hub", "x", "y", "token"]
    mixed = keys.groupBy(*name).agg(
        F.min("component").alias("a"), F.max("component").alias("b")).where("a < b").select(*name)
    keys = written(keys.join(mixed, name, "left_semi"), "difference-keys")
    one, two = (keys.select(*name, *[F.col(c).alias(f"{c}_{k}") for c in ("node", "component", "band")]) for k in "uv")
    # bands x < y: one of each; x = y: both of it, each pair once
    apart_ = (F.col("component_u") != F.col("component_v")) & (F.col("band_u") == F.col("x")) & (F.col("band_v") == F.col("y"))
    once = (F.col("x") < F.col("y")) | (F.col("node_u") < F.col("node_v"))
    met = one.where("band_u = x").join(two.where("band_v = y"), name).where(apart_ & once)
    return met.select(F.least("node_u", "node_v").alias("u"), F.greatest("node_u", "node_v").alias("v")).distinct()


