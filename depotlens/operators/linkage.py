"""Probabilistic station matching (S6): record linkage with learned weights.

Two station lists (identifier, name, zip_code, street) are compared field by
field; each comparison has a level:

* name, street: 2 equal after normalisation, 1 equal in a rough form (name
  without vowels and doubled letters; the street's number), 0 different;
* zip, number (digits at the end of the identifier): 2 equal, 0 different;
* null where either side lacks the field (weight 0).

A level's weight is log2(m / u): m is its probability among pairs that match,
u among all other pairs. u is exact, from the frequencies of the field's
values on both sides (no pair is made for it). m is learned by expectation
maximisation, once per blocking (number, rough name, zip with the street's
number): only the counts of level patterns leave Spark (at most 4^4 rows). A
blocking says nothing about its own fields, so each field's m comes from the
other blockings, weighted by the matches that these expect.

Candidates are the union of the blockings as equi joins over distinct field
patterns: rows that agree in all fields cost one row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELDS = ("name", "zip", "street", "number")
ROUGH = ("name", "street")  # fields with a rough form
#: blocking -> the key columns that both sides must share
BLOCKINGS = {"number": ["number"], "name": ["name_rough"], "zip": ["zip", "street_rough"]}
USES = {"number": ["number"], "name": ["name"], "zip": ["zip", "street"]}
LEAST_M = 1e-4
ROUNDS = 50

Weights = dict[str, dict[int, float]]


def comparable(stations: DataFrame, identifier: str) -> DataFrame:
    """(identifier, and the compared forms of its fields); blank is null."""
    def blank(c: Column) -> Column:
        return F.when(c != "", c)

    plain = F.regexp_replace(F.upper("name"), "[^A-Z0-9]", "")
    rough = F.regexp_replace(F.regexp_replace(plain, "(?<=.)[AEIOU]", ""), r"([A-Z])\1+", "$1")
    return stations.select(
        F.col(identifier).alias("identifier"), blank(plain).alias("name"), blank(rough).alias("name_rough"),
        blank(F.trim("zip_code")).alias("zip"), blank(F.regexp_replace(F.upper("street"), "[^A-Z0-9]", "")).alias("street"),
        blank(F.regexp_extract("street", "([0-9]+)", 1)).alias("street_rough"),
        F.regexp_extract(F.col(identifier), "([0-9]+)$", 1).try_cast("bigint").cast("string").alias("number"))


FORMS = ["name", "name_rough", "zip", "street", "street_rough", "number"]


def _patterns(df: DataFrame, side: str) -> DataFrame:
    """Distinct field patterns with the smallest identifier and the number of rows."""
    return df.groupBy(*FORMS).agg(F.min("identifier").alias("identifier"), F.count("*").alias("rows")).select(
        *[F.col(c).alias(f"{c}_{side}") for c in [*FORMS, "identifier", "rows"]])


def _level(field: str) -> Column:
    one, two = F.col(f"{field}_l"), F.col(f"{field}_r")
    out = F.when(one.isNull() | two.isNull(), F.lit(None).cast("int")).when(one == two, 2)
    if field in ROUGH:
        out = out.when(F.col(f"{field}_rough_l") == F.col(f"{field}_rough_r"), 1)
    return out.otherwise(0).alias(f"{field}_level")


def _block(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    one, two = left, right
    for k in keys:
        one, two = one.where(F.col(f"{k}_l").isNotNull()), two.where(F.col(f"{k}_r").isNotNull())
    condition = [F.col(f"{k}_l") == F.col(f"{k}_r") for k in keys]
    return one.join(two, condition)


def candidates(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs of patterns (identifier_l, identifier_r, levels) that share a blocking."""
    one, two = _patterns(left, "l"), _patterns(right, "r")
    pairs = None
    for keys in BLOCKINGS.values():
        p = _block(one, two, keys).select(
            "identifier_l", "identifier_r", "rows_l", "rows_r", *[_level(f) for f in FIELDS])
        pairs = p if pairs is None else pairs.unionByName(p)
    return pairs.distinct()


def chance_levels(left: DataFrame, right: DataFrame) -> dict[str, dict[int, float]]:
    """u: how often two rows taken at random agree, exactly, from the values'
    frequencies (one row per field)."""
    out: dict[str, dict[int, float]] = {}
    for field in FIELDS:
        def share(form: str) -> float:
            a = left.where(F.col(form).isNotNull()).groupBy(form).agg(F.count("*").alias("a"))
            b = right.where(F.col(form).isNotNull()).groupBy(form).agg(F.count("*").alias("b"))
            both = a.join(b, form).agg(F.sum(F.col("a") * F.col("b"))).first()[0] or 0
            n, m = a.agg(F.sum("a")).first()[0] or 0, b.agg(F.sum("b")).first()[0] or 0
            return both / (n * m) if n and m else 0.0

        equal = share(field)
        rough = max(0.0, share(f"{field}_rough") - equal) if field in ROUGH else 0.0
        out[field] = {2: equal, 1: rough, 0: max(0.0, 1 - equal - rough)}
    return out


def learned_levels(counts: list[tuple], fields: list[str], u: dict, rounds: int = ROUNDS) -> tuple[dict, float]:
    """(m by field and level, expected matches) of the level patterns
    (levels of ``fields``..., rows) by expectation maximisation with u given."""
    m = {f: {2: 0.8, 1: 0.15, 0: 0.05} if f in ROUGH else {2: 0.9, 1: 0.0, 0: 0.1} for f in fields}
    total = sum(c[-1] for c in counts)
    share, expected = 0.5, 0.0
    for _ in range(rounds):
        sums = {f: {0: 0.0, 1: 0.0, 2: 0.0} for f in fields}
        expected = 0.0
        for *levels, n in counts:
            yes, no = share, 1 - share
            for f, level in zip(fields, levels):
                if level is not None:
                    yes *= max(m[f][level], 1e-12)
                    no *= max(u[f][level], 1e-12)
            p = yes / (yes + no) if yes + no else 0.0
            expected += p * n
            for f, level in zip(fields, levels):
                if level is not None:
                    sums[f][level] += p * n
        share = min(max(expected / total, 1e-9), 1 - 1e-9) if total else share
        for f in fields:
            seen = sum(sums[f].values())
            if seen:
                m[f] = {k: v / seen for k, v in sums[f].items()}
    return m, expected


def learn_weights(left: DataFrame, right: DataFrame) -> tuple[Weights, float]:
    """(weights, prior): the weight of every level, and the log2 odds that two
    rows taken at random match."""
    u = chance_levels(left, right)
    one, two = _patterns(left, "l"), _patterns(right, "r")
    total: dict[str, list[tuple[float, dict]]] = {f: [] for f in FIELDS}
    matches = []
    for name, keys in BLOCKINGS.items():
        fields = [f for f in FIELDS if f not in USES[name]]
        pairs = _block(one, two, keys).select(*[_level(f) for f in fields], (F.col("rows_l") * F.col("rows_r")).alias("rows"))
        rows = pairs.groupBy(*[f"{f}_level" for f in fields]).agg(F.sum("rows").alias("rows")).collect()  # at most 4^4
        m, expected = learned_levels([tuple(r) for r in rows], fields, u)
        matches.append(expected)
        for f in fields:
            total[f].append((expected, m[f]))
    weights: Weights = {}
    for f in FIELDS:
        sure = sum(e for e, _ in total[f]) or 1.0
        weights[f] = {}
        for level in (0, 1, 2) if f in ROUGH else (0, 2):
            m = sum(e * given[level] for e, given in total[f]) / sure
            weights[f][level] = math.log2(max(m, LEAST_M) / max(u[f][level], 1e-9))
    odds = max(matches, default=0.0) / max(1.0, float(left.count()) * right.count())
    return weights, math.log2(max(odds, 1e-12))


def scored(pairs: DataFrame, weights: Weights) -> DataFrame:
    score = F.lit(0)
    for f in FIELDS:
        level = F.col(f"{f}_level")
        part = F.lit(0)
        for k, w in sorted(weights[f].items()):
            part = F.when(level == k, F.lit(w)).otherwise(part)
        score = score + part
    return pairs.withColumn("score", score)


def link_stations(left: DataFrame, right: DataFrame, weights: Weights, least: float) -> DataFrame:
    """(identifier, ref_identifier, score) of every left row: its best
    candidate (ties: the smaller reference) if the score is at least
    ``least``, else nulls. left, right: as of ``comparable``."""
    pairs = scored(candidates(left, right), weights).where(F.col("score") >= F.lit(least))
    best = pairs.groupBy("identifier_l").agg(
        F.min_by(F.struct("identifier_r", "score"), F.struct(-F.col("score"), F.col("identifier_r"))).alias("best"))
    # every row of a pattern has the pattern's candidate
    first = left.groupBy(*FORMS).agg(F.min("identifier").alias("identifier_l"))
    same = [left[c].eqNullSafe(first[c]) for c in FORMS]
    named = left.join(first, same).select(left["identifier"], "identifier_l")
    return named.join(best, "identifier_l", "left").select(
        "identifier", F.col("best.identifier_r").alias("ref_identifier"), F.col("best.score").alias("score"))
