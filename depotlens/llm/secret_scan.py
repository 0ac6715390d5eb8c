"""Operator 5: secret scans with a trigram inverted index.

Each rule's regular expression gives a Boolean trigram query (an AND of
clauses, each an OR of literal strings, each an AND of trigrams). Postings
(trigram, document) are built for the trigrams that the queries ask for, the
postings of a document are intersected with every query, and only candidates
are verified with the expression itself. A rule without mandatory trigrams
(hex runs) scans every text.

Spans are 0-based code points with exclusive end, of the whole match, leftmost
and non-overlapping per kind.

* null text: as empty, no spans. Repeated rows: one result row each; rows with
  equal (doc_id, text) share postings.
* equal starts are ordered by the kinds as listed.
* extra columns are kept by ``redact`` and not carried by ``scan``; an empty
  table gives no rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlens.llm.common import text_or_empty


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    #: a match counts if this group has at least so many characters
    group: int = 0
    least: int = 1


# fixed values: the base kinds of the contract, in its order
BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}"),  # a maximal run of 16 and more
)
#: kinds that the operator adds to the base
ADDED = (
    Rule("github", r"gh[opsu]_[A-Za-z0-9]{30,}"),
    Rule("slack", r"xox[abp]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN (RSA |EC |OPENSSH )?PRIVATE KEY-----"),
)
RULES = BASE + ADDED

MOST_STRINGS = 32  # literal alternatives that a clause may hold


def _strings(items) -> list[set[str]]:
    """Clauses of a parsed expression: sets of strings of which every match
    contains one."""
    clauses: list[set[str]] = []
    open_set = {""}

    def close():
        nonlocal open_set
        clauses.append(open_set)
        open_set = {""}

    for op, arg in items:
        name = str(op)
        alternatives: set[str] | None = None
        if name == "LITERAL":
            alternatives = {chr(arg)}
        elif name == "IN" and all(str(o) == "LITERAL" for o, _ in arg):
            alternatives = {chr(v) for _, v in arg}
        elif name in ("SUBPATTERN", "BRANCH", "MAX_REPEAT"):
            parts = [arg[-1]] if name == "SUBPATTERN" else arg[1] if name == "BRANCH" else [arg[2]]
            inner = [_strings(p) for p in parts]
            if all(len(x) == 1 for x in inner):
                alternatives = set().union(*(x[0] for x in inner))
            if name == "MAX_REPEAT":
                if arg[:2] == (0, 1) and alternatives is not None:
                    alternatives = alternatives | {""}
                elif arg[0] >= 1 and alternatives is not None and arg[0] == arg[1] == 1:
                    pass
                else:
                    alternatives = None
        if alternatives is None:
            close()
            if name == "SUBPATTERN":
                clauses += _strings(arg[-1])
        elif len(open_set) * len(alternatives) > MOST_STRINGS:
            close()
            open_set = alternatives
        else:
            open_set = {a + b for a, b in product(open_set, alternatives)}
    return [*clauses, open_set]


def trigrams_of(text: str) -> list[str]:
    return [text[i:i + 3] for i in range(len(text) - 2)]


def trigram_query(pattern: str) -> list[list[list[str]]]:
    """AND of ORs of ANDs of lower-case trigrams; empty: no mandatory trigrams."""
    query = []
    for clause in _strings(re._parser.parse(pattern)):
        clause = {s.lower() for s in clause}
        if min(map(len, clause)) >= 3:
            query.append([trigrams_of(s) for s in sorted(clause)])
    return query


def _row_key() -> Column:
    # a collision only adds a candidate, which is then verified
    return F.xxhash64("doc_id", "text")


def postings(df: DataFrame, wanted: list[str]) -> DataFrame:
    """(trigram, doc): the inverted index, for the trigrams that are asked for."""
    low = F.col("_low")
    found = F.array_compact(F.array(*[F.when(low.contains(t), F.lit(t)) for t in wanted]))
    return (df.select(_row_key().alias("doc"), F.lower(text_or_empty()).alias("_low"))
            .select("doc", F.explode(found).alias("trigram")))


def candidates(df: DataFrame, rules=RULES) -> DataFrame:
    """(doc, kinds): the rules whose trigram query the document's postings satisfy."""
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern))}
    wanted = sorted({t for q in queries.values() for clause in q for s in clause for t in s})
    held = postings(df, wanted).groupBy("doc").agg(F.collect_set("trigram").alias("held"))

    def all_of(values, one):
        out = F.lit(True)
        for v in values:
            out = out & one(v)
        return out

    def any_of(values, one):
        out = F.lit(False)
        for v in values:
            out = out | one(v)
        return out

    def has(t):
        return F.array_contains("held", t)

    kinds = [F.when(all_of(q, lambda clause: any_of(clause, lambda s: all_of(s, has))), F.lit(k))
             for k, q in queries.items()]
    return (held.select("doc", F.array_compact(F.array(*kinds)).alias("kinds"))
            .where(F.size("kinds") > 0))


_SPAN = "struct<start:int,kind:int,end:int>"


def _spans(text: Column, rule: Rule, number: int) -> Column:
    """Matches of one rule as array of (start, kind, end): the gaps between
    matches and the matches themselves are cut out in parallel, and their
    lengths added up."""
    lengths = F.zip_with(
        F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), F.split(text, rule.pattern, -1),
        lambda m, gap: F.struct(F.length(gap).alias("gap"), F.length(m).alias("size")))
    if rule.group:
        lengths = F.zip_with(
            lengths, F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)),
            lambda x, g: F.struct(x["gap"].alias("gap"), x["size"].alias("size"), F.length(g).alias("held")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("found"))

    def step(acc, x):
        begin = acc["at"] + x["gap"]
        end = begin + x["size"]
        span = F.array(F.struct(begin.alias("start"), F.lit(number).alias("kind"), end.alias("end")))
        counted = (x["held"] if rule.group else x["size"]) >= rule.least
        return F.when(x["size"].isNull(), acc).otherwise(
            F.struct(end.alias("at"), F.when(counted, F.concat(acc["found"], span))
                     .otherwise(acc["found"]).alias("found")))

    return F.aggregate(lengths, start, step)["found"]


def scan(df: DataFrame, rules=RULES, keep: list[str] | None = None) -> DataFrame:
    """df's columns named in ``keep`` (default doc_id) and ``spans``, an array
    of (start, kind number, end), sorted."""
    keep = keep or ["doc_id"]
    none = F.array().cast(f"array<{_SPAN}>")
    rows = df.select(*dict.fromkeys([*keep, "doc_id", "text"])).withColumn("_doc", _row_key())
    rows = rows.join(candidates(df, rules).withColumnRenamed("doc", "_doc"), "_doc", "left")
    text = text_or_empty()
    found = []
    for i, r in enumerate(rules):
        asked = F.array_contains("kinds", r.kind) if trigram_query(r.pattern) else text.rlike(r.pattern)
        found.append(F.when(asked, _spans(text, r, i)).otherwise(none))
    return rows.select(*keep, F.array_sort(F.concat(*found)).alias("spans"))


def span_text(spans: Column, rules=RULES) -> Column:
    names = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(df: DataFrame, rules=RULES) -> DataFrame:
    """df with every span of ``text`` replaced by [SECRET]; overlapping spans
    are replaced together. All columns stay; a null text stays null."""
    # the row travels as one column, so its names cannot clash with the scan's
    found = scan(df.select("doc_id", "text", F.struct(*df.columns).alias("_row")), rules, ["text", "_row"])
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    text = F.col("text")

    def step(acc, s):
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] >= acc["at"], F.concat(acc["out"], gap, F.lit("[SECRET]")))
            .otherwise(acc["out"]).alias("out"))

    cut = F.aggregate("spans", start, step, lambda acc: F.concat(
        acc["out"], F.substring(text, acc["at"] + 1, F.length(text) - acc["at"])))
    clean = F.when(F.size("spans") > 0, cut).otherwise(text)
    return found.select(*[clean.alias(c) if c == "text" else F.col("_row")[c].alias(c) for c in df.columns])
