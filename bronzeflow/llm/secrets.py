"""Secrets in texts by a trigram inverted index.

Each rule's pattern is turned into a Boolean trigram query: alternatives of
trigrams that must all occur, in lower case. The index has a posting for each of
these trigrams and each document that holds it; intersecting postings gives a
rule's candidates, and only those are searched with the pattern itself. A rule
without a mandatory trigram is searched for in every document.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from re import _constants as codes
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bronzeflow.operators.once import compute_once
from bronzeflow.workspace import materialize


@dataclass(frozen=True)
class Rule:
    """A kind of secret: Java pattern, the group whose length counts, its least length."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: The base rules, in the order that breaks ties of spans.
BASE_RULES = (
    Rule(
        "assign",
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
        r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    # A maximal run of hex digits: the same spans as [0-9a-f]+ kept from 24 on, without a match for each short run.
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)

#: Rules that the method adds: key headers, signed tokens, service tokens, passwords in addresses.
ADDED_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("hub", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("maps", r"AIza[A-Za-z0-9_-]{35,}"),
    Rule("address", r"[a-z][a-z0-9+.-]{1,20}://[^\x20\x09-\x0D/:@]{1,}:[^\x20\x09-\x0D/:@]{1,}@"),
)

_BREAK = "\0"
_MOST = 64


def trigram_query(pattern: str) -> tuple[frozenset[str], ...]:
    """Alternatives of lower-case trigrams; a match holds all of one alternative. Empty: nothing is mandatory."""
    found = set()
    for text in _texts(parser.parse(pattern)):
        runs = text.lower().split(_BREAK)
        found.add(frozenset(run[i : i + 3] for run in runs for i in range(len(run) - 2)))
    if frozenset() in found:
        return ()
    # An alternative that asks for more than another one adds nothing.
    return tuple(sorted((a for a in found if not any(b < a for b in found)), key=sorted))


def _texts(nodes) -> list[str]:
    """Texts that the nodes can match, with a break wherever more than one character fits."""
    return reduce(lambda done, node: _joined(done, _node(*node)), nodes, [""])


def _joined(left: list[str], right: list[str]) -> list[str]:
    both = list(dict.fromkeys(re.sub(f"{_BREAK}+", _BREAK, a + b) for a in left for b in right))
    return both if len(both) <= _MOST else [a + _BREAK for a in left]


def _node(kind, value) -> list[str]:
    if kind is codes.LITERAL:
        return [chr(value)]
    if kind is codes.IN:
        # Letters of either case are one character of the index.
        chars = {chr(v).lower() for k, v in value if k is codes.LITERAL}
        return sorted(chars) if len(chars) <= 4 and all(k is codes.LITERAL for k, _ in value) else [_BREAK]
    if kind is codes.SUBPATTERN:
        return _texts(value[-1])
    if kind is codes.BRANCH:
        return [text for branch in value[1] for text in _texts(branch)]
    if kind in (codes.MAX_REPEAT, codes.MIN_REPEAT):
        low, high, nodes = value
        if low == 0:
            return ["", *_texts(nodes)] if high == 1 else [_BREAK]
        once = _texts(nodes)
        return once if low == high == 1 else [text + _BREAK for text in once]
    return [_BREAK]


def postings(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(trigram, doc_id): the index, of the trigrams that the rules ask for.

    lower() keeps every ASCII trigram of a text, in either case.
    """
    asked = sorted({t for rule in rules for part in trigram_query(rule.pattern) for t in part})
    vocabulary = F.array(*[F.lit(t) for t in asked])
    ready = compute_once(docs.select("doc_id", "text"), "_low", F.lower("text"))
    return ready.select("doc_id", F.explode(F.filter(vocabulary, lambda t: F.contains(F.col("_low"), t))).alias("trigram"))


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(doc_id, kinds): documents whose postings meet a rule's query."""
    asked = [
        (rule.kind, number, trigram, len(part))
        for rule in rules
        for number, part in enumerate(trigram_query(rule.pattern))
        for trigram in sorted(part)
    ]
    terms = index.sparkSession.createDataFrame(asked, "kind string, part int, trigram string, size int")
    met = (
        index.distinct()
        .join(F.broadcast(terms), "trigram")  # a few rows for each rule
        .groupBy("doc_id", "kind", "part", "size")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n = size")
    )
    return met.groupBy("doc_id").agg(F.collect_set("kind").alias("kinds"))


def _spans(text: Column, rule: Rule, number: int) -> Column:
    """Array of (start, number, stop) of the rule's leftmost matches, in code points."""
    pattern = F.lit(rule.pattern)
    lengths = lambda found: F.transform(found, F.length)
    # A match starts after the gaps and matches before it; the last gap has no match.
    rows = F.arrays_zip(
        lengths(F.split(text, rule.pattern, -1)).alias("gap"),
        lengths(F.regexp_extract_all(text, pattern, F.lit(0))).alias("size"),
        lengths(F.regexp_extract_all(text, pattern, F.lit(rule.group))).alias("value"),
    )
    nothing = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,number:int,stop:int>>").alias("spans"))

    def step(done: Column, row: Column) -> Column:
        start = done.at + row["gap"]
        stop = start + F.coalesce(row["size"], F.lit(0))
        span = F.struct(start.alias("start"), F.lit(number).alias("number"), stop.alias("stop"))
        return F.struct(stop.alias("at"), F.when(row["value"] >= rule.least, F.array_append(done.spans, span)).otherwise(done.spans).alias("spans"))

    return F.aggregate(rows, nothing, step, lambda done: done.spans)


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + ADDED_RULES) -> DataFrame:
    """doc_id, text and secrets: array of (start, number, stop), by start, then by the rule's place in `rules`.

    Starts and stops are code points of the whole text, stop exclusive. Matches
    of one rule do not overlap, those of two may. Null and empty texts have no
    secrets. Rows that share an id are searched each on their own; rows without
    an id too. Other columns are left out. No rows give none.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    asked = tuple(r for r in rules if trigram_query(r.pattern))
    # Written, so that Spark knows how few they are and need not shuffle the texts to them.
    found = materialize(candidates(postings(rows, asked), asked).withColumnRenamed("doc_id", "_id"), "candidates")
    every = rows.join(found, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    text, none = F.col("text"), F.array().cast("array<struct<start:int,number:int,stop:int>>")
    spans = []
    for number, rule in enumerate(rules):
        wanted = F.array_contains("kinds", F.lit(rule.kind)) if rule in asked else F.regexp_like(text, F.lit(rule.pattern))
        spans.append(F.when(wanted, _spans(text, rule, number)).otherwise(none))
    return every.select("doc_id", "text", F.sort_array(F.flatten(F.array(*spans))).alias("secrets"))
