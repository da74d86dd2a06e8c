"""Mixing of sources to target weights by iterative proportional fitting.

Tokens are added up by cell: source, language and topic. Raking scales the cells
until their shares meet the targets of each of the three in turn and all together
hold the stated share of the tokens. No cell weighs more than 1: what a target
asks for beyond a value's own tokens goes to the other values, so a rare cell is
kept whole and lowers no other one. A document is sampled with its cell's weight
as probability. The draw is a hash of the doc_id, so a lost task or a second run
repeats it.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from bronzeflow.llm.sql import split_words
from bronzeflow.workspace import materialize

DIMENSIONS = ("source", "lang", "topic")


@dataclass(frozen=True)
class Mix:
    """Targets by dimension: shares of its values, or, where not given, own shares to the power in `temper`.

    Values without a given share keep their own share; all are scaled to add up to 1.
    `share` is the part of all tokens that is sampled. Without it the largest weight
    of any cell gets probability 1, however few tokens that cell has.

    Raking takes `rounds` rounds at least, then more until no value's tokens are off
    their target by more than `tolerance` of it. Targets that cannot be met together
    end it when the largest error no longer shrinks, or after `most_rounds`, with a warning.
    With a share, weights grow to `most_weight` at most while a target that its cells
    cannot meet asks for more; what counts and is returned is 1 at most.
    """

    temper: dict[str, float] = field(default_factory=lambda: {"source": 0.7, "lang": 0.8, "topic": 1.0})
    rounds: int = 8
    most_rounds: int = 500
    tolerance: float = 1e-4
    most_weight: float = 1e6
    share: float | None = 0.75
    targets: dict[str, dict[str, float]] = field(default_factory=dict)
    salt: str = "mix"


def form_topic(text: Column) -> Column:
    """A coarse topic by form, for tables without a topic column: table, symbols, capitals, short or prose."""
    text = F.coalesce(text, F.lit(""))
    size = F.greatest(F.length(text), F.lit(1))
    count = lambda other: F.length(F.regexp_replace(text, other, ""))
    return (
        F.when(100 * count(r"[^|]+") >= 2 * size, "table")
        .when(100 * count(r"[^#*$%&<>]+") >= 5 * size, "symbols")
        .when(100 * count(r"[^A-Z]+") >= 30 * size, "capitals")
        .when(size < 200, "short")
        .otherwise("prose")
    )


def cell_tokens(docs: DataFrame) -> DataFrame:
    """(source, lang, topic, tokens): words by cell; a null value is a value of its own."""
    return docs.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens"))


def _trimmed(raw_shares: DataFrame, wanted: float) -> float:
    """The scale at which least(own, scale * raw) adds up to the wanted tokens: values below their target give all they have."""
    scale = 0.0
    while True:
        full = F.col("own") < F.col("raw") * F.lit(scale)
        kept = raw_shares.agg(F.sum(F.when(full, F.col("own"))).alias("own"), F.sum(F.when(~full, F.col("raw"))).alias("raw")).first()
        more = (wanted - (kept["own"] or 0.0)) / kept["raw"] if kept["raw"] else scale
        # It only grows, as each round adds values that give all; the last digits do not count.
        if more <= scale * (1 + 1e-12):
            return scale
        scale = more


def _aims(cells: DataFrame, name: str, mix: Mix, share: float | None, total: int) -> DataFrame:
    """(_v, aim): tokens that each value of a dimension should have."""
    own = cells.groupBy(name).agg(F.sum("tokens").cast("double").alias("own"))
    given = mix.targets.get(name)
    raw = F.col("own") / F.lit(float(max(total, 1)))
    if given is None:
        raw = F.pow(raw, F.lit(mix.temper[name]))
    for value, part in sorted((given or {}).items()):
        raw = F.when(F.col(name) == value, F.lit(float(part))).otherwise(raw)
    raw_shares = materialize(own.select(F.col(name).alias("_v"), "own", raw.alias("raw")), "goals")
    if share is None:
        aim = F.col("raw") * F.lit(total / (raw_shares.agg(F.sum("raw")).first()[0] or 1.0))
    else:
        aim = F.least(F.col("own"), F.col("raw") * F.lit(_trimmed(raw_shares, share * total)))
    return raw_shares.select("_v", aim.alias("aim"))


def rake(cells: DataFrame, mix: Mix, share: float | None = None) -> DataFrame:
    """cells with weight, after rounds over the three dimensions until the targets are met; cells without tokens weigh 1.

    With a share the weights are at most 1 and add up to that share of all tokens; cells without tokens weigh the share.
    Each dimension's turn is one aggregate, joined to the cells it came from, and written.
    """
    held = cells.withColumns({"weight": F.lit(1.0 if share is None else float(share)), "off": F.lit(0.0)})
    held = materialize(held.select(*DIMENSIONS, "tokens", "weight", "off"), "cells")
    total = held.agg(F.sum("tokens")).first()[0] or 0  # one number
    weight = F.col("weight") if share is None else F.least(F.col("weight"), F.lit(1.0))
    goals = {name: materialize(_aims(held, name, mix, share, total), "aims") for name in DIMENSIONS}
    for name, aims in goals.items():
        held = materialize(held.join(aims.withColumnRenamed("aim", f"aim_{name}"), F.col(name).eqNullSafe(F.col("_v"))).drop("_v"), "cells")
    errors: list[float] = []
    while len(errors) < mix.rounds or errors[-1] > mix.tolerance:
        if len(errors) >= mix.most_rounds or _stuck(errors[mix.rounds :]):
            warnings.warn(f"targets cannot be met together: off by {errors[-1]:.2g} of a target after {len(errors)} rounds", stacklevel=2)
            break
        for turn, name in enumerate(DIMENSIONS):
            now = held.groupBy(F.col(name).alias("_f")).agg(F.sum(F.col("tokens") * weight).alias("now"), F.max(f"aim_{name}").alias("aim"))
            factor = now.select("_f", F.when(F.col("now") > 0, F.col("aim") / F.col("now")).otherwise(1.0).alias("factor"))
            moved = F.col("weight") * F.col("factor")
            if share is not None:
                moved = F.least(moved, F.lit(mix.most_weight))
            # A factor is how far its value was off when its turn came.
            off = F.abs(F.col("factor") - 1) if turn == 0 else F.greatest("off", F.abs(F.col("factor") - 1))
            joined = held.join(factor, F.col(name).eqNullSafe(F.col("_f"))).withColumns({"weight": moved, "off": off}).drop("_f", "factor")
            seen = Observation()
            # Cuts the lineage: the next turn reads these cells twice.
            held = materialize(joined.observe(seen, F.max("off").alias("off")), "cells")
        errors.append(seen.get["off"] or 0.0)
    return held.select(*DIMENSIONS, "tokens", weight.alias("weight"))


def _stuck(errors: list[float]) -> bool:
    """Whether the last 20 rounds brought the largest error down by less than a hundredth."""
    return len(errors) > 20 and min(errors[-20:]) > 0.99 * min(errors[:-20])


def uniform(key: Column, salt: str) -> Column:
    """A number from 0 up to 1 that depends on the key alone."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(salt), F.coalesce(key.cast("string"), F.lit("")))), 1, 12), 16, 10).cast("bigint") / F.lit(float(1 << 48))


def rates(docs: DataFrame, mix: Mix) -> DataFrame:
    """(source, lang, topic, weight, rate): sampling probability by cell, for docs (source, lang, topic, tokens)."""
    cells = rake(cell_tokens(docs), mix, mix.share)
    if mix.share is not None:
        return materialize(cells.select(*DIMENSIONS, "weight", F.col("weight").alias("rate")), "rates")
    most = cells.filter("tokens > 0").agg(F.max("weight")).first()[0] or 1.0
    return materialize(cells.select(*DIMENSIONS, "weight", F.least(F.col("weight") / F.lit(most), F.lit(1.0)).alias("rate")), "rates")


def draws(docs: DataFrame, mix: Mix = Mix(), topic: Column | None = None) -> DataFrame:
    """doc_id, source, lang, topic, weight, rate and sampled of every row of docs; sampled follows the rate.

    `topic` is an expression over docs, by default form_topic. Null sources,
    languages and topics are values of their own; null and wordless texts have no
    tokens, and cells of such texts only are sampled at their unraked weight. Rows
    that share an id are drawn alike, rows without an id too. No rows give none.
    """
    named = form_topic(F.col("text")) if topic is None else topic
    marks = materialize(docs.select("doc_id", "source", "lang", named.alias("topic"), F.size(split_words(F.col("text"))).cast("bigint").alias("tokens")), "marks")
    cells = _renamed(rates(marks, mix))
    return marks.join(cells, _same_cell("topic"), "left").select(
        "doc_id", *DIMENSIONS, "weight", "rate", (uniform(F.col("doc_id"), mix.salt) < F.col("rate")).alias("sampled")
    )


def _renamed(cells: DataFrame) -> DataFrame:
    return cells.select(F.col("source").alias("_s"), F.col("lang").alias("_l"), F.col("topic").alias("_t"), "weight", "rate")


def _same_cell(topic: str) -> Column:
    return F.col("source").eqNullSafe(F.col("_s")) & F.col("lang").eqNullSafe(F.col("_l")) & F.col(topic).eqNullSafe(F.col("_t"))


def mix_sources(docs: DataFrame, mix: Mix = Mix(), topic: Column | None = None) -> DataFrame:
    """The sampled rows of docs, with all their columns, by the rules of draws()."""
    named = form_topic(F.col("text")) if topic is None else topic
    marks = docs.select("source", "lang", named.alias("topic"), F.size(split_words(F.col("text"))).cast("bigint").alias("tokens"))
    cells = _renamed(rates(marks, mix)).withColumnsRenamed({"weight": "_weight", "rate": "_rate"})
    joined = docs.withColumn("_topic", named).join(cells, _same_cell("_topic"))
    return joined.filter(uniform(F.col("doc_id"), mix.salt) < F.col("_rate")).select(*docs.columns)
