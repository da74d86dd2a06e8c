"""Quality rules by host: what a host's documents fail on counts for each of them.

Each document is measured by itself. Failures are added up by host, a host's rate
is shrunk towards the others' by a beta prior fitted to the usual hosts' rates, and
the host's verdict is joined back to its documents. A host goes if its rate lies
clearly above what the prior lets expect.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bronzeflow.llm.sql import SPACE, split_words
from bronzeflow.operators.once import compute_once
from bronzeflow.workspace import materialize


@dataclass(frozen=True)
class HostRules:
    """Limits of a document's measures, and when a host is rejected.

    It goes from a shrunk failure rate of `reject_rate` on, and if that rate lies
    more than `sure` of its own standard errors above both `moderate` and the
    usual hosts: their mean and the larger of `margin` and `sure` times their spread.
    The prior never weighs more than `most_weight` documents. It is fitted to hosts
    of `least_docs` documents or more, where there are any.
    """

    symbol_percent: int = 10
    dup_line_percent: int = 30
    reject_rate: float = 0.8
    moderate: float = 0.3
    margin: float = 0.1
    sure: float = 3.0
    most_weight: float = 50.0
    least_docs: int = 10


MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def _repeat_words(words: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more in one text.

    Windows are told apart by a 64-bit hash. Texts in which all differ, the
    most, are done after one pass; else equal hashes meet by sorting.
    """
    spots = F.sequence(F.lit(0), F.size(words) - 3)
    hashes = F.transform(spots, lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2]))
    held = F.transform(F.array(hashes), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_covered(h)))
    return F.when(F.size(words) >= 4, F.element_at(held, 1)).otherwise(0)


def _covered(hashes: Column) -> Column:
    placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    twice = F.transform(
        F.array(placed),
        lambda s: F.sort_array(
            F.transform(
                F.filter(
                    F.sequence(F.lit(0), F.size(s) - 1),
                    lambda j: ((j > 0) & (F.get(s, j)["h"] == F.get(s, j - 1)["h"])) | F.coalesce(F.get(s, j)["h"] == F.get(s, j + 1)["h"], F.lit(False)),
                ),
                lambda j: F.get(s, j)["i"],
            )
        ),
    )
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("stop"))
    step = lambda done, i: F.struct((done.n + i + 3 - F.greatest(done.stop, i)).alias("n"), (i + 3).alias("stop"))
    return F.aggregate(F.element_at(twice, 1), start, step, lambda done: done.n)


def measure(docs: DataFrame) -> DataFrame:
    """docs with MEASURES and base_failed; clashing columns are replaced.

    Null, empty and wordless texts have zeros everywhere and fail.
    """
    added = [*MEASURES, "base_failed"]
    held = [c for c in docs.columns if c not in added]
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]")))
    ready = compute_once(compute_once(docs.select(*held), "_words", split_words(F.col("text"))), "_lines", lines)
    words = F.col("_words")
    counted = ready.select(
        *held,
        F.size(words).cast("bigint").alias("n_words"),
        F.length(F.regexp_replace(text, SPACE, "")).cast("bigint").alias("word_chars"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        _repeat_words(words).cast("bigint").alias("n_repeat_words"),
    )
    return counted.withColumn("base_failed", F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words"))


def host_rates(measured: DataFrame, host: str, rules: HostRules) -> DataFrame:
    """(host, n_docs, n_failed, rate, rejected): failures by host, shrunk by an empirical beta prior, and the verdict.

    The prior's mean is the median of the hosts' raw rates, its spread that of the
    hosts up to the median with the binomial noise taken out: failing hosts, if
    less than half, do not widen it. A null host is a host of its own.
    """
    failed = F.expr(
        f"base_failed OR 100 * n_symbols > {rules.symbol_percent} * word_chars OR 100 * n_dup_lines > {rules.dup_line_percent} * n_lines"
    )
    hosts = materialize(
        measured.groupBy(F.col(host).alias("host")).agg(F.count(F.lit(1)).alias("n_docs"), F.sum(failed.cast("bigint")).alias("n_failed")), "hosts"
    )
    least = min(rules.least_docs, hosts.agg(F.max("n_docs")).first()[0] or 0)
    usual = hosts.filter(F.col("n_docs") >= least).select("n_docs", F.expr("n_failed / n_docs").alias("raw"))
    mean = usual.agg(F.percentile_approx("raw", 0.5)).first()[0] or 0.0
    noise = mean * (1 - mean) / F.col("n_docs")
    spread = usual.filter(F.col("raw") <= mean).agg(F.avg(F.pow(F.col("raw") - F.lit(mean), F.lit(2.0)) - noise)).first()[0] or 0.0
    spread = max(spread, 0.0)
    weight = min(max(mean * (1 - mean) / spread - 1, 1.0), rules.most_weight) if spread > 0 else rules.most_weight
    limit = max(rules.moderate, mean + max(rules.margin, rules.sure * spread**0.5))
    rate = (F.col("n_failed") + F.lit(mean * weight)) / (F.col("n_docs") + F.lit(weight))
    error = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("n_docs") + F.lit(weight + 1)))
    above = F.col("rate") - F.lit(rules.sure) * error > F.lit(limit)
    return hosts.withColumn("rate", rate).withColumn("rejected", above | (F.col("rate") >= rules.reject_rate))


def judge(measured: DataFrame, host: str = "source", rules: HostRules = HostRules()) -> DataFrame:
    """measured with host_rate and kept: not failed itself, and its host not rejected.

    Rows are judged each on their own, repeated ones alike. No rows give none.
    """
    added = ["host_rate", "kept"]
    held = materialize(measured.select(*[c for c in measured.columns if c not in added]), "measured")
    rates = materialize(host_rates(held, host, rules).select(F.col("host").alias("_host"), F.col("rate").alias("host_rate"), F.col("rejected").alias("_rejected")), "rates")
    # A hot host's rows meet one row: a shuffle join that adaptive execution splits, or a broadcast if Spark finds it small.
    joined = held.join(rates, F.col(host).eqNullSafe(F.col("_host")), "left").drop("_host")
    return joined.withColumn("kept", ~F.col("base_failed") & ~F.col("_rejected")).drop("_rejected")
