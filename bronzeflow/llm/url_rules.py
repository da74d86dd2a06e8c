"""URL filtering by stated rules, and by association rules where none of them fits.

Spark's FP-growth mines combinations of URL tokens that go with a label. Rules
without enough support or confidence, and those that a shorter rule covers, are
pruned. The others form an inverted index by their rarest token, so a URL meets
only rules that share a rare token with it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bronzeflow.llm.sql import ascii_lower
from bronzeflow.workspace import materialize


@dataclass(frozen=True)
class UrlRule:
    """A verdict for a host, its subdomains, and paths that start like `path`."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The stated rules.
STATED = (
    UrlRule("allow", "org", "/"),
    UrlRule("block", "example.org", "/es/"),
    UrlRule("block", "example.org", "/en/1"),
    UrlRule("allow", "com", "/fr/"),
    UrlRule("block", "com", "/de/"),
)


@dataclass(frozen=True)
class Mining:
    """Least share of labelled URLs and least confidence of a mined rule, and the verdict without one."""

    support: float = 0.02
    confidence: float = 0.9
    otherwise: str = "allow"


def host(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z in lower case; empty for null or without ://."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path(url: Column) -> Column:
    """After the host up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def stated_rule(rules: tuple[UrlRule, ...]) -> Column:
    """Struct (name, verdict) of the longest fitting rule over columns host and path, or null; ties by name."""
    fits = F.lit(None).cast("struct<name:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        at_host = (F.col("host") == rule.host) | F.endswith("host", F.lit("." + rule.host))
        value = F.struct(F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"))
        fits = F.when(at_host & F.startswith("path", F.lit(rule.path)), value).otherwise(fits)
    return fits


def url_tokens(url: Column) -> Column:
    """Distinct tokens of a URL: scheme, host labels by place, path parts, file ending, query names, fragment.

    Numbers in a path are one token each place. Columns host and path are used.
    """
    labels = F.reverse(F.split("host", r"\."))
    parts = F.filter(F.split("path", "/"), lambda x: x != "")
    names = F.regexp_extract_all(url, F.lit(r"[?&]([^=&#]+)"), F.lit(1))
    shaped = F.transform(parts, lambda x, i: F.concat(F.lit("path"), i.cast("string"), F.lit("="), F.regexp_replace(x, r"[0-9]+", "0")))
    return F.array_distinct(
        F.concat(
            F.transform(labels, lambda x, i: F.concat(F.lit("host"), i.cast("string"), F.lit("="), x)),
            F.array(F.concat(F.lit("site="), F.array_join(F.reverse(F.slice(labels, 1, 2)), "."))),
            shaped,
            F.transform(names, lambda x: F.concat(F.lit("query="), x)),
            F.when(F.contains(url, F.lit("#")), F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>")),
        )
    )


def mine_rules(labelled: DataFrame, mining: Mining = Mining()) -> DataFrame:
    """(rule_id, tokens, verdict, confidence, support) mined from labelled (tokens, verdict) rows.

    Of rules for one verdict, those with a shorter one inside them that is as
    sure are left out. No labelled rows give no rules. Support bounds their number.
    """
    baskets = labelled.select(F.array_append("tokens", F.concat(F.lit("verdict="), "verdict")).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=mining.support, minConfidence=mining.confidence).fit(baskets)
    mined = model.associationRules.select("antecedent", F.element_at("consequent", 1).alias("then"), "confidence", "support")
    mined = mined.filter(F.startswith("then", F.lit("verdict=")) & ~F.exists("antecedent", lambda x: F.startswith(x, F.lit("verdict="))))
    mined = mined.select(
        F.array_sort("antecedent").alias("tokens"), F.substring("then", 9, 1000).alias("verdict"), "confidence", "support"
    ).withColumn("rule_id", F.sha2(F.concat_ws("\n", F.array_append("tokens", F.col("verdict"))), 256))
    mined = materialize(mined, "mined")
    # A shorter rule inside a longer one shares each of its own tokens with it: they meet by its first one.
    short = mined.select(F.element_at("tokens", 1).alias("first"), F.col("tokens").alias("_tokens"), F.col("verdict").alias("_verdict"), F.col("confidence").alias("_confidence"))
    inside = (
        (F.col("token") == F.col("first"))
        & (F.size("_tokens") < F.size("tokens"))
        & (F.col("verdict") == F.col("_verdict"))
        & (F.col("_confidence") >= F.col("confidence"))
        & (F.size(F.array_except("_tokens", "tokens")) == 0)
    )
    covered = mined.withColumn("token", F.explode("tokens")).join(short, inside, "left_semi").select("rule_id").distinct()
    return materialize(mined.join(covered, "rule_id", "left_anti"), "rules")


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, verdict) of the surest rule whose tokens a URL all holds; ties by support, length, id. URLs without one are absent."""
    words = materialize(urls.select("url", "tokens", F.explode("tokens").alias("token")).join(rules.select(F.explode("tokens").alias("token")).distinct(), "token"), "url_words")
    common = words.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    index = (
        rules.select("rule_id", F.explode("tokens").alias("token"))
        .join(common, "token", "left")
        .groupBy("rule_id")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("rare"))
        .join(rules, "rule_id")
        .select(F.col("rare.token").alias("token"), "rule_id", F.col("tokens").alias("needed"), "verdict", "confidence", "support")
    )
    met = words.join(materialize(index, "index"), "token").filter(F.size(F.array_except("needed", "tokens")) == 0)
    rank = F.struct("confidence", "support", F.size("needed").alias("size"), "rule_id", "verdict")
    return met.groupBy("url").agg(F.max(rank).alias("best")).select("url", F.col("best.verdict").alias("verdict"))


def judge_urls(pages: DataFrame, rules: tuple[UrlRule, ...] = STATED, mining: Mining = Mining()) -> DataFrame:
    """pages with host, path, rule and verdict; clashing columns are replaced.

    The longest stated rule that fits decides, `rule` being its host and path.
    URLs that fit one label the mining; the mined rules decide the others (rule
    is null), and mining.otherwise where none matches. Null URLs have empty
    parts. Equal URLs are judged alike, once. No rows give none.
    """
    added = ["host", "path", "rule", "verdict"]
    held = pages.select(*[c for c in pages.columns if c not in added])
    parts = held.withColumns({"host": host(F.col("url")), "path": path(F.col("url"))}).withColumn("_fit", stated_rule(rules))
    tokens = url_tokens(F.col("url"))
    known = materialize(parts.filter("_fit is not null").select(tokens.alias("tokens"), F.col("_fit.verdict").alias("verdict")), "labelled")
    judged = parts.withColumns({"rule": F.col("_fit.name"), "_stated": F.col("_fit.verdict")}).drop("_fit")
    if known.isEmpty():
        return judged.withColumn("verdict", F.coalesce("_stated", F.lit(mining.otherwise))).drop("_stated")
    open_urls = materialize(parts.filter("_fit is null and host <> ''").select("url", tokens.alias("tokens")).distinct(), "open_urls")
    mined = materialize(match_rules(open_urls, mine_rules(known, mining)).select(F.col("url").alias("_url"), F.col("verdict").alias("_mined")), "mined_verdicts")
    joined = judged.join(mined, F.col("url") == F.col("_url"), "left")
    return joined.withColumn("verdict", F.coalesce("_stated", "_mined", F.lit(mining.otherwise))).drop("_stated", "_url", "_mined")
