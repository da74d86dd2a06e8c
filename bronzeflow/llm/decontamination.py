"""Benchmark passages in documents by a positional inverted index.

Test items become phrases of consecutive words. A first pass counts the postings
of every test term, a second stores those of each phrase's rarest two terms:
document, position and the words around it. Lists, shifted by a term's place in
the phrase, are intersected from the rarest on; what is left is compared with the
stored words. Common terms are counted, never stored.

Near matches let one word in five be changed: of a phrase's words, one that is not
is among as many of the rarest plus one. Where such a word stands, the phrase's
other words are looked for around their places.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bronzeflow.llm.sql import NOT_ALNUM, ascii_lower, split_words
from bronzeflow.operators.once import compute_once
from bronzeflow.workspace import materialize

WINDOW = 10
#: Terms of one broadcast, a few MB; more of them are taken in blocks.
BLOCK_TERMS = 50_000


@dataclass(frozen=True)
class Near:
    """A near match: percent of a phrase's words that may be changed, words that the others may stand off their place."""

    changed_percent: int = 20
    slop: int = 3


def _words(text: Column) -> Column:
    return split_words(ascii_lower(text), NOT_ALNUM)


def phrases(benchmark: DataFrame, window: int) -> DataFrame:
    """(phrase, item_id): each run of `window` words of an item, or all words of a shorter one.

    Items without an id or without words have none.
    """
    items = materialize(benchmark.filter("item_id is not null").select("item_id", _words(F.col("text")).alias("words")), "items")
    spots = F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0)))
    runs = items.filter("size(words) > 0").select("item_id", F.explode(F.transform(spots, lambda i: F.slice(F.col("words"), i + 1, window))).alias("run"))
    return runs.select(F.array_join("run", " ").alias("phrase"), "item_id").distinct()


def _rows(docs: DataFrame) -> DataFrame:
    """doc_id, a hash that tells rows of one id apart, words."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("row"), "text")
    return compute_once(rows, "words", _words(F.col("text"))).drop("text")


def _blocks(terms: DataFrame) -> list[DataFrame]:
    """The terms in parts of at most about BLOCK_TERMS, each small enough to broadcast."""
    count = ceil(terms.count() / BLOCK_TERMS) or 1
    return [terms.filter(F.pmod(F.xxhash64("term"), F.lit(count)) == i) for i in range(count)]


def term_counts(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, n): length of each term's posting list; terms without postings are absent."""
    parts = []
    for block in _blocks(terms):
        found = rows.select(F.explode("words").alias("term")).join(F.broadcast(block), "term")  # at most BLOCK_TERMS
        parts.append(found.groupBy("term").agg(F.count(F.lit(1)).alias("n")))
    return materialize(_union(parts), "term_counts")


def postings(rows: DataFrame, terms: DataFrame, reach: int) -> DataFrame:
    """(term, doc_id, row, pos, near, base): postings of the terms with up to `reach` words on either side.

    near[0] is word number `base` of the document.
    """
    parts = []
    for block in _blocks(terms):
        spots = rows.select("doc_id", "row", "words", F.posexplode("words").alias("pos", "term"))
        base = F.greatest(F.col("pos") - reach, F.lit(0))
        found = spots.join(F.broadcast(block), "term")  # at most BLOCK_TERMS
        parts.append(found.select("term", "doc_id", "row", "pos", F.slice("words", base + 1, 2 * reach + 1).alias("near"), base.alias("base")))
    return materialize(_union(parts), "postings")


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


class Matches:
    """Phrase matches of a benchmark in documents.

    `exact`: (phrase, doc_id, row, start, size), one row per occurrence.
    """

    def __init__(self, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW):
        rows = _rows(docs)
        self.items = materialize(phrases(benchmark, window), "phrases")
        one = self.items.select("phrase").distinct()
        placed = materialize(one.select("phrase", F.posexplode(F.split("phrase", " ")).alias("at", "term")), "phrase_terms")
        counts = term_counts(rows, placed.select("term").distinct())
        self.rows, self.window = rows, window
        every = placed.join(counts, "term", "left").groupBy("phrase")
        rarest = every.agg(F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "term", "at"))).alias("rarest"))
        self.rarest = materialize(rarest, "phrases_rarest")

    @cached_property
    def ranked(self) -> DataFrame:
        """(phrase, rank, term, at): each phrase's two rarest terms. A phrase with a term that no document holds has no exact match."""
        held = self.rarest.filter("rarest[0].n > 0")
        ranked = held.select("phrase", F.posexplode(F.slice("rarest", 1, 2)).alias("rank", "t"))
        return materialize(ranked.select("phrase", "rank", F.col("t.term").alias("term"), F.col("t.at").alias("at")), "rarest")

    @cached_property
    def lists(self) -> DataFrame:
        return postings(self.rows, self.ranked.select("term").distinct(), self.window - 1)

    @cached_property
    def exact(self) -> DataFrame:
        return self._exact()

    def _shifted(self, rank: int) -> DataFrame:
        """Postings of the phrases' term of that rank, as places where the phrase would start."""
        own = self.ranked.filter(F.col("rank") == rank).select("term", "phrase", "at")
        return self.lists.join(own, "term").select("phrase", "doc_id", "row", (F.col("pos") - F.col("at")).alias("start"), "near", "base")

    def _exact(self) -> DataFrame:
        first = self._shifted(0).filter("start >= 0")
        second = self._shifted(1).select("phrase", "doc_id", "row", "start").withColumnsRenamed({c: f"_{c}" for c in ("phrase", "doc_id", "row", "start")})
        same = (
            (F.col("phrase") == F.col("_phrase")) & F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("row") == F.col("_row")) & (F.col("start") == F.col("_start"))
        )
        alone = ~F.contains("phrase", F.lit(" "))
        both = first.filter(~alone).join(second, same, "left_semi").union(first.filter(alone))
        size = F.size(F.split("phrase", " "))
        told = F.array_join(F.slice("near", F.col("start") - F.col("base") + 1, size), " ")
        return both.filter((F.col("start") >= F.col("base")) & (told == F.col("phrase"))).select("phrase", "doc_id", "row", "start", size.alias("size")).distinct()

    def proximity(self, slop: int, changed_percent: int = Near.changed_percent) -> DataFrame:
        """(phrase, doc_id, row, start): places where enough of a phrase's words stand, each at most `slop` words off its place.

        Enough is all but `changed_percent` of them, rounded down; which ones are
        changed does not matter, nor whether documents hold them. Places follow
        from one of the words. Exact matches are among them; a word of a document
        counts for one word of the phrase only.
        """
        changed = F.floor(F.size("rarest") * F.lit(changed_percent) / 100).cast("int")
        # Of one word more than may be changed, one is there. Words that no document holds come first.
        terms = self.rarest.select("phrase", F.size("rarest").alias("size"), changed.alias("changed"), F.explode(F.slice("rarest", F.lit(1), changed + 1)).alias("t"))
        terms = terms.filter("t.n > 0").select("size", "changed", F.col("t.term").alias("term"), F.col("t.at").alias("at"), "phrase", F.split("phrase", " ").alias("asked"))
        terms = materialize(terms, "near_terms")
        reach, parts = self.window - 1 + slop, []
        base = F.greatest(F.col("pos") - reach, F.lit(0))
        around = F.slice("words", base + 1, 2 * reach + 1)
        count = ceil(terms.count() / BLOCK_TERMS) or 1
        for number in range(count):
            block = terms.filter(F.pmod(F.xxhash64("phrase"), F.lit(count)) == number)
            spots = self.rows.select("doc_id", "row", "words", F.posexplode("words").alias("pos", "term"))
            # Cheap first: enough different words of the phrase around the place. Nothing is stored before.
            some = spots.join(F.broadcast(block), "term").filter(F.size(F.array_except("asked", around)) <= F.col("changed"))  # at most about BLOCK_TERMS
            parts.append(compute_once(some.withColumn("base", base).withColumn("start", F.col("pos") - F.col("at")), "near", around).drop("words"))
        found = """aggregate(array_distinct(asked), 0, (n, w) -> n + least(
            size(filter(sequence(0, size - 1), j -> asked[j] = w AND exists(
                sequence(0, size(near) - 1), i -> near[i] = w AND abs(base + i - start - j) <= {slop}))),
            size(filter(sequence(0, size(near) - 1), i -> near[i] = w AND exists(
                sequence(0, size - 1), j -> asked[j] = w AND abs(base + i - start - j) <= {slop})))))"""
        return _union(parts).filter(f"{found.format(slop=slop)} >= size - changed").select("phrase", "doc_id", "row", "start").distinct()


def near_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, near: Near = Near()) -> DataFrame:
    """doc_id, row, near_items of every row of docs: sorted ids, as strings, of the items with a near match of a phrase.

    Null and wordless texts have none. Rows are told apart as in contamination().
    """
    found = Matches(docs, benchmark, window)
    met = found.proximity(near.slop, near.changed_percent).select("doc_id", "row", "phrase").distinct().join(found.items, "phrase")
    named = met.groupBy(F.col("doc_id").alias("_id"), F.col("row").alias("_row")).agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("near_items"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("row") == F.col("_row"))
    joined = found.rows.select("doc_id", "row").join(materialize(named, "near_hits"), same, "left")
    return joined.select("doc_id", "row", F.coalesce("near_items", F.array().cast("array<string>")).alias("near_items"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, row, n_words, n_hit, items of every row of docs (doc_id, text).

    n_hit counts the words inside any occurrence of a benchmark phrase, items are
    the ids of the benchmark items with one, as sorted strings. Null and wordless
    texts have zeros and no items. Rows that share an id are searched each on
    their own (`row` is a hash of the text), equal rows alike, rows without an id
    too. An empty benchmark hits nothing. No rows give none.
    """
    found = Matches(docs, benchmark, window)
    exact = materialize(found.exact, "matches")
    spans = F.sort_array(F.collect_set(F.struct("start", "size")))
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("stop"))

    def step(done: Column, span: Column) -> Column:
        stop = F.greatest(done.stop, span["start"] + span["size"])
        return F.struct((done.n + stop - F.greatest(F.least(done.stop, stop), span["start"])).alias("n"), stop.alias("stop"))

    hits = exact.groupBy("doc_id", "row").agg(spans.alias("spans"))
    hits = hits.select("doc_id", "row", F.aggregate("spans", start, step, lambda done: done.n).cast("bigint").alias("n_hit"))
    named = exact.select("doc_id", "row", "phrase").distinct().join(found.items, "phrase")
    named = named.groupBy("doc_id", "row").agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    both = hits.join(named, hits.doc_id.eqNullSafe(named.doc_id) & (hits.row == named.row)).select(
        hits.doc_id.alias("_id"), hits.row.alias("_row"), "n_hit", "items"
    )
    rows = _rows(docs).select("doc_id", "row", F.size("words").cast("bigint").alias("n_words"))
    joined = rows.join(materialize(both, "hits"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("row") == F.col("_row")), "left")
    return joined.select(
        "doc_id", "row", "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items")
    )
