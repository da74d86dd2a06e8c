"""Interaction of filters: what each one removes in every order, by part of a corpus.

Each document has a mask of the filters it fails, so a part is at most 32 cells of
counts. A Gray code walks through all 32 sets of filters and toggles one filter at
a time: each cell counts how many active filters it fails, and where that count
leaves or reaches zero, the running survivors lose or regain the cell. The 32
states are kept; a step of an order is the difference of two of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bronzeflow.llm.sql import split_words
from bronzeflow.workspace import materialize

#: The filters; bit i of a mask is the failure of the i-th.
FILTERS = "ABCDE"

_SETS = 1 << len(FILTERS)
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Limits:
    """Least words, least percent of distinct words, most percent of capitals, marks that a clean text lacks."""

    least_words: int = 50
    distinct_percent: int = 65
    capital_percent: int = 5
    marks: str = "#$%&*|"


def text_failures(text: Column, limits: Limits = Limits()) -> list[Column]:
    """Whether a text, not null, fails A, B, C and D."""
    words = split_words(text)
    size = F.size(words)
    capitals = F.length(text) - F.length(F.translate(text, _LETTERS, ""))
    return [
        size < limits.least_words,
        100 * F.size(F.array_distinct(words)) < limits.distinct_percent * size,
        100 * capitals > limits.capital_percent * F.length(text),
        F.length(F.translate(text, limits.marks, "")) < F.length(text),
    ]


def cells(docs: DataFrame, labels: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(part, mask, n, good, toxic) of docs (doc_id, text, source) and labels (doc_id, quality, toxic).

    A copy fails E if a row with a smaller doc_id has its text. Only the ids that
    come first are looked up, by id and digest, so no group of copies meets in a task.
    """
    text = F.coalesce("text", F.lit(""))
    failed = [F.when(f, 1 << i).otherwise(0) for i, f in enumerate(text_failures(text, limits))]
    marks = docs.select(
        F.col("doc_id").alias("id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        sum(failed[1:], failed[0]).alias("mask"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
    )
    marks = materialize(marks, "audit_marks")
    named = marks.filter("id IS NOT NULL")
    firsts = named.groupBy("digest").agg(F.min("id").alias("first")).select(F.col("digest").alias("_digest"), "first", F.lit(True).alias("is_first"))
    judged = (
        labels.filter("doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").alias("_id"))
        .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    )
    copy = F.when(F.col("is_first"), 0).otherwise(1 << 4)
    known = (
        named.join(judged, F.col("id") == F.col("_id"), "left")
        .join(firsts, (F.col("id") == F.col("first")) & (F.col("digest") == F.col("_digest")), "left")
        .select("part", (F.col("mask") + copy).alias("mask"), F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))
    )
    no = F.lit(False)
    rest = marks.filter("id IS NULL").select("part", "mask", no.alias("good"), no.alias("toxic"))
    count = lambda c: F.sum(F.col(c).cast("bigint")).alias(c)
    return known.unionAll(rest).groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), count("good"), count("toxic"))


def walk(counts: np.ndarray) -> np.ndarray:
    """Survivors of each of the 32 filter sets; counts and survivors have the mask or set as first axis."""
    fails = np.arange(_SETS)[:, None] >> np.arange(len(FILTERS)) & 1
    failures = np.zeros(_SETS, dtype=np.int64)
    running, states = counts.sum(axis=0), np.empty_like(counts)
    states[0] = running
    active = 0
    for step in range(1, _SETS):
        number = (step & -step).bit_length() - 1
        own = fails[:, number] == 1
        active ^= 1 << number
        if active >> number & 1:
            failures[own] += 1
            running = running - counts[own & (failures == 1)].sum(axis=0)
        else:
            failures[own] -= 1
            running = running + counts[own & (failures == 0)].sum(axis=0)
        states[active] = running
    return states


_ORDERS = ["".join(p) for p in permutations(FILTERS)]
_NUMBERS = np.array([[FILTERS.index(c) for c in order] for order in _ORDERS])
_BEFORE = np.cumsum(1 << _NUMBERS, axis=1) - (1 << _NUMBERS)
_COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def steps(counts: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of each part, order and step, of cell counts (mask, part, (n, good, toxic))."""
    states, number, before = walk(counts), _NUMBERS.ravel(), _BEFORE.ravel()
    kept = states[before | 1 << number]
    lost = states[before] - kept
    failing = np.stack([counts[np.arange(_SETS) >> i & 1 == 1, :, 0].sum(axis=0) for i in range(len(FILTERS))])
    total = np.stack([lost[number == i, :, 0].sum(axis=0) for i in range(len(FILTERS))])
    found = (
        kept[..., 0],
        lost[..., 0],
        failing[number] - lost[..., 0],
        counts[1 << number, :, 0],
        lost[..., 1],
        lost[..., 2],
        total[number],
    )
    return {name: x.T.ravel() for name, x in zip(_COUNTS, found, strict=True)}


def audit(docs: DataFrame, labels: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """part, filter_order, step and the counts of every step, 600 rows for each part.

    Null texts count as empty, so they are copies of empty ones. A null source is the
    part ''. A row without an id is no copy, makes none and has no label. Of several
    labels of one id each counts, labels without an id do not. Repeated rows count
    each, and are no copies of each other. Other columns are left out. No rows give none.
    """
    grouped = cells(docs, labels, limits).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                batch = whole.slice(at, 64)
                held = batch.column("cells")
                part = np.repeat(np.arange(batch.num_rows), held.value_lengths().to_numpy())
                values = held.flatten()
                counts = np.zeros((_SETS, batch.num_rows, 3), dtype=np.int64)
                mask = values.field("mask").to_numpy()
                counts[mask, part] = np.stack([values.field(c).to_numpy() for c in ("n", "good", "toxic")], axis=1)
                every, size = len(_ORDERS) * len(FILTERS), batch.num_rows
                columns = {
                    "part": batch.column("part").take(pa.array(np.repeat(np.arange(size), every))),
                    "filter_order": pa.array(np.tile(np.repeat(_ORDERS, len(FILTERS)), size), pa.string()),
                    "step": pa.array(np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(_ORDERS) * size)),
                } | {name: pa.array(x) for name, x in steps(counts).items()}
                yield pa.RecordBatch.from_pydict(columns)

    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in _COUNTS)
    return grouped.mapInArrow(run, schema)
