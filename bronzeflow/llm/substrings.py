"""Removal of word passages that repeat across documents, by Rabin-Karp window hashes.

Every run of `window` words of every document is hashed. Spark takes the smallest
doc_id of each hash; a window that also starts in a document with a smaller id is
repeated, and overlapping or adjacent repeated windows merge into one interval.

Two exact steps keep the count small. Documents with the same word sequence are
folded first: all but the smallest id are covered whole. And a window's hash is
only sent to be counted if its minimizer, the least hash of its runs of
`anchor` words, occurs in two documents at least: equal windows have equal
minimizers, so a window left out occurs in one document only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bronzeflow.llm import words
from bronzeflow.workspace import materialize

WINDOW, ANCHOR = 50, 25


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of `width` values."""
    done = 1
    while done * 2 <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def minimizers(hashes: np.ndarray, window: int, anchor: int) -> np.ndarray:
    """The minimizer of the window that starts at each word."""
    runs = words.grams(hashes, anchor)
    width = window - anchor + 1
    return _least(runs, width) if len(runs) >= width else np.zeros(0, dtype=np.uint64)


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id and text; rows without an id take no part."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").filter("doc_id is not null")


def _anchors(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """doc_id, n_words, digest of the word sequence, distinct minimizers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, found = [], [], []
            for chunk in words.chunks(batch.column("text")):
                hashes = chunk.hashes()
                least = minimizers(hashes, window, anchor)
                for low, high in zip(chunk.bounds[:-1], chunk.bounds[1:], strict=True):
                    counts.append(int(high - low))
                    digests.append(_digest(hashes[low:high]))
                    found.append(np.unique(least[low : high - window + 1]).view(np.int64) if high - low >= window else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), pa.array(found, pa.list_(pa.int64()))],
                names=["doc_id", "n_words", "digest", "anchors"],
            )

    return _keyed(docs).mapInArrow(run, "doc_id bigint, n_words bigint, digest binary, anchors array<bigint>")


def _part(digest: bytes) -> int:
    """Tells rows of one id apart."""
    return int.from_bytes(digest[:4], "little", signed=True)


def _digest(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def _windows(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """doc_id, part, start, hash of each window whose minimizer is among the row's shared ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, shared = batch.column("doc_id").to_numpy(), batch.column("shared")
            for chunk in words.chunks(batch.column("text")):
                hashes = chunk.hashes()
                least, rolled = minimizers(hashes, window, anchor), words.grams(hashes, window)
                of, parts, starts, values = [], [], [], []
                for i, (low, high) in enumerate(zip(chunk.bounds[:-1], chunk.bounds[1:], strict=True)):
                    if high - low < window:
                        continue
                    mine = shared[chunk.first + i].values.to_numpy().view(np.uint64)
                    at = np.flatnonzero(np.isin(least[low : high - window + 1], mine))
                    of.append(np.full(len(at), ids[chunk.first + i], dtype=np.int64))
                    parts.append(np.full(len(at), _part(_digest(hashes[low:high])), dtype=np.int32))
                    starts.append(at.astype(np.int32))
                    values.append(rolled[low + at].view(np.int64))
                if of:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(x)) for x in (of, parts, starts, values)], names=["doc_id", "part", "start", "hash"]
                    )

    return docs.select("doc_id", "text", "shared").mapInArrow(run, "doc_id bigint, part int, start int, hash bigint")


def intervals(starts: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Sorted window starts merged into maximal half-open word intervals."""
    if not len(starts):
        return []
    breaks = np.flatnonzero(np.diff(starts) > window)
    return list(zip(starts[np.concatenate(([0], breaks + 1))].tolist(), (starts[np.concatenate((breaks, [len(starts) - 1]))] + window).tolist(), strict=True))


def repeated_windows(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> tuple[DataFrame, DataFrame]:
    """Whole copies (doc_id, digest) and, for the other rows, (doc_id, part, starts).

    A copy is a row whose words a smaller id has in full. `starts` are the first
    words of repeated windows, ascending; `part` tells rows of one id apart.
    """
    seen = materialize(_anchors(docs, window, anchor), "anchors")
    long = seen.filter(F.col("n_words") >= window)
    first = materialize(long.groupBy("digest").agg(F.min("doc_id").alias("first")), "first")
    placed = long.select("doc_id", "digest", "anchors").join(first, "digest")
    copies = materialize(placed.filter("doc_id <> first").select("doc_id", "digest").distinct(), "copies")
    # One document for each word sequence: the others have no window that starts in a larger id only.
    single = materialize(placed.filter("doc_id = first").select("doc_id", F.explode("anchors").alias("anchor")), "anchor_rows")
    shared = materialize(
        single.groupBy("anchor").agg(F.min("doc_id").alias("l"), F.max("doc_id").alias("h")).filter("l < h").select("anchor"), "shared"
    )
    wanted = materialize(single.join(shared, "anchor").groupBy("doc_id").agg(F.collect_set("anchor").alias("shared")), "wanted")
    found = materialize(_windows(_keyed(docs).join(wanted, "doc_id"), window, anchor), "windows")
    least = materialize(
        found.groupBy("hash").agg(F.min("doc_id").alias("l"), F.max("doc_id").alias("h")).filter("l < h").select("hash", "l"), "least"
    )
    starts = (
        found.join(least, "hash").filter("doc_id > l").groupBy("doc_id", "part").agg(F.sort_array(F.collect_set("start")).alias("starts"))
    )
    return copies, starts


def remove_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """docs with repeated passages cut out of `text`, and n_words, n_removed, removed (word intervals).

    A word goes if a window over it also starts in a document with a smaller
    doc_id, windows judged on the input. `text` becomes the remaining words
    joined by one space. Null and wordless texts have no words and become empty.
    Rows without an id stay whole and give no reason to remove. Rows that share
    an id are each judged by their own words against smaller ids. Columns whose
    names clash with the new ones are replaced; the others stay. No rows give none.
    """
    copies, starts = repeated_windows(docs, window, anchor)
    added = ["n_words", "n_removed", "removed"]
    frame = docs.select(*[c for c in docs.columns if c not in added])
    held = frame.columns
    by_id = starts.groupBy(F.col("doc_id").alias("_id")).agg(F.map_from_entries(F.collect_list(F.struct("part", "starts"))).alias("_starts"))
    copied = copies.groupBy(F.col("doc_id").alias("_id")).agg(F.collect_set("digest").alias("_digests"))
    marks = materialize(by_id.join(copied, "_id", "full"), "marks")
    judged = frame.withColumn("_id", F.col("doc_id").cast("bigint")).join(marks, "_id", "left").drop("_id")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema]
    schema = ", ".join([*fields, "n_words bigint, n_removed bigint, removed array<struct<start: bigint, stop: bigint>>"])
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def cuts_of(text: pa.Scalar, marked: pa.Scalar, digests: pa.Scalar, count: int) -> list[tuple[int, int]]:
        if count < window or not (marked.is_valid or digests.is_valid):
            return []
        chunk = next(words.chunks(pa.array([text.as_py()], pa.string())))
        digest = _digest(chunk.hashes())
        if digests.is_valid and digest in digests.as_py():
            return [(0, count)]
        found = dict(marked.as_py() if marked.is_valid else ()).get(_part(digest), [])
        return intervals(np.array(found, dtype=np.int64), window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, gone, spans, texts = [], [], [], []
            rows = zip(batch.column("text"), batch.column("_starts"), batch.column("_digests"), strict=True)
            for text, marked, digests in rows:
                every = (text.as_py() or "").encode().split()  # bytes split at exactly the white space of the contracts
                cuts = cuts_of(text, marked, digests, len(every))
                keep, at = [], 0
                for start, stop in [*cuts, (len(every), len(every))]:
                    keep += every[at:start]
                    at = stop
                n.append(len(every))
                gone.append(len(every) - len(keep))
                spans.append([{"start": a, "stop": b} for a, b in cuts])
                texts.append(b" ".join(keep).decode())
            new = {"text": pa.array(texts, pa.string())}
            yield pa.RecordBatch.from_arrays(
                [*(new.get(c, batch.column(c)) for c in held), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, span)],
                names=[*held, *added],
            )

    return judged.mapInArrow(run, schema)
