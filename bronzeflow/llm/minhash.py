"""Near-duplicate documents by b-bit MinHash.

A document is the set of its distinct word shingles. One pass gives each
document the minima of many permutations; bands of whole minima find candidates,
the low bits of all minima are packed into bit planes and estimate the
similarity with the chance collisions taken out, and full sets confirm links.

Documents with equal sets form one node, so copies are never compared. Each
bucket has one hub, its most central node, and in a round each node is compared
with the one hub that it shares most buckets with. What is still in more than one component after these rounds is settled by an exact
prefix join: two sets of similarity t share a shingle among the rarest ones of
each. So no bucket is expanded into all its pairs, and none is cut off.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bronzeflow.llm import words
from bronzeflow.llm.components import components
from bronzeflow.workspace import BATCH_ROWS, materialize


@dataclass(frozen=True)
class NearDedup:
    """Shingle length, linking threshold in percent, bands by rows, kept bits."""

    shingle: int = 5
    percent: int = 80
    bands: int = 36
    rows: int = 6
    bits: int = 4
    star_rounds: int = 2
    seed: int = 11

    @property
    def most_differing(self) -> int:
        """Differing minima up to which a pair is confirmed on full sets.

        Low bits agree by chance too: a similarity t shows as c + (1 - c) t
        agreeing minima. The limit is 4.5 standard errors under the threshold.
        """
        chance, t, count = 0.5**self.bits, self.percent / 100, self.bands * self.rows
        match = chance + (1 - chance) * t
        return int(count * (1 - match) + 4.5 * (count * match * (1 - match)) ** 0.5)


#: Rare shingles that a row of the prefix join remembers; any number gives the same pairs.
EARLIER = 64

FEATURES = "doc_id bigint, row_key bigint, row bigint, n_shingles bigint, node binary, bands array<bigint>, planes array<bigint>"


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a shorter text is one shingle, no words give none."""
    for chunk in words.chunks(texts, lower=True):
        hashes = chunk.hashes()
        runs = words.grams(hashes, size)
        for low, high in zip(chunk.bounds[:-1], chunk.bounds[1:], strict=True):
            if high - low >= size:
                yield np.unique(runs[low : high - size + 1])
            else:
                yield words.grams(hashes[low:high], int(high - low)) if high > low else np.zeros(0, dtype=np.uint64)


def fingerprint(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


class _Signer:
    def __init__(self, settings: NearDedup):
        rng = np.random.default_rng(settings.seed)
        self.s, count = settings, settings.bands * settings.rows
        self.a = (rng.integers(0, 1 << 32, count, dtype=np.uint32) | np.uint32(1))[:, None]
        self.b = rng.integers(0, 1 << 32, count, dtype=np.uint32)[:, None]
        self.weights = words.mix(np.arange(1, settings.rows + 1, dtype=np.uint64))
        self.marks = words.mix(np.arange(1, settings.bands + 1, dtype=np.uint64) << np.uint64(32))

    def minima(self, shingles: np.ndarray) -> np.ndarray:
        short = (shingles >> np.uint64(32)).astype(np.uint32)
        low = np.full(len(self.a), 0xFFFFFFFF, dtype=np.uint32)
        for at in range(0, len(short), 1024):
            low = np.minimum(low, (self.a * short[None, at : at + 1024] + self.b).min(axis=1))
        return low

    def bands(self, low: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            sums = (low.reshape(self.s.bands, self.s.rows).astype(np.uint64) * self.weights).sum(axis=1, dtype=np.uint64)
            return words.mix(sums + self.marks).view(np.int64)

    def planes(self, low: np.ndarray) -> np.ndarray:
        """The low bits of all minima: for each bit a row of packed 64-bit words."""
        padded = np.zeros(-(-len(low) // 64) * 64, dtype=np.uint32)
        padded[: len(low)] = low
        rows = [np.packbits(padded >> np.uint32(bit) & np.uint32(1) != 0) for bit in range(self.s.bits)]
        return np.concatenate(rows).view(np.int64)


def features(docs: DataFrame, settings: NearDedup) -> DataFrame:
    """One row per document: set size, set fingerprint (node), band values, bit planes; node is null without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = words.held_by_worker(_Signer, settings)
        for batch in batches:
            n, nodes, bands, planes = [], [], [], []
            for shingles in shingle_sets(batch.column("text"), settings.shingle):
                n.append(len(shingles))
                if not len(shingles):
                    nodes.append(None), bands.append(None), planes.append(None)
                    continue
                low = signer.minima(shingles)
                nodes.append(fingerprint(shingles))
                bands.append(signer.bands(low))
                planes.append(signer.planes(low))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("row_key"),
                    batch.column("row"),
                    pa.array(n, pa.int64()),
                    pa.array(nodes, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(planes, pa.list_(pa.int64())),
                ],
                names=["doc_id", "row_key", "row", "n_shingles", "node", "bands", "planes"],
            )

    return keyed(docs).mapInArrow(run, FEATURES)


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text, a key to find a row again and a hash that tells rows of one id apart; rows without an id are found by their text."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.xxhash64("text")).alias("row_key"),
        F.xxhash64("text").alias("row"),
        "text",
    )


def differing(a: str, b: str, settings: NearDedup) -> Column:
    """Number of minima whose low bits differ, from the packed words of two columns."""
    width = -(-settings.bands * settings.rows // 64)
    total = F.lit(0)
    for word in range(width):
        bits = [F.get(a, F.lit(plane * width + word)).bitwiseXOR(F.get(b, F.lit(plane * width + word))) for plane in range(settings.bits)]
        any_bit = bits[0]
        for bit in bits[1:]:
            any_bit = any_bit.bitwiseOR(bit)
        total = total + F.bit_count(any_bit)
    return total


def similarity(a: str, b: str, settings: NearDedup) -> Column:
    """Estimated similarity of two columns of packed words, with chance agreement taken out."""
    chance = 0.5**settings.bits
    match = 1 - differing(a, b, settings) / (settings.bands * settings.rows)
    return (match - chance) / (1 - chance)


def _sets(docs: DataFrame, wanted: DataFrame, settings: NearDedup) -> DataFrame:
    """(node, shingles) of the wanted (node, row_key): sorted 8-byte hashes of one document per node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sets = [], []
            for node, shingles in zip(batch.column("node").to_pylist(), shingle_sets(batch.column("text"), settings.shingle), strict=True):
                if fingerprint(shingles) == node:
                    nodes.append(node)
                    sets.append(shingles.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(sets, pa.binary())], names=["node", "shingles"])

    found = keyed(docs).join(wanted, "row_key").select("node", "text").mapInArrow(run, "node binary, shingles binary")
    # Rows that repeat an id with the same text give equal sets; one is enough.
    return found.groupBy("node").agg(F.any_value("shingles").alias("shingles"))


def _confirmed(pairs: DataFrame, sets: DataFrame, settings: NearDedup) -> DataFrame:
    """Those of the pairs (a, b) whose full sets reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                x = np.frombuffer(left.as_buffer(), dtype=np.uint64)
                y = np.frombuffer(right.as_buffer(), dtype=np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= settings.percent * (len(x) + len(y) - both))
            kept = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(kept), batch.column("b").filter(kept)], names=["a", "b"])

    joined = (
        pairs.select("a", "b")
        .join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a")), "a")
        .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b")), "b")
    )
    return joined.select("a", "b", "set_a", "set_b").mapInArrow(run, "a binary, b binary")


def _prefixes(sets: DataFrame, labels: DataFrame, settings: NearDedup) -> DataFrame:
    """Rarest shingles of each set: node, label, size, shingle, at, long (whether only in the longer prefix).

    Rarity is the number of the given sets that hold a shingle. Sets of
    similarity t, of sizes m <= n, share a shingle among the first
    m - 2t/(1+t) m + 1 of the smaller and n - t n + 1 of the larger one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, label, raw in zip(batch.column("node"), batch.column("label"), batch.column("shingles"), strict=True):
                values = np.frombuffer(raw.as_buffer(), dtype=np.int64)
                count = len(values)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([node.as_py()] * count, pa.binary()),
                        pa.array([label.as_py()] * count, pa.binary()),
                        pa.array(np.full(count, count, dtype=np.int64)),
                        pa.array(values),
                    ],
                    names=["node", "label", "size", "shingle"],
                )

    opened = materialize(sets.join(labels, "node").select("node", "label", "shingles").mapInArrow(run, "node binary, label binary, size bigint, shingle bigint"), "opened", BATCH_ROWS)
    common = materialize(
        opened.groupBy("shingle").agg(F.count(F.lit(1)).alias("held")).filter("held > 1"), "common"
    )
    # A shingle that no other set holds comes first in any case: only the others need their place.
    ranked = (
        opened.join(common, "shingle")
        .groupBy("node", "label", "size")
        .agg(F.sort_array(F.collect_list(F.struct("held", "shingle"))).alias("shared"))
    )
    keep = settings.percent
    last = F.expr(f"int(size - ceil({keep} * size / 100.0) + 1)")
    last_small = F.expr(f"int(size - ceil({2 * keep} * size / {100.0 + keep}) + 1)")
    return (
        ranked.select("node", "label", "size", (F.col("size") - F.size("shared")).alias("alone"), F.posexplode("shared").alias("i", "s"))
        .select("node", "label", "size", (F.col("alone") + F.col("i")).alias("at"), F.col("s.shingle").alias("shingle"))
        .filter(F.col("at") < last)
        .withColumn("small", F.col("at") < last_small)
    )


def _prefix_pairs(prefixes: DataFrame, planes: DataFrame, settings: NearDedup) -> DataFrame:
    """Pairs of different components that a shared rare shingle, sizes, places and low bits allow: a, b.

    A pair comes from the first rare shingle it shares. Each row knows the
    ``EARLIER`` shingles before its own; a pair that shares one of them has come
    from there. What lies further back gives the pair again, which distinct drops.
    """
    mixed = prefixes.groupBy("shingle").agg(F.min("label").alias("l"), F.max("label").alias("h")).filter("l <> h").select("shingle")
    rows = materialize(prefixes.join(mixed, "shingle", "left_semi").join(planes, "node"), "prefixes")
    before = Window.partitionBy("node").orderBy("at").rowsBetween(-EARLIER, -1)
    rows = materialize(rows.withColumn("earlier", F.collect_list("shingle").over(before)), "earlier")
    names = ("node", "label", "size", "at", "planes", "earlier")
    x = rows.select(*[F.col(c).alias(f"{c}_x") for c in names], "shingle")
    y = rows.filter("small").select(*[F.col(c).alias(f"{c}_y") for c in names], F.col("shingle").alias("shingle_y"))
    t = settings.percent
    allowed = f"""shingle = shingle_y AND label_x <> label_y
        AND (size_y < size_x OR (size_y = size_x AND node_y < node_x))
        AND 100 * size_y >= {t} * size_x
        AND (100 + {t}) * (least(size_x - at_x, size_y - at_y) + least(at_x, at_y)) >= {t} * (size_x + size_y)"""
    alike = differing("planes_x", "planes_y", settings) <= settings.most_differing
    first = ~F.arrays_overlap("earlier_x", "earlier_y")
    return x.join(y, F.expr(allowed) & alike & first).select(F.col("node_x").alias("a"), F.col("node_y").alias("b")).distinct()


def near_components(docs: DataFrame, settings: NearDedup = NearDedup()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs (doc_id, text, others ignored).

    component_id is the smallest doc_id reachable over links, the document's own
    included; kept says that doc_id is it. A null or wordless text has an empty
    set, is linked with nothing and is its own component. Rows without an id take
    part; their component_id is the smallest id reached, null if there is none,
    and they are not kept. Repeated rows give repeated rows. No rows give no rows.
    """
    return _grouped(docs, settings).select(
        "doc_id", "n_shingles", F.col("component").alias("component_id"), _kept("doc_id", "component").alias("kept")
    )


def _grouped(docs: DataFrame, settings: NearDedup) -> DataFrame:
    """doc_id, row, n_shingles, component, label of every row; label is the same for linked rows alone, null without words."""
    found = materialize(features(docs, settings), "signatures", BATCH_ROWS)
    nodes = materialize(
        found.filter("node is not null")
        .groupBy("node")
        .agg(F.min("row_key").alias("row_key"), F.any_value("bands").alias("bands"), F.any_value("planes").alias("planes")),
        "nodes",
    )
    rows = nodes.select("node", F.explode("bands").alias("bucket"))
    full = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("held")).filter("held > 1")
    full = materialize(full, "full")
    member = materialize(rows.join(full, "bucket"), "members")
    central = materialize(member.groupBy("node").agg(F.sum("held").alias("weight")), "central")
    member = materialize(member.select("bucket", "node").join(central, "node"), "members")
    wanted = nodes.select("node", "row_key").join(central, "node", "left_semi")
    sets = materialize(_sets(docs, wanted, settings), "sets", BATCH_ROWS)
    planes = nodes.select("node", "planes")

    labels, tested = None, None
    for _ in range(settings.star_rounds):
        own = member if labels is None else _open(member, labels)
        hubs = materialize(
            own.groupBy("bucket").agg(F.max(F.struct("weight", "node")).alias("hub")).select("bucket", F.col("hub.node").alias("hub")), "hubs"
        )
        shared = own.join(hubs, "bucket").filter("node <> hub").groupBy(F.col("node").alias("a"), F.col("hub").alias("b"))
        shared = shared.agg(F.count(F.lit(1)).alias("shared"))
        if tested is not None:
            shared = shared.join(tested, ["a", "b"], "left_anti")
        # The hub that a node shares most buckets with: one candidate for each node and round.
        most = shared.groupBy("a").agg(F.max(F.struct("shared", "b")).alias("most"))
        pairs = materialize(most.select("a", F.col("most.b").alias("b")), "pairs")
        seen = (
            pairs.join(planes.withColumnsRenamed({"node": "a", "planes": "planes_a"}), "a")
            .join(planes.withColumnsRenamed({"node": "b", "planes": "planes_b"}), "b")
        )
        near = seen.filter(differing("planes_a", "planes_b", settings) <= settings.most_differing).select("a", "b")
        new = materialize(_confirmed(near, sets, settings), "links", BATCH_ROWS)
        tested = pairs if tested is None else tested.union(pairs)
        labels = _labels(central, new, labels)
    opened = _open(member, labels).select("node", "label").distinct()
    rest = _prefix_pairs(_prefixes(sets, materialize(opened, "open"), settings), planes, settings)
    labels = _labels(central, materialize(_confirmed(materialize(rest, "rest"), sets, settings), "links", BATCH_ROWS), labels)

    of_node = found.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("low")).join(labels, "node", "left")
    of_node = of_node.select("node", "low", F.coalesce("label", "node").alias("label"))
    of_node = materialize(of_node, "lows")
    lows = of_node.groupBy("label").agg(F.min("low").alias("component"))
    by_node = materialize(of_node.join(lows, "label").select("node", "component", "label"), "component_ids")
    linked = found.filter("node is not null").select("doc_id", "row", "n_shingles", "node").join(by_node, "node")
    empty = found.filter("node is null").select("doc_id", "row", "n_shingles", F.col("doc_id").alias("component"), F.lit(None).cast("binary").alias("label"))
    return linked.select("doc_id", "row", "n_shingles", "component", "label").union(empty)


def _kept(doc_id: str, component: str) -> Column:
    return F.coalesce(F.col(doc_id) == F.col(component), F.lit(False))


def _labels(nodes: DataFrame, links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(node, label) for all the nodes; one without links is its own label.

    With known labels only the new links between different labels are followed.
    """
    if known is None:
        labels = components(links)
        named = nodes.select("node").join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("label"))
        return materialize(named, "labels")
    between = (
        links.join(known.withColumnsRenamed({"node": "a", "label": "label_a"}), "a")
        .join(known.withColumnsRenamed({"node": "b", "label": "label_b"}), "b")
        .filter("label_a <> label_b")
    )
    merged = components(between.select(F.col("label_a").alias("a"), F.col("label_b").alias("b")))
    merged = merged.select(F.col("node").alias("label"), F.col("label").alias("low"))
    return materialize(known.join(merged, "label", "left").select("node", F.coalesce("low", "label").alias("label")), "labels")


def _open(member: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of buckets that still hold more than one component, with labels."""
    named = materialize(member.select("bucket", "node", "weight").join(labels, "node"), "named")
    split = named.groupBy("bucket").agg(F.min("label").alias("l"), F.max("label").alias("h")).filter("l <> h").select("bucket")
    return named.join(materialize(split, "split"), "bucket", "left_semi")


def drop_near_duplicates(docs: DataFrame, settings: NearDedup = NearDedup()) -> DataFrame:
    """docs with one row for each component, its smallest doc_id; all columns stay.

    Rows without words or without an id stay. Different texts that share an id are
    judged each on its own; of linked ones with the smallest id, that of the smallest
    text hash stays. Repeated rows give one row. Written docs are expected: they are read twice.
    """
    linked = materialize(_grouped(docs, settings).filter("doc_id is not null and label is not null").select("doc_id", "row", "label"), "grouped")
    first = linked.groupBy("label").agg(F.min(F.struct("doc_id", "row")).alias("first")).select("first.*")
    dropped = linked.select("doc_id", "row").distinct().join(materialize(first, "first"), ["doc_id", "row"], "left_anti")
    dropped = materialize(dropped.select(F.col("doc_id").alias("_id"), F.col("row").alias("_row")), "dropped")
    key = [F.col("doc_id").cast("bigint").alias("_id"), F.xxhash64("text").alias("_row")]
    keys = ["_id", "_row"]
    rows = docs.select("*", *key)
    stay = rows.join(dropped, keys, "left_anti")
    clean = F.col("_id").isNotNull() & F.coalesce(F.regexp_like("text", F.lit(r"[^\x20\x09-\x0D]")), F.lit(False))
    twice = materialize(rows.filter(clean).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*keys), "repeated")
    if twice.isEmpty():
        return stay.select(*docs.columns)
    again = stay.filter(clean).join(twice, keys, "left_semi").dropDuplicates(keys)
    once = stay.filter(clean).join(twice, keys, "left_anti")
    return stay.filter(~clean).select(*docs.columns).union(once.select(*docs.columns)).union(again.select(*docs.columns))
