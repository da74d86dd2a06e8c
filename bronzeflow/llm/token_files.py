"""Token ids of documents in compact files, written in ascending doc_id order.

Ids are ranked by frequency, so the commonest get the smallest numbers, and
ranks are stored in whole bytes: one, two, three or four. The lengths, two bits
each, four to a control byte, are kept apart from the data bytes. A reader looks
all lengths up in a 256-row numpy table and gathers the bytes without branches.

A token set is a folder of Parquet files, so Spark's writers commit it on any
file system and a lost task leaves nothing behind:

  tokens/  one row per document: shard, row, doc_id, offset (ids of earlier rows
           of the shard), n_tokens, control, data
  ranks/   one row per id that occurs: id, rank
  shards/  one row per shard: shard, start (ids of all earlier shards)

Shards are ranges of doc_id in ascending order.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bronzeflow.llm.words import Chunk, chunks, held_by_worker, runs, same_bytes
from bronzeflow.workspace import BATCH_ROWS, materialize

_LENGTHS = np.array([[(byte >> 2 * i & 3) + 1 for i in range(4)] for byte in range(256)], dtype=np.uint8)


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit ranks."""
    wide = 4 if len(ranks) and int(ranks.max()) > 0xFFFF else 2
    ranks = np.ascontiguousarray(ranks, dtype=f"<u{wide}")
    codes = np.zeros(-(-len(ranks) // 4) * 4, dtype=np.uint8)
    for least in (0xFF, 0xFFFF, 0xFFFFFF)[: wide - 1]:
        codes[: len(ranks)] += ranks > least
    control = codes[0::4] | codes[1::4] << np.uint8(2) | codes[2::4] << np.uint8(4) | codes[3::4] << np.uint8(6)
    used = np.arange(wide, dtype=np.uint8) <= codes[: len(ranks), None]
    return control.tobytes(), ranks.view(np.uint8).reshape(-1, wide)[used].tobytes()


def unpack(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The `count` ranks of pack()."""
    size = _LENGTHS[np.frombuffer(control, dtype=np.uint8)].reshape(-1)[:count]
    wide = 4 if count and int(size.max()) > 2 else 2
    out = np.zeros((count, wide), dtype=np.uint8)
    out[np.arange(wide, dtype=np.uint8) < size[:, None]] = np.frombuffer(data, dtype=np.uint8)
    return out.reshape(-1).view(f"<u{wide}").astype("<u4", copy=False)


#: Bytes of text whose distinct words are looked up together, and words whose ids a Python worker keeps at most.
CHUNK = 1 << 20
KEPT_WORDS = 500_000

#: Fixed value: the split pattern of the tokenizers whose words also end between letters, digits and marks.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def cuts_of(tokenizer: dict) -> np.ndarray | None:
    """Pairs of ASCII bytes between which the tokenizer, as JSON, always cuts; None where only white space is known to.

    Left alone are apostrophes, which start endings, and the characters of added tokens.
    """
    steps = tokenizer.get("pre_tokenizer") or {}
    steps = steps.get("pretokenizers", [steps])
    if not steps or steps[0].get("type") != "Split" or steps[0].get("pattern") != {"Regex": SPLIT}:
        return None
    kind = np.zeros(256, dtype=np.uint8)
    kind[33:127] = 3
    kind[48:58] = 2
    kind[65:91] = kind[97:123] = 1
    kept = "'" + "".join(x["content"] for x in tokenizer.get("added_tokens", []))
    for char in set(kept.encode()):
        kind[char] = 0 if kind[char] == 3 else kind[char]
    both = (kind[:, None] > 0) & (kind[None, :] > 0)
    return both & ((kind[:, None] != kind[None, :]) | (kind[:, None] == 2))


#: Words of Latin letters alone: normalization leaves each one run of letters.
LETTERS = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+")
#: Words of a line that is encoded at once.
LINE = 64


def ends_of(tokenizer: dict) -> np.ndarray | None:
    """By id, whether it ends a word of letters; None where the tokenizer, as JSON, does not mark the ends or may add or drop ids.

    Each run of letters is encoded alone and its last id, no other, is one with the suffix.
    """
    model, steps = tokenizer.get("model") or {}, tokenizer.get("normalizer") or {}
    suffix = model.get("end_of_word_suffix")
    known = {"NFC", "Lowercase", "Replace"}
    plain = all(
        x.get("type") in known and (x["type"] != "Replace" or (x.get("pattern") == {"Regex": r"\s+"} and x.get("content") == " "))
        for x in steps.get("normalizers", [steps] if steps else [])
    )
    adds = any(re.fullmatch(r"[\w\s]*", x["content"]) for x in tokenizer.get("added_tokens", []))
    if cuts_of(tokenizer) is None or not plain or adds or tokenizer.get("truncation") or tokenizer.get("padding"):
        return None
    if model.get("type") != "BPE" or not suffix or model.get("dropout") or model.get("ignore_merges"):
        return None
    out = np.zeros(max(model["vocab"].values()) + 1, dtype=bool)
    out[[i for token, i in model["vocab"].items() if token.endswith(suffix)]] = True
    return out


class _Encoder:
    """Ids of whole texts, from one encoding of each distinct word.

    The tokenizer drops white space and never joins across it, nor across the cuts of
    `cuts_of`, so a text's ids are its words' ids in a row: those are gathered by offsets. Words once met are found
    again by hash, and compared. Their ids lie in `ids` from `begins` on, their bytes in `raw`; `met` marks those found again.
    """

    def __init__(self, raw: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(raw)
        told = json.loads(raw)
        self.cuts, self.ends = cuts_of(told), ends_of(told)
        self.hashes, self.slots = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        self.ids, self.raw, self.met = np.zeros(0, dtype="<u4"), np.zeros(0, dtype=np.uint8), np.zeros(0, dtype=bool)
        self.begins, self.sizes, self.raw_begins, self.raw_sizes = (np.zeros(0, dtype=np.int64) for _ in range(4))

    def _forget(self) -> None:
        """Only words found again stay, at most half of what is kept: those met first, mostly the commonest."""
        stay = np.flatnonzero(self.met)[: KEPT_WORDS // 2]
        number = np.full(len(self.met), -1, dtype=np.int64)
        number[stay] = np.arange(len(stay))
        left = number[self.slots] >= 0
        self.hashes, self.slots = self.hashes[left], number[self.slots[left]]
        self.ids = self.ids[runs(self.begins[stay], self.sizes[stay])]
        self.raw = self.raw[runs(self.raw_begins[stay], self.raw_sizes[stay])]
        self.sizes, self.raw_sizes = self.sizes[stay], self.raw_sizes[stay]
        self.begins, self.raw_begins = np.cumsum(self.sizes) - self.sizes, np.cumsum(self.raw_sizes) - self.raw_sizes
        self.met = np.zeros(len(stay), dtype=bool)

    def __call__(self, texts: pa.Array, end_id: int) -> Iterator[np.ndarray]:
        """The ids of each text and the end id, in order."""
        for chunk in chunks(texts, size=CHUNK, cuts=self.cuts):
            places, kind = chunk.distinct()
            if len(self.sizes) + len(places) > KEPT_WORDS:
                self._forget()
            slots = self._slots(chunk, places)[kind]
            sizes = self.sizes[slots]
            found = self.ids[runs(self.begins[slots], sizes)]
            stops = np.concatenate(([0], np.cumsum(sizes)))[chunk.bounds].tolist()
            end = np.array([end_id], dtype="<u4")
            for first, last in zip(stops[:-1], stops[1:], strict=True):
                yield np.concatenate((found[first:last], end))

    def _slots(self, chunk: Chunk, places: np.ndarray) -> np.ndarray:
        """Slot of each word; new words are encoded and kept."""
        slots, hashes = np.full(len(places), -1, dtype=np.int64), chunk.hashes(places)
        starts, lengths = chunk.starts[places], chunk.ends[places] - chunk.starts[places]
        at = np.searchsorted(self.hashes, hashes)
        met = np.flatnonzero(at < len(self.hashes))
        met = met[self.hashes[at[met]] == hashes[met]]
        held = self.slots[at[met]]
        equal = same_bytes(chunk.data, starts[met], lengths[met], self.raw, self.raw_begins[held], self.raw_sizes[held])
        slots[met[equal]] = held[equal]
        self.met[held[equal]] = True
        new = np.flatnonzero(slots < 0)
        if not len(new):
            return slots
        slots[new] = len(self.sizes) + np.arange(len(new))
        raw = chunk.data[runs(starts[new], lengths[new])]
        held, stops = raw.tobytes(), np.cumsum(lengths[new])
        ids, sizes = self._encoded([held[a:b].decode() for a, b in zip((stops - lengths[new]).tolist(), stops.tolist(), strict=True)])
        ends, raw_ends = np.cumsum(sizes), np.cumsum(lengths[new])
        self.begins = np.append(self.begins, len(self.ids) + ends - sizes)
        self.raw_begins = np.append(self.raw_begins, len(self.raw) + raw_ends - lengths[new])
        self.sizes, self.raw_sizes = np.append(self.sizes, sizes), np.append(self.raw_sizes, lengths[new])
        self.ids, self.raw = np.append(self.ids, ids), np.append(self.raw, raw)
        self.met = np.append(self.met, np.zeros(len(new), dtype=bool))
        # Of words that share a hash, the first met is the one that is found again.
        self.hashes, first = np.unique(np.append(self.hashes, hashes[new]), return_index=True)
        self.slots = np.append(self.slots, slots[new])[first]
        return slots

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in a row, and how many each has. Words of letters alone are encoded in lines."""
        joined = [i for i, word in enumerate(words) if LETTERS.fullmatch(word)] if self.ends is not None else []
        lines = [joined[at : at + LINE] for at in range(0, len(joined), LINE)]
        order, parts, sizes = [], [], []
        for line, ids in zip(lines, self._ids([" ".join([words[i] for i in line]) for line in lines]), strict=True):
            found = np.array(ids, dtype="<u4")
            stops = np.flatnonzero(self.ends[found]) + 1
            # As many ends as words: every word has one, which is its last id.
            if len(stops) == len(line) and stops[-1] == len(found):
                order += line
                parts.append(found)
                sizes.append(np.diff(stops, prepend=0))
        alone = np.ones(len(words), dtype=bool)
        alone[order] = False
        rest = np.flatnonzero(alone).tolist()
        found = list(self._ids([words[i] for i in rest]))
        parts.append(np.fromiter(chain.from_iterable(found), dtype="<u4"))
        sizes.append(np.fromiter(map(len, found), dtype=np.int64))
        back = np.argsort(np.array(order + rest, dtype=np.int64), kind="stable")
        size = np.concatenate(sizes).astype(np.int64)
        begins = np.cumsum(size) - size
        return np.concatenate(parts)[runs(begins[back], size[back])], size[back]

    def _ids(self, texts: list[str]) -> Iterator[list[int]]:
        for at in range(0, len(texts), 1024):
            for found in self.tokenizer.encode_batch_fast(texts[at : at + 1024], add_special_tokens=False):
                yield found.ids


def _staged(docs: DataFrame, file: str, end_id: int) -> DataFrame:
    """doc_id, tie, n_tokens and the compressed ids of each document, encoded once."""

    with open(file, "rb") as source:
        shared = docs.sparkSession.sparkContext.broadcast(source.read())  # one tokenizer file, read on the driver

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, squeeze = held_by_worker(_Encoder, shared.value), zstandard.ZstdCompressor(level=1).compress
        for batch in (whole.slice(at, 1024) for whole in batches for at in range(0, whole.num_rows, 1024)):
            counts, blobs = [], []
            for ids in encode(batch.column("text"), end_id):
                counts.append(len(ids))
                blobs.append(squeeze(ids.astype("<u2") if int(ids.max()) <= 0xFFFF else ids))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("tie"), pa.array(counts, pa.int64()), pa.array(blobs, pa.binary())],
                names=["doc_id", "tie", "n_tokens", "blob"],
            )

    return docs.mapInArrow(run, "doc_id bigint, tie bigint, n_tokens bigint, blob binary")


def _unstaged(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    expand = zstandard.ZstdDecompressor().decompress
    for blob, count in zip(batch.column("blob"), batch.column("n_tokens").to_pylist(), strict=True):
        raw = expand(blob.as_buffer())
        yield np.frombuffer(raw, dtype="<u2" if len(raw) == 2 * count else "<u4")


def id_ranks(staged: DataFrame) -> DataFrame:
    """(id, rank) of all ids of the corpus, commonest first, ties by id; at most a vocabulary of rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            held: list[np.ndarray] = []
            for i, ids in enumerate(_unstaged(batch), 1):
                held.append(ids)
                if i == batch.num_rows or len(held) == 64 or len(ids) > 1 << 16:
                    got = np.bincount(np.concatenate(held), minlength=len(total))
                    got[: len(total)] += total
                    total, held = got, []
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["id", "n"])

    counts = staged.select("n_tokens", "blob").mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    return counts.select("id", F.expr("row_number() OVER (ORDER BY n DESC, id) - 1").cast("bigint").alias("rank"))


def write_tokens(docs: DataFrame, path: str, file: str, end_id: int) -> None:
    """Encode every row of docs (doc_id, text) with the tokenizer file and write the token set to a new folder.

    Each document's ids end with end_id; a null or empty text has that id alone.
    Rows without an id come first; rows that share one are ordered by their text's
    hash. No rows give an empty token set. Other columns are left out.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("tie"), "text")
    staged = materialize(_staged(rows, file, end_id), "token_ids", BATCH_ROWS)
    id_ranks(staged).write.parquet(f"{path}/ranks")
    # At most one row for each id of the vocabulary, whatever the corpus.
    ranked = spark.read.parquet(f"{path}/ranks").toPandas()
    rank_of = np.zeros(int(ranked["id"].max()) + 1 if len(ranked) else 1, dtype=np.uint32)
    rank_of[ranked["id"].to_numpy()] = ranked["rank"].to_numpy()
    ranks = spark.sparkContext.broadcast(rank_of)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, shard, row, offset = ranks.value, TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            controls, datas = [], []
            for ids in _unstaged(batch):
                control, data = pack(table[ids])
                controls.append(control), datas.append(data)
            counts, size = batch.column("n_tokens").to_numpy(), batch.num_rows
            ends = offset + np.cumsum(counts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([shard] * size, pa.int32()),
                    pa.array(np.arange(row, row + size)),
                    batch.column("doc_id"),
                    pa.array(ends - counts),
                    batch.column("n_tokens"),
                    pa.array(controls, pa.binary()),
                    pa.array(datas, pa.binary()),
                ],
                names=["shard", "row", "doc_id", "offset", "n_tokens", "control", "data"],
            )
            row, offset = row + size, int(ends[-1]) if size else offset

    schema = "shard int, row bigint, doc_id bigint, offset bigint, n_tokens bigint, control binary, data binary"
    ordered = staged.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    ordered.select("doc_id", "n_tokens", "blob").mapInArrow(encode, schema).write.parquet(f"{path}/tokens")
    sizes = spark.read.parquet(f"{path}/tokens").groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    # One row per shard: a window over them needs no partitioning.
    starts = sizes.selectExpr("shard", "coalesce(sum(n) OVER (ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start")
    starts.write.parquet(f"{path}/shards")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, ids (array of int) and ids_crc32 of a token set; crc over little-endian 32-bit ids."""
    return _read(spark, path, True)


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of a token set: every id is decoded, none leaves its task."""
    return _read(spark, path, False)


def _read(spark: SparkSession, path: str, with_ids: bool) -> DataFrame:
    ranked = spark.read.parquet(f"{path}/ranks").toPandas()  # a vocabulary of rows at most
    id_of = np.zeros(len(ranked), dtype="<u4")
    id_of[ranked["rank"].to_numpy()] = ranked["id"].to_numpy()
    table = spark.sparkContext.broadcast(id_of)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crcs, all_ids = [], []
            for control, data, count in zip(batch.column("control"), batch.column("data"), batch.column("n_tokens"), strict=True):
                ids = table.value[unpack(control.as_buffer(), data.as_buffer(), count.as_py())]
                crcs.append(zlib.crc32(ids.tobytes()))
                if with_ids:
                    all_ids.append(ids.astype(np.int32))
            columns = [batch.column(c) for c in ("shard", "row", "doc_id", "offset", "n_tokens")] + [pa.array(crcs, pa.int64())]
            names = ["shard", "row", "doc_id", "offset", "n_tokens", "ids_crc32"]
            if with_ids:
                columns, names = [*columns, pa.array(all_ids, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "shard int, row bigint, doc_id bigint, offset bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    rows = spark.read.parquet(f"{path}/tokens").mapInArrow(decode, schema)
    shards = spark.read.parquet(f"{path}/shards")
    found = rows.join(shards, "shard").select("doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)
    return found
