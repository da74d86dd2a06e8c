"""Toxicity by compression distance: two zstandard dictionaries, one per kind of text.

A window of text is compressed twice, once with a dictionary trained on ordinary
text and once with that dictionary followed by one trained on toxic text. What
the toxic one saves is the window's distance; without toxic material the two
lengths hardly differ. Thresholded distances of all windows of a document are
put together by weights calibrated on labelled documents that trained neither
dictionary.

A toxic document is mostly ordinary text. So the toxic training text is its
stretches of byte n-grams, and its stretches of word pairs, that far more toxic
than ordinary documents contain. There are two kinds of windows, both lower-cased:
each word, in a fixed frame of ordinary text (zstandard stores very short inputs
raw, and the frame pays for the first match), and runs of words that overlap by
half. Runs show abuse made of ordinary words, whose pairs then save bytes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace
from functools import cached_property
from itertools import chain, compress, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bronzeflow.llm.words import held_by_worker, mix, runs
from bronzeflow.workspace import materialize

#: Words whose distances a Python worker keeps at most.
CACHED_WORDS = 250_000
#: Bytes of text whose words are looked up together, and windows that one call compresses.
PIECE = 1 << 19
WINDOWS = 1 << 15


@dataclass(frozen=True)
class Settings:
    """Training rows kept per class, dictionary bytes, n-gram length, contrast, compression level.

    The classifier is fitted on at most sample_rows rows of each class, those with the smallest hashes of their id.
    Byte n-grams and word pairs in less than least_share of the toxic training rows are never learned, nor are those
    whose share there is not `contrast` times that among the ordinary ones. The ordinary dictionary is trained on
    ordinary_windows runs of eight words, evenly spaced in the sample, where it has more. A run is a window of `run` words.
    """

    sample_rows: int = 3000
    ordinary_bytes: int = 8192
    toxic_bytes: int = 1536
    pair_bytes: int = 1536
    ordinary_windows: int = 60_000
    gram: int = 5
    run: int = 8
    run_level: int = 3
    least_share: float = 0.02
    contrast: float = 10.0
    level: int = 6
    frame: int = 24
    cut: float = 0.7


@dataclass(frozen=True)
class Model:
    """The dictionaries' bytes, settings of the windows, calibration weights."""

    ordinary: bytes
    toxic: bytes
    pairs: bytes
    settings: Settings
    weights: tuple[float, ...] = ()

    @cached_property
    def _pair(self) -> tuple:
        level = self.settings.level
        return _compressor(self.ordinary, level), _compressor(self.ordinary + self.toxic, level)

    @cached_property
    def _run_pair(self) -> tuple:
        level = self.settings.run_level
        return _compressor(self.ordinary, level), _compressor(self.ordinary + self.toxic + self.pairs, level)

    def distances(self, words: list[bytes]) -> list[int]:
        """Bytes that the toxic dictionary saves on each framed word."""
        at, frame = len(self.ordinary) // 40, self.settings.frame
        before, after = self.ordinary[at : at + frame] + b" ", b" " + self.ordinary[at + 2 * frame : at + 3 * frame]
        out: list[int] = []
        for first in range(0, len(words), WINDOWS):
            windows = [before + word + after for word in words[first : first + WINDOWS]]
            sizes = np.fromiter(map(len, windows), dtype=np.int64)
            out += _saved(self._pair, b"".join(windows), np.cumsum(sizes) - sizes, sizes).tolist()
        return out

    def run_distances(self, joined: bytes, sizes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes that the toxic dictionaries save on each run of words, and the runs of each text.

        joined has the words of all texts with one space between them, sizes the words' bytes, counts the words of each text.
        """
        size = self.settings.run
        step = size // 2
        ends = np.cumsum(sizes + 1) - 1
        begins = ends - sizes
        of_text = -(-np.maximum(1, counts - step) // step)
        last = np.repeat(np.cumsum(counts), of_text)
        first = runs(np.zeros(len(counts), dtype=np.int64), of_text) * step + np.repeat(np.cumsum(counts) - counts, of_text)
        starts, stops = begins[first], ends[np.minimum(first + size, last) - 1]
        parts = [slice(i, i + WINDOWS) for i in range(0, len(first), WINDOWS)]
        return np.concatenate([_saved(self._run_pair, joined, starts[p], stops[p] - starts[p]) for p in parts]), of_text

    def features(self, texts: list[str | None], known: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
        """(places of the texts that have words, thresholded distances of their windows, a row for each)."""
        words = [(text or "").encode().lower().split() for text in texts]
        held = np.flatnonzero([len(every) for every in words])
        if not len(held):
            return held, np.zeros((0, 0))
        new = list(set(chain.from_iterable(words)).difference(known))
        if len(known) + len(new) > CACHED_WORDS:
            # The first words met are mostly the commonest. Those of these texts are needed now, whatever their number.
            for word in list(islice(known, CACHED_WORDS // 3, None)):
                del known[word]
            new = list(set(chain.from_iterable(words)).difference(known))
        known.update(zip(new, self.distances(new), strict=True))
        counts = np.array([len(words[i]) for i in held])
        every = list(chain.from_iterable(words))
        d = np.fromiter(map(known.__getitem__, every), dtype=np.float64, count=len(every))
        r, of_text = self.run_distances(b" ".join(every), np.fromiter(map(len, every), dtype=np.int64, count=len(every)), counts)
        # Distances are whole numbers, so their sums are exact in any order.
        at = np.cumsum(counts) - counts
        size = np.log(2.0 + counts)
        above = [np.add.reduceat(np.maximum(d - t, 0), at) for t in (0, 1, 2, 3)]
        of_words = [*(x / counts for x in above), *(np.log1p(x) for x in above[1:]), np.maximum.reduceat(d, at), np.add.reduceat(d >= 3, at, dtype=np.int64) / size]
        at = np.cumsum(of_text) - of_text
        above = [np.add.reduceat(np.maximum(r - t, 0), at) for t in (0, 2, 4, 8)]
        of_runs = [*(x / of_text for x in above), *(np.log1p(x) for x in above), np.maximum.reduceat(r, at), np.add.reduceat(r >= 6, at, dtype=np.int64) / size]
        return held, np.column_stack([*of_words, *of_runs, size, np.ones(len(held))])

    def score(self, text: str | None, known: dict[bytes, int]) -> float:
        return float(self.scores([text], known)[0])

    def scores(self, texts: list[str | None], known: dict[bytes, int]) -> np.ndarray:
        """0 to 1 for each text; 0 without words."""
        out = np.zeros(len(texts))
        if self.weights:
            held, found = self.features(texts, known)
            if len(held):
                out[held] = 1 / (1 + np.exp(-np.clip((found * np.array(self.weights)).sum(axis=1), -40, 40)))
        return out


def _saved(pair: tuple, data: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """What the second compressor of a pair saves over the first on each of the spans of data, as floats."""
    spans = np.column_stack((starts, sizes)).astype("<u8").tobytes()
    lengths = []
    for compressor in pair:
        packed = compressor.multi_compress_to_buffer(zstandard.BufferWithSegments(data, spans), threads=1)
        lengths.append(np.fromiter(map(len, packed), dtype=np.float64, count=len(starts)))
    return lengths[0] - lengths[1]


def _pieces(texts: pa.Array) -> Iterator[pa.Array]:
    """Texts in row order, some at a time: about PIECE bytes, or one longer text."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    total, at = np.cumsum(sizes, dtype=np.int64), 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PIECE, side="right")))
        yield texts.slice(at, to - at)
        at = to


def _compressor(dictionary: bytes, level: int):
    held = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    parameters = zstandard.ZstdCompressionParameters.from_level(
        level, source_size=64, dict_size=len(dictionary), write_content_size=False, write_checksum=False, write_dict_id=False
    )
    return zstandard.ZstdCompressor(dict_data=held, compression_params=parameters)


def _trained(samples: list[bytes], size: int, **kind: int) -> bytes:
    """Content of a dictionary trained on the samples; of too few, the samples themselves."""
    try:
        return zstandard.train_dictionary(size, samples, **kind).as_bytes()[-size * 7 // 8 :]
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _commonest(samples: list[bytes], size: int) -> bytes:
    """The most frequent samples up to a size, the commonest last, where matches cost least.

    A trained dictionary would cut them into segments of one length.
    """
    chosen: list[bytes] = []
    for sample, _ in Counter(samples).most_common():
        if sum(map(len, chosen)) + len(chosen) + len(sample) > size:
            break
        chosen.append(sample)
    return b" " + b" ".join(reversed(chosen)) if chosen else b""


def _codes(text: bytes, gram: int) -> np.ndarray:
    """One integer per byte n-gram of at most 8 bytes."""
    data = np.frombuffer(text, dtype=np.uint8).astype(np.uint64)
    count = max(0, len(data) - gram + 1)
    out = np.zeros(count, dtype=np.uint64)
    for i in range(gram):
        out = (out << np.uint64(8)) | data[i : i + count]
    return out


def _distinct(codes: np.ndarray) -> np.ndarray:
    """Sorted, each once; on short arrays of 64-bit integers many times faster than np.unique."""
    codes = np.sort(codes)
    return codes[np.diff(codes, prepend=~codes[:1]) != 0]


def _blocks(arrays: Iterable[np.ndarray], size: int) -> Iterator[np.ndarray]:
    """The arrays one after another, about `size` numbers at a time."""
    waiting: list[np.ndarray] = []
    count = 0
    for some in arrays:
        waiting.append(some)
        count += len(some)
        if count >= size:
            yield np.concatenate(waiting)
            waiting, count = [], 0
    if waiting:
        yield np.concatenate(waiting)


def _buckets(texts: list[bytes]) -> int:
    """A power of two, so that a bucket has about eight of the texts' n-grams."""
    return 1 << max(16, (sum(map(len, texts)) >> 3).bit_length())


def _tally(places: Iterable[np.ndarray], size: int) -> np.ndarray:
    """How many of the places are each of the `size` buckets: nothing occurs more often than its bucket."""
    out = np.zeros(size, dtype=np.int64)
    for block in _blocks(places, size >> 2):
        out += np.bincount(block, minlength=size)
    return out


def _common_codes(texts: list[bytes], gram: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(sorted n-grams that at least so many texts hold, in how many of them).

    Only n-grams of full buckets are gathered: the distinct ones of all texts would take many times the texts' memory.
    """
    size = _buckets(texts)
    places = lambda codes: (mix(codes) & np.uint64(size - 1)).astype(np.int64)
    full = _tally((places(_codes(t, gram)) for t in texts), size) >= least
    found = np.zeros(0, dtype=np.uint64)
    for block in _blocks((codes[full[places(codes)]] for codes in (_codes(t, gram) for t in texts)), size >> 2):
        found = _distinct(np.concatenate((found, block)))
    counts = _texts_with(found, texts, gram)
    return found[counts >= least], counts[counts >= least]


def _texts_with(codes: np.ndarray, texts: list[bytes], gram: int) -> np.ndarray:
    """In how many of the texts each of the sorted n-grams occurs."""
    out = np.zeros(len(codes), dtype=np.int64)
    for text in texts if len(codes) else ():
        held = _distinct(_codes(text, gram))
        at = np.minimum(np.searchsorted(codes, held), len(codes) - 1)
        out[at[codes[at] == held]] += 1
    return out


def _stretches(text: bytes, marked: np.ndarray, gram: int) -> list[bytes]:
    """Maximal runs of marked n-grams, with a byte on either side."""
    hit = np.concatenate(([False], np.isin(_codes(text, gram), marked), [False]))
    edges = np.flatnonzero(np.diff(hit.astype(np.int8)))
    return [text[max(0, a - 1) : b + gram] for a, b in edges.reshape(-1, 2).tolist()]


def _pairs(text: bytes) -> list[tuple[bytes, bytes]]:
    """Distinct pairs of neighbouring words."""
    words = text.split()
    return list(set(zip(words, words[1:], strict=False)))


def _marked_pairs(toxic: list[bytes], ordinary: list[bytes], settings: Settings) -> set[tuple[bytes, bytes]]:
    """Pairs of neighbouring words that far more toxic than ordinary documents hold; only those of full buckets are kept and counted."""
    least, size = max(2, settings.least_share * len(toxic)), _buckets(toxic)
    places = lambda pairs: np.fromiter(map(hash, pairs), dtype=np.int64, count=len(pairs)) & (size - 1)
    full = _tally((places(_pairs(t)) for t in toxic), size) >= least
    counts = Counter(chain.from_iterable(compress(pairs, full[places(pairs)].tolist()) for pairs in map(_pairs, toxic)))
    common = {p for p, n in counts.items() if n >= least}
    base = Counter(p for text in ordinary for p in common.intersection(_pairs(text)))
    return {p for p in common if counts[p] / len(toxic) > settings.contrast * (base[p] + 0.5) / len(ordinary)}


def _pair_stretches(text: bytes, marked: set[tuple[bytes, bytes]]) -> list[bytes]:
    """Maximal runs of words whose neighbouring pairs are all marked."""
    words = text.split()
    hit = np.array([False, *(p in marked for p in zip(words, words[1:], strict=False)), False], dtype=np.int8)
    edges = np.flatnonzero(np.diff(hit))
    return [b" ".join(words[a : b + 1]) for a, b in edges.reshape(-1, 2).tolist()]


def fit(rows: list[tuple[str, int]], settings: Settings = Settings()) -> Model:
    """A model of (text, label) rows, label 1 for toxic. Without both labels every score is 0."""
    parts: dict[tuple[int, bool], list[bytes]] = {(label, held): [] for label in (0, 1) for held in (False, True)}
    seen: Counter[int] = Counter()
    for text in dict.fromkeys((t, y) for t, y in rows if t and t.strip()):
        # Two of three rows train the dictionaries, the third calibrates.
        parts[text[1], seen[text[1]] % 3 == 2].append(text[0].encode().lower())
        seen[text[1]] += 1
    ordinary, toxic = parts[0, False], parts[1, False]
    if not (ordinary and toxic):
        return Model(b"", b"", b"", settings)
    # Texts are split again for each step: the words and n-grams of all of them would take far more of the driver's memory.
    codes, counts = _common_codes(toxic, settings.gram, max(2, settings.least_share * len(toxic)))
    base = _texts_with(codes, ordinary, settings.gram)
    marked = codes[counts / len(toxic) > settings.contrast * (base + 0.5) / len(ordinary)]
    found = [s for t in toxic for s in _stretches(t, marked, settings.gram)]
    marked_pairs = _marked_pairs(toxic, ordinary, settings)
    stretches = [s for t in toxic for s in _pair_stretches(t, marked_pairs)]
    step = max(1, sum(-(-len(t.split()) // 8) for t in ordinary) // settings.ordinary_windows)
    windows = (b" ".join(w[i : i + 8]) for w in (t.split() for t in ordinary) for i in range(0, len(w), 8))
    groups = [b"".join(found[i : i + 6]) for i in range(0, len(found), 6)]
    model = Model(
        _trained(list(islice(windows, 0, None, step)), settings.ordinary_bytes),
        _trained(groups, settings.toxic_bytes, k=24, d=6) if groups else b"",
        _commonest(stretches, settings.pair_bytes),
        settings,
    )
    held = [(t, y) for y in (0, 1) for t in parts[y, True] or parts[y, False]]
    known: dict[bytes, int] = {}
    texts = pa.array([t for t, _ in held], pa.binary()).cast(pa.large_string())
    x = np.concatenate([model.features(piece.to_pylist(), known)[1] for piece in _pieces(texts)])
    weights = _calibrated(x, np.array([y for _, y in held], dtype=np.float64), settings.cut)
    return replace(model, weights=tuple(weights.tolist()))


def _calibrated(x: np.ndarray, y: np.ndarray, cut: float) -> np.ndarray:
    """Ridge logistic weights, shifted so that the best cut of the calibration rows has score `cut`."""
    scale = np.concatenate((x[:, :-1].std(axis=0) + 1e-9, [1.0]))
    z, w = x / scale, np.zeros(x.shape[1])
    ridge = np.full(len(w), 0.3)
    ridge[-1] = 1e-6
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        slope = z.T @ (p - y) + ridge * w
        bend = (z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(ridge)
        move = np.linalg.solve(bend, slope)
        w -= move * min(1.0, 5.0 / (np.abs(move).max() + 1e-9))
    logits = z @ w
    order = np.sort(np.unique(logits))
    cuts = np.concatenate(([order[0] - 1], (order[1:] + order[:-1]) / 2, [order[-1] + 1]))
    wrong = np.array([((logits >= c) != (y == 1)).sum() for c in cuts])
    best = cuts[wrong == wrong.min()]
    w = w / scale
    w[-1] += np.log(cut / (1 - cut)) - best[len(best) // 2]
    return w


def labelled_ids(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, label) of the documents that have the label 0 or 1, written; an id with both has two rows."""
    named = labels.select("doc_id", F.col(label).cast("int").alias("label")).filter("label in (0, 1)").distinct()
    return materialize(named.join(docs.select("doc_id").distinct(), "doc_id"), "labelled")


def sampled_ids(named: DataFrame, bound: int) -> DataFrame:
    """At most `bound` ids of each label, those with the smallest hashes.

    Only hashes below twice the bound's share can be among them, so few rows are sorted.
    """
    hashed = named.withColumn("_h", F.xxhash64("doc_id"))
    counts = {r["label"]: r["count"] for r in named.groupBy("label").count().collect()}  # two rows at most
    parts = []
    for y in (0, 1):
        span = min(1.0, (2 * bound + 100) / max(1, counts.get(y, 0)))
        most = int(-(1 << 63) + span * ((1 << 64) - 1))
        near = hashed.filter((F.col("label") == y) & (F.col("_h") <= F.lit(min(most, (1 << 63) - 1))))
        parts.append(near.orderBy("_h", "doc_id").limit(bound).select("doc_id", "label"))
    return materialize(parts[0].unionAll(parts[1]), "sampled")


def labelled_sample(docs: DataFrame, chosen: DataFrame) -> list[tuple[str, int]]:
    """Rows (text, label) of the chosen ids, one for each id and label.

    The ids are few, so they go to the texts. Of several texts of an id the first in
    order counts. Rows come by label and hash, whatever the partitions.
    """
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    rows = found.withColumn("_h", F.xxhash64("doc_id")).collect()  # at most the bound for each label
    return [(r["text"], r["label"]) for r in sorted(rows, key=lambda r: (r["label"], r["_h"], r["doc_id"]))]


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", settings: Settings = Settings()) -> Model:
    """Fit on labels (doc_id, label column) of docs (doc_id, text); other columns have no part in it.

    An id labelled both 0 and 1 counts once for each. Labels without an id or document do not count.
    """
    return fit(labelled_sample(docs, sampled_ids(labelled_ids(docs, labels, label), settings.sample_rows)), settings)


def _table(model: Model) -> dict[bytes, int]:
    return {}


def _distances(model: Model) -> dict[bytes, int]:
    """A Python worker's table, of the model it scored with last."""
    return held_by_worker(_table, model)


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """docs with score (0 to 1, higher: toxic likelier) of each whole text.

    Null, empty and wordless texts score 0. Repeated rows score alike. A column
    named score is replaced; the other columns stay. No rows give none.
    """
    frame = docs.select(*[c for c in docs.columns if c != "score"])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        known = _distances(own)
        for batch in (whole.slice(at, 1024) for whole in batches for at in range(0, whole.num_rows, 1024)):
            scores = [own.scores(piece.to_pylist(), known) for piece in _pieces(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(scores), pa.float64())], names=[*batch.schema.names, "score"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema]
    return frame.mapInArrow(run, ", ".join([*fields, "score double"]))
