"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A text is cut into words, runs of spaces with what follows them: no piece of the
vocabulary reaches across such a cut, so the words are merged independently. The
distinct words of some texts lie one after another in flat arrays of symbols. In
each round every word finds the best rank among its neighbouring pairs, all its
pairs of that rank are merged at once from the left, and the arrays are compacted;
words without a pair leave, and the rounds end when none is left.

Merging at once equals merging one by one as long as no new pair ranks as well as
the merged one. Where a word has several such pairs and a new one would (runs of
spaces do this: their pieces all have one score), its merges are taken one by one
from a heap instead.
"""

from __future__ import annotations

import codecs
import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from bronzeflow.llm.words import mix, powers

#: Fixed value: the mark that stands for a space in pieces.
SPACE = 0x2581

#: Code points that are encoded together; a longer text is cut between words.
CHUNK = 1 << 20

_NONE = np.iinfo(np.int32).max
_BASE = 0xD1342543DE82EF95


@dataclass(frozen=True)
class Vocabulary:
    """A BPE vocabulary as arrays.

    Symbols are all pieces and characters that merges can meet, and one more for any
    other character. `symbol_of` maps a code point to its symbol, `id_of` a symbol to
    its id, or -1 where its bytes stand for it. `keys` are the sorted pairs (left *
    symbols + right) that join to a piece, with its rank, best first, and symbol.
    """

    symbol_of: np.ndarray
    id_of: np.ndarray
    keys: np.ndarray
    ranks: np.ndarray
    joined: np.ndarray
    byte_ids: np.ndarray
    spelled: bytes
    spelled_ends: np.ndarray
    silent: np.ndarray
    leading: np.ndarray

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and symbol of each pair; _NONE where it joins to no piece."""
        if not len(self.keys):
            return np.full(len(left), _NONE, dtype=np.int32), np.zeros(len(left), dtype=np.int32)
        key = left.astype(np.int64) * len(self.id_of) + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE).astype(np.int32), self.joined[at]

    @cached_property
    def pairs(self) -> dict[int, tuple[int, int]]:
        return dict(zip(self.keys.tolist(), zip(self.ranks.tolist(), self.joined.tolist(), strict=True), strict=True))


def vocabulary(pieces: list[tuple[str, float]], ids: list[int], byte_ids: list[int], size: int, special: dict[int, str] | None = None) -> Vocabulary:
    """Of mergeable (piece, score) with their ids, the ids of the 256 bytes, and what other ids decode to."""
    names = [p for p, _ in pieces]
    symbol = {p: i for i, p in enumerate(names)}
    for char in sorted({c for p in names for c in p} - set(names)):
        symbol[char] = len(symbol)
    other = len(symbol)
    symbol_of = np.full(0x110000, other, dtype=np.int32)
    for piece, at in symbol.items():
        if len(piece) == 1:
            symbol_of[ord(piece)] = at
    id_of = np.full(other + 1, -1, dtype=np.int32)
    id_of[: len(ids)] = ids
    order = {score: rank for rank, score in enumerate(sorted({s for _, s in pieces}, reverse=True))}
    found = [
        (symbol[p[:cut]] * (other + 1) + symbol[p[cut:]], order[score], symbol[p])
        for p, score in pieces
        for cut in range(1, len(p))
        if p[:cut] in symbol and p[cut:] in symbol
    ]
    table = np.array(sorted(found), dtype=np.int64).reshape(-1, 3)
    spelled = [b""] * size
    for i, text in (special or {}).items():
        spelled[i] = text.encode()
    silent = np.array([not s for s in spelled])
    for byte, i in enumerate(byte_ids):
        spelled[i], silent[i] = bytes([byte]), False
    leading = np.zeros(size, dtype=bool)
    for piece, i in zip(names, ids, strict=True):
        spelled[i], silent[i], leading[i] = piece.replace(chr(SPACE), " ").encode(), False, ord(piece[0]) == SPACE
    return Vocabulary(
        symbol_of,
        id_of,
        table[:, 0].copy(),
        table[:, 1].astype(np.int32),
        table[:, 2].astype(np.int32),
        np.array(byte_ids, dtype=np.int32),
        b"".join(spelled),
        np.cumsum([len(s) for s in spelled]),
        silent,
        leading,
    )


def load(file: str) -> Vocabulary:
    """The vocabulary of a sentencepiece BPE model file.

    ValueError for models this encoding does not cover: other normalizations than a
    space in front and marks for spaces, no byte pieces, user-defined or unused
    pieces, pieces with a space after another character.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=file)
    every = range(model.vocab_size())
    names = [model.id_to_piece(i) for i in every]
    special = {i for i in every if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i)}
    usual = [i for i in every if i not in special]
    byte_ids = {names[i]: i for i in special if model.is_byte(i)}
    mark = chr(SPACE)
    probe = " a  ﬁ①É\t　b "
    if model.normalize(probe) != mark + probe.replace(" ", mark):
        raise ValueError("the model normalizes its texts")
    if len(byte_ids) != 256 or any(model.is_unused(i) for i in every):
        raise ValueError("the model has no byte pieces or unused ones")
    # User-defined pieces, and at most the best of the learned ones, have score 0.
    if any(mark in names[i].lstrip(mark) for i in usual) or sum(model.get_score(i) == 0 for i in usual) > 1:
        raise ValueError("the model has user-defined pieces or pieces that go on after a space")
    return vocabulary(
        [(names[i], model.get_score(i)) for i in usual],
        usual,
        [byte_ids[f"<0x{b:02X}>"] for b in range(256)],
        len(names),
        {model.unk_id(): model.decode([model.unk_id()])},
    )


def _by_heap(symbols: list[int], places: list[int], held: Vocabulary) -> tuple[list[int], list[int]]:
    """All merges of one word, the best pair first and of equals the leftmost."""
    size, pairs = len(held.id_of), held.pairs
    after, before = list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1))
    alive, open_pairs = [True] * len(symbols), []

    def offer(i: int) -> None:
        if 0 <= i and after[i] < len(symbols) and (found := pairs.get(symbols[i] * size + symbols[after[i]])):
            heapq.heappush(open_pairs, (found[0], i, symbols[i], symbols[after[i]], found[1]))

    for i in range(len(symbols)):
        offer(i)
    while open_pairs:
        _, i, left, right, merged = heapq.heappop(open_pairs)
        j = after[i]
        if not alive[i] or j >= len(symbols) or symbols[i] != left or symbols[j] != right:
            continue
        symbols[i], alive[j], after[i] = merged, False, after[j]
        if after[i] < len(symbols):
            before[after[i]] = i
        offer(before[i])
        offer(i)
    kept = [i for i, a in enumerate(alive) if a]
    return [symbols[i] for i in kept], [places[i] for i in kept]


def merge(symbols: np.ndarray, lengths: np.ndarray, held: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of lengths[i] symbols each, fully merged: word, symbol and first place of each symbol left."""
    word, at, sym = np.repeat(np.arange(len(lengths)), lengths), np.arange(len(symbols)), symbols.copy()
    rank, joined = np.full(len(sym), _NONE, dtype=np.int32), np.zeros(len(sym), dtype=np.int32)
    inner = np.flatnonzero(word[1:] == word[:-1])
    rank[inner], joined[inner] = held.look_up(sym[inner], sym[inner + 1])
    done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(sym):
        starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
        best, sizes = np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(sym)))
        if (best == _NONE).any():
            left = np.repeat(best == _NONE, sizes)
            done.append((word[left], sym[left], at[left]))
            word, at, sym, rank, joined = (x[~left] for x in (word, at, sym, rank, joined))
            sizes, best = sizes[best != _NONE], best[best != _NONE]
        if not len(sym):
            break
        hit = np.flatnonzero(rank == np.repeat(best, sizes))
        # Of pairs that overlap, every second one from the left.
        fresh = np.concatenate(([True], np.diff(hit) != 1))
        chosen = hit[(hit - hit[fresh][np.cumsum(fresh) - 1]) % 2 == 0]
        if (one_by_one := _unsafe(chosen, word, sym, rank, joined, held)).size:
            heaped = np.isin(word, one_by_one)
            for w in one_by_one.tolist():
                own = np.flatnonzero(word == w)
                merged, places = _by_heap(sym[own].tolist(), at[own].tolist(), held)
                done.append((np.full(len(merged), w), np.array(merged, dtype=sym.dtype), np.array(places)))
            word, at, sym, rank, joined = (x[~heaped] for x in (word, at, sym, rank, joined))
            continue
        sym[chosen] = joined[chosen]
        keep = np.ones(len(sym), dtype=bool)
        keep[chosen + 1] = False
        word, at, sym, rank, joined = (x[keep] for x in (word, at, sym, rank, joined))
        here = chosen - np.arange(len(chosen))
        changed = np.unique(np.concatenate((here, here[here > 0] - 1)))
        rank[changed] = _NONE
        changed = changed[changed + 1 < len(sym)]
        changed = changed[word[changed] == word[changed + 1]]
        rank[changed], joined[changed] = held.look_up(sym[changed], sym[changed + 1])
    if not done:
        return word, sym, at
    word, sym, at = (np.concatenate(x) for x in zip(*done, strict=True))
    order = np.argsort(word, kind="stable")
    return word[order], sym[order], at[order]


def _unsafe(chosen: np.ndarray, word: np.ndarray, sym: np.ndarray, rank: np.ndarray, joined: np.ndarray, held: Vocabulary) -> np.ndarray:
    """Words with several chosen pairs, one of which would make a pair of its own rank or a better one."""
    own = word[chosen]
    again = own[1:] == own[:-1]
    several = chosen[np.concatenate((again, [False])) | np.concatenate(([False], again))]
    if not len(several):
        return several
    made, limit = joined[several], rank[several]
    bad = np.zeros(len(several), dtype=bool)
    # A neighbour on the left is already merged when it is chosen itself, one on the right is not.
    merged = sym.copy()
    merged[chosen + 1] = joined[chosen]
    has = several > 0
    has[has] = word[several[has] - 1] == word[several[has]]
    bad[has] = held.look_up(merged[several[has] - 1], made[has])[0] <= limit[has]
    has = several + 2 < len(sym)
    has[has] = word[several[has] + 2] == word[several[has]]
    bad[has] |= held.look_up(made[has], sym[several[has] + 2])[0] <= limit[has]
    return np.unique(word[several[bad]])


def _gathered(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of runs: sizes[i] places from starts[i] on, one run after another."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - sizes - starts, sizes)


def _encode_points(points: np.ndarray, firsts: np.ndarray, held: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of marked code points, and their number by word; a word starts at each space after another character and at firsts."""
    mark = points == SPACE
    start = mark & np.concatenate(([True], ~mark[:-1]))
    start[firsts] = True
    starts = np.flatnonzero(start)
    lengths = np.diff(np.append(starts, len(points)))
    inside = np.arange(len(points)) - np.repeat(starts, lengths)
    with np.errstate(over="ignore"):
        value = (points.astype(np.uint64) + np.uint64(1)) * powers(_BASE, int(lengths.max()))[inside]
        hashes = mix(np.add.reduceat(value, starts) + lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, example, which = np.unique(hashes, return_index=True, return_inverse=True)
    # Words that share a hash with another word stay on their own.
    alike = lengths == lengths[example[which]]
    place = np.minimum(np.repeat(starts[example[which]], lengths) + inside, len(points) - 1)
    alike &= np.logical_and.reduceat(points == points[place], starts)
    odd = np.flatnonzero(~alike)
    which[odd] = len(example) + np.arange(len(odd))
    example = np.concatenate((example, odd))
    own = _gathered(starts[example], lengths[example])
    word, sym, at = merge(held.symbol_of[points[own]], lengths[example], held)
    ids = held.id_of[sym]
    spelled = np.flatnonzero(ids < 0)
    if len(spelled):
        utf8 = [chr(c).encode() for c in points[own][at[spelled]].tolist()]
        sizes = np.ones(len(ids), dtype=np.int64)
        sizes[spelled] = [len(u) for u in utf8]
        ids, word, many = np.repeat(ids, sizes), np.repeat(word, sizes), np.repeat(ids < 0, sizes)
        ids[many] = held.byte_ids[np.frombuffer(b"".join(utf8), dtype=np.uint8)]
    counts = np.bincount(word, minlength=len(example))
    return ids[_gathered((np.cumsum(counts) - counts)[which], counts[which])], counts[which]


def encode(texts: list[str], held: Vocabulary) -> list[np.ndarray]:
    """Ids of each whole text, without end marks; an empty text has none."""
    out: list[np.ndarray] = []
    block: list[str] = []
    size = 0
    for text in [*texts, None]:
        if text is None or size + len(text) > CHUNK:
            out += _encode_block(block, held)
            block, size = [], 0
        if text is not None:
            block.append(text)
            size += len(text)
    return out


def _encode_block(texts: list[str], held: Vocabulary) -> list[np.ndarray]:
    sizes = np.array([len(t) + 1 if t else 0 for t in texts], dtype=np.int64)
    if not sizes.sum():
        return [np.zeros(0, dtype=np.int32) for _ in texts]
    points = np.frombuffer("".join(chr(SPACE) + t for t in texts if t).encode("utf-32-le"), dtype="<u4").copy()
    points[points == 0x20] = SPACE
    if len(texts) == 1 and len(points) > 2 * CHUNK:
        parts, at = [], 0
        while at < len(points):
            to = at + CHUNK
            if to < len(points):
                # Only where a space follows another character may a text be cut.
                later = np.flatnonzero((points[to:] == SPACE) & (points[to - 1 : -1] != SPACE))
                to = to + int(later[0]) if len(later) else len(points)
            parts.append(_encode_points(points[at:to], np.array([0]), held)[0])
            at = to
        return [np.concatenate(parts)]
    firsts = (np.cumsum(sizes) - sizes)[sizes > 0]
    ids, counts = _encode_points(points, firsts, held)
    mark = points == SPACE
    start = mark & np.concatenate(([True], ~mark[:-1]))
    start[firsts] = True
    ends = np.concatenate(([0], np.cumsum(counts)))
    cuts = ends[np.concatenate(([0], np.cumsum(start)))[np.concatenate(([0], np.cumsum(sizes)))]]
    return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _each_byte(error: UnicodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("each_byte", _each_byte)


def decode(ids: np.ndarray, held: Vocabulary) -> str:
    """Text of ids: pieces with spaces for marks, without the space in front; each byte that is no UTF-8 gives U+FFFD."""
    if len(ids) and int(ids.min()) < 0:
        raise IndexError("ids are not negative")
    ids = ids[~held.silent[ids]]
    sizes = np.diff(np.concatenate(([0], held.spelled_ends)))[ids]
    raw = np.frombuffer(held.spelled, dtype=np.uint8)[_gathered(held.spelled_ends[ids] - sizes, sizes)]
    if len(ids) and held.leading[ids[0]]:
        raw = raw[1:]
    return raw.tobytes().decode(errors="each_byte")


def _extended(docs: DataFrame, name: str, kind: str) -> tuple[DataFrame, str]:
    frame = docs.select(*[c for c in docs.columns if c != name])
    return frame, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema), f"{name} {kind}"])


def encode_pieces(docs: DataFrame, file: str, end_id: int | None = None) -> DataFrame:
    """docs (text) with ids, array of int: those of the whole text, then end_id.

    Null and empty texts have the end id alone. Repeated rows are encoded alike. A
    column named ids is replaced; the other columns stay. No rows give none.
    """
    frame, schema = _extended(docs, "ids", "array<int>")
    shared = docs.sparkSession.sparkContext.broadcast(load(file))  # one vocabulary
    end = np.array([] if end_id is None else [end_id], dtype=np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            # Some rows at a time bound the ids held in memory.
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                found = [np.concatenate((x, end)) for x in encode([t or "" for t in batch.column("text").to_pylist()], shared.value)]
                offsets = np.concatenate(([0], np.cumsum([len(x) for x in found]))).astype(np.int32)
                ids = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(found), pa.int32()))
                yield pa.RecordBatch.from_arrays([*batch.columns, ids], names=[*batch.schema.names, "ids"])

    return frame.mapInArrow(run, schema)


def decode_pieces(rows: DataFrame, file: str) -> DataFrame:
    """rows (ids) with decoded, the text of each row's ids.

    Null ids count as none; ids outside the vocabulary and null elements are an error,
    as in the library. A column named decoded is replaced; the other columns stay. No
    rows give none.
    """
    frame, schema = _extended(rows, "decoded", "string")
    shared = rows.sparkSession.sparkContext.broadcast(load(file))  # one vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, dtype=np.int32)
        for batch in batches:
            texts = [decode(x.values.to_numpy() if x.is_valid else none, shared.value) for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])

    return frame.mapInArrow(run, schema)
