"""Words of Arrow text batches as numpy arrays: spans, 64-bit hashes, word n-grams.

Texts are handled as UTF-8 bytes. Every separator is an ASCII byte, so a byte
mask finds exactly the words that a regular expression over code points finds.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The white space of the contracts, space and 0x09 to 0x0D.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

CHUNK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


_held: dict[tuple, Any] = {}


def held_by_worker(make: Callable[..., Any], *args: Hashable) -> Any:
    """make(*args), kept by a Python worker for its next tasks.

    Only the last one is kept, and what was kept before goes first: Spark reuses workers, and the tables of an
    operator that has ended would stay in memory beside those of the next.
    """
    key = (make, *args)
    if key not in _held:
        _held.clear()
        pa.default_memory_pool().release_unused()
        _held[key] = make(*args)
    return _held[key]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values (an invertible finalizer)."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return values ^ (values >> np.uint64(31))


def powers(base: int, count: int) -> np.ndarray:
    """base to the powers 0 .. count-1, modulo 2**64."""
    out = np.full(max(count, 1), base & _MASK, dtype=np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=np.uint64)


def runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of runs: sizes[i] places from starts[i] on, one run after another."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def same_bytes(a: np.ndarray, a_starts: np.ndarray, a_sizes: np.ndarray, b: np.ndarray, b_starts: np.ndarray, b_sizes: np.ndarray) -> np.ndarray:
    """Whether the i-th word of one byte array is the i-th word of another; words are not empty."""
    alike = a_sizes == b_sizes
    own = np.flatnonzero(alike)
    total, at = np.cumsum(a_sizes[own]), 0
    while at < len(own):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + CHUNK_BYTES, side="right")))
        some = own[at:to]
        size = a_sizes[some]
        equal = a[runs(a_starts[some], size)] == b[runs(b_starts[some], size)]
        alike[some] = np.logical_and.reduceat(equal, np.cumsum(size) - size)
        at = to
    return alike


class Chunk:
    """Some whole texts: their bytes, word spans and the words' first index by text."""

    def __init__(self, data: np.ndarray, ends: np.ndarray, first: int, lower: bool, cuts: np.ndarray | None = None):
        separators = np.zeros(256, dtype=bool)
        separators[list(SPACES)] = True
        self.first, self.data = first, data
        gap = separators[data]
        gap_before = np.concatenate(([True], gap[:-1])) if len(gap) else gap
        starts_text = np.concatenate(([0], ends[:-1])).astype(np.int64)
        inner = starts_text[(starts_text > 0) & (starts_text < len(data))]
        gap_before[inner] = True
        gap_after = np.concatenate((gap[1:], [True])) if len(gap) else gap
        gap_after[inner - 1] = True
        if cuts is not None:
            cut = cuts[data[:-1], data[1:]]
            gap_before[1:] |= cut
            gap_after[:-1] |= cut
        self.starts = np.flatnonzero(~gap & gap_before)
        self.ends = np.flatnonzero(~gap & gap_after) + 1
        #: Words of text i: bounds[i] to bounds[i + 1].
        self.bounds = np.searchsorted(self.starts, np.concatenate(([0], ends)))
        self.texts = len(ends)
        self._lower = lower

    def hashes(self, places: np.ndarray | None = None) -> np.ndarray:
        """One 64-bit hash per word, or per word at the places."""
        starts, ends = (self.starts, self.ends) if places is None else (self.starts[places], self.ends[places])
        out = np.empty(len(starts), dtype=np.uint64)
        lengths = ends - starts
        if not len(out):
            return out
        table = powers(_BASE, int(lengths.max()))
        shift = np.arange(256, dtype=np.uint64) + np.uint64(1)
        if self._lower:
            shift[65:91] += np.uint64(32)
        at, total = 0, np.cumsum(lengths)
        while at < len(out):
            spent = total[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(total, spent + CHUNK_BYTES, side="right")))
            size = lengths[at:to]
            begin = np.cumsum(size) - size
            offset = np.arange(int(size.sum())) - np.repeat(begin, size)
            place = offset + np.repeat(starts[at:to], size)
            with np.errstate(over="ignore"):
                out[at:to] = np.add.reduceat(shift[self.data[place]] * table[offset], begin)
                out[at:to] += size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
            at = to
        return mix(out)

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """(places of one word of each kind, kind of every word); words are of a kind if their bytes are equal."""
        if not len(self.starts):
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        # Words and the gaps between them in turn, told apart as they are: a gap is empty or white space, so no word.
        edges = np.column_stack((self.starts, self.ends)).reshape(-1)
        parts = pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(self.data))])
        kind = parts.dictionary_encode().indices.to_numpy()[::2]
        # Kinds come in the order they are met in: the first word of each is where a number not yet seen stands.
        fresh = np.concatenate(([True], kind[1:] > np.maximum.accumulate(kind)[:-1]))
        number = np.zeros(int(kind.max()) + 1, dtype=np.int64)
        places = np.flatnonzero(fresh)
        number[kind[places]] = np.arange(len(places))
        return places, number[kind]

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def chunks(texts: pa.Array, lower: bool = False, size: int = CHUNK_BYTES, cuts: np.ndarray | None = None) -> Iterator[Chunk]:
    """Whole texts in chunks of about `size` bytes; one longer text is a chunk of its own.

    cuts[a, b] tells that words also end between the bytes a and b.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    filled = pc.fill_null(texts, "").cast(pa.large_string())
    if not len(filled):
        return
    offsets = np.frombuffer(filled.buffers()[1], dtype=np.int64)[filled.offset : filled.offset + len(filled) + 1]
    raw = filled.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < len(filled):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1)
        base = offsets[at]
        yield Chunk(data[base : offsets[to]], offsets[at + 1 : to + 1] - base, at, lower, cuts)
        at = to


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Rolling Rabin-Karp hash of every run of `size` words; run i starts at word i."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    base = 0xA0761D6478BD642F
    inverse = pow(base, -1, 1 << 64)
    with np.errstate(over="ignore"):
        # Prefix sums of h[j] * base**j; a run's sum, shifted back by base**-i, is its polynomial.
        prefix = np.zeros(len(hashes) + 1, dtype=np.uint64)
        np.cumsum(hashes * powers(base, len(hashes)), out=prefix[1:])
        rolled = (prefix[size:] - prefix[:-size]) * powers(inverse, count)
        return mix(rolled + np.uint64(size * 0x8EBC6AF09C88C6E3 & _MASK))
