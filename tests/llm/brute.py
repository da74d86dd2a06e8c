"""Plain Python versions of the operators' contracts."""

from __future__ import annotations

import hashlib
import re
import zlib

import duckdb

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table(sf_dir: str, name: str) -> list[dict]:
    rel = duckdb.sql(f"SELECT * FROM '{sf_dir}/{name}.parquet'")
    return [dict(zip(rel.columns, row, strict=True)) for row in rel.fetchall()]


def words(text, pattern=SPACE, lower=False):
    text = text or ""
    return pattern.findall(text.translate(_LOWER) if lower else text)


def shingles(text, size):
    every = words(text, lower=True)
    return {tuple(every[i : i + size]) for i in range(len(every) - size + 1)} or ({tuple(every)} if every else set())


def components(docs, size, percent):
    """(set size, smallest index reachable) for texts in order."""
    sets = [shingles(t, size) for t in docs]
    low = list(range(len(docs)))

    def root(i):
        while low[i] != i:
            i = low[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                a, b = sorted((root(i), root(j)))
                low[b] = a
    return [(len(x), root(i)) for i, x in enumerate(sets)]


def without_repeats(docs, window=50):
    """Kept words of (doc_id, text) rows."""
    first = {}
    for doc_id, text in docs:
        every = words(text)
        for i in range(len(every) - window + 1):
            key = tuple(every[i : i + window])
            first[key] = min(first.get(key, doc_id), doc_id)
    out = []
    for doc_id, text in docs:
        every, gone = words(text), set()
        for i in range(len(every) - window + 1):
            if first[tuple(every[i : i + window])] < doc_id:
                gone.update(range(i, i + window))
        out.append([w for i, w in enumerate(every) if i not in gone])
    return out


def hits(text, items, window=10):
    """Positions hit and ids of the items met, of (item_id, text) items."""
    every = words(text, ALNUM, lower=True)
    spots, met = set(), set()
    for item_id, item in items:
        own = words(item, ALNUM, lower=True)
        size = min(window, len(own))
        for i in range(len(own) - size + 1 if size else 0):
            for j in range(len(every) - size + 1):
                if every[j : j + size] == own[i : i + size]:
                    spots.update(range(j, j + size))
                    met.add(str(item_id))
    return every, spots, sorted(met)


def token_rows(docs, tokenizer, end_id=2):
    """(doc_id, start, n_tokens, crc) of (doc_id, text) rows in ascending order."""
    import numpy as np

    out, start = [], 0
    for doc_id, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, end_id]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
