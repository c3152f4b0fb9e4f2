"""Whole columns of text as numpy arrays: bytes, words and their hashes.

Everything works on UTF-8 bytes of an Arrow batch at once; Python touches no single
word. Hashes are 64-bit and the same on every machine.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from obs_engine.llm.common import worker_cache

# Multipliers of the word and n-gram hashes (odd 64-bit numbers).
BASE = 0x9E3779B97F4A7C15
MIX_1 = 0xBF58476D1CE4E5B9
MIX_2 = 0x94D049BB133111EB
SPACE = (9, 10, 11, 12, 13, 32)
CHUNK = 1 << 21


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX_1)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX_2)
    return x ^ (x >> np.uint64(31))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all values, and where each begins (with the end last); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def chunks(at: np.ndarray, size: int = CHUNK):
    """Row ranges of about ``size`` bytes, one row at least."""
    row, rows = 0, len(at) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(at, at[row] + size, "right")) - 1)
        yield row, end
        row = end


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse for i < n, modulo 2**64."""
    cache = worker_cache("powers")
    if len(cache.get("up", ())) < n:
        size = max(n, CHUNK + 65536)
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            steps = np.full(size, np.uint64(base))
            steps[0] = 1
            cache[name] = np.multiply.accumulate(steps)
    return cache["up"], cache["down"]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """P with P[e] - P[s] = hash of data[s:e] times BASE**s."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=out[1:])
    return out


def lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def spans(is_word: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each run of word bytes, and where each text's words begin."""
    edge = np.zeros(len(is_word) + 1, bool)
    edge[at] = True
    before = np.concatenate(([False], is_word[:-1])) if len(is_word) else is_word
    begin = np.flatnonzero(is_word & (~before | edge[:-1]))
    after = np.concatenate((is_word[1:], [False])) if len(is_word) else is_word
    end = np.flatnonzero(is_word & (~after | edge[1:])) + 1
    return begin, end, np.searchsorted(begin, at)


def word_hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (A-Z lower-cased, split at ASCII white space), and each text's first."""
    data = lower_table()[data]
    is_word = np.ones(256, bool)
    is_word[list(SPACE)] = False
    begin, end, first = spans(is_word[data], at)
    p = prefix_hash(data)
    _, down = powers(len(data) + 1)
    return mix((p[end] - p[begin]) * down[begin] + (end - begin).astype(np.uint64)), first


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of runs of ``size`` words; a shorter text is one run."""
    n = len(words)
    if n == 0:
        return words
    k = min(size, n)
    out = np.zeros(n - k + 1, np.uint64)
    for i in range(k):
        out = out * np.uint64(BASE) + words[i : n - k + 1 + i]
    out = mix(out + np.uint64(k))
    out.sort()
    return out[np.concatenate(([True], out[1:] != out[:-1]))]
