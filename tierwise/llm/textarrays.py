"""Whole-array text helpers for the operators that run on Arrow batches (numpy, no per-word Python).

Words are runs of bytes other than space and \\t \\n \\v \\f \\r in the UTF-8 text, with A-Z lower-cased.
A word is named by a 64-bit polynomial hash of its bytes (mixed at the end). Two words share a name
with probability about 2^-64; results that count words by name are exact up to that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CODE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose every output bit depends on every input bit."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


_STEP = 1024


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i for i < 1024, and base^(1024 k) for as many k as cover n: base^j is the product of two entries."""
    low = np.full(_STEP, base, dtype=np.uint64)
    low[0] = 1
    high = np.full(-(-n // _STEP), pow(base, _STEP, 1 << 64), dtype=np.uint64)
    high[:1] = 1
    return np.multiply.accumulate(low), np.multiply.accumulate(high)


def word_arrays(texts: list[bytes], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words in order, number of words of each text)."""
    if not texts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    starts, ends = _word_bounds(data)
    low, high = _powers(int(_BASE), len(data))
    sums = np.zeros(len(high) * _STEP, np.uint64)
    np.take(_CODE, _LOWER[data] if lower else data, out=sums[: len(data)], mode="clip")
    grid = sums.reshape(-1, _STEP)  # one row for each step, so the powers need no array of the text's length
    grid *= low
    grid *= high[:, None]
    np.cumsum(sums, out=sums)
    low, high = _powers(pow(int(_BASE), -1, 1 << 64), len(data))
    before = np.where(starts > 0, sums[starts - 1], np.uint64(0))
    hashes = mix((sums[ends - 1] - before) * low[starts % _STEP] * high[starts // _STEP])
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    counts = np.diff(np.searchsorted(starts, np.concatenate(([0], np.cumsum(lengths)))))
    return hashes, counts


def _word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    space = _SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edge = np.concatenate(([0], edge))
    return edge[0::2], edge[1::2]  # the data end with a space, so every word is closed


def slices(batches: Iterator[pa.RecordBatch], max_bytes: int = 3 << 20) -> Iterator[tuple[list, list[bytes]]]:
    """(ids, UTF-8 texts) of consecutive rows, about ``max_bytes`` of text at a time (one longer text
    stands alone). Batches have the id in their first and the text in their second column; null: empty."""
    ids, texts, held = [], [], 0
    for batch in batches:
        names = batch.column(0).to_pylist()
        body = batch.column(1).cast(pa.binary())
        for i, name in enumerate(names):
            text = body[i].as_py() or b""
            if texts and held + len(text) > max_bytes:
                yield ids, texts
                ids, texts, held = [], [], 0
            ids.append(name)
            texts.append(text)
            held += len(text) + 1
    if texts:
        yield ids, texts


def shingles(hashes: np.ndarray, counts: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes, number of shingles of each text); a text with fewer words than ``size`` is one
    shingle of all its words, a text without words has none."""
    n = len(counts)
    ends = np.cumsum(counts)
    starts = ends - counts
    owner = np.repeat(np.arange(n), counts)
    position = np.arange(len(hashes)) - starts[owner]
    full = position + size <= counts[owner]
    short = (counts[owner] < size) & (position == 0)
    out = np.zeros(len(hashes), np.uint64)
    for j in range(size):
        at = np.minimum(np.arange(len(hashes)) + j, max(len(hashes) - 1, 0))
        inside = position + j < counts[owner]
        out = mix(out * np.uint64(3) + np.where(inside, hashes[at], np.uint64(0)) + np.uint64(j + 1)) if len(out) else out
    keep = full | short
    return out[keep], np.bincount(owner[keep], minlength=n).astype(np.int64)
