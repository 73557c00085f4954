"""Elias-Fano sequences over numpy arrays, and a context trie made of them, held in a mapped file.

A monotone sequence of n values below u takes about 2 + log2(u / n) bits a value: the low bits of each
value are packed, the high bits are a unary bit vector with a rank directory. All queries are vectorised
and read the packed form.
"""

from __future__ import annotations

import mmap
import tempfile

import numpy as np

_U = np.uint64


def _words(n_bits: int) -> np.ndarray:
    return np.zeros(n_bits // 64 + 2, np.uint64)


def _select_in_word(word: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Position of the rank-th (from 0) set bit of each word."""
    word, rank = word.copy(), rank.astype(np.int64)
    at = np.zeros(len(word), np.int64)
    for step in (32, 16, 8, 4, 2, 1):
        low = word & _U((1 << step) - 1)
        ones = np.bitwise_count(low).astype(np.int64)
        up = rank >= ones
        rank -= np.where(up, ones, 0)
        at += np.where(up, step, 0)
        word = np.where(up, word >> _U(step), low)
    return at


class EliasFano:
    """``parts()`` gives the arrays to store; ``EliasFano(*parts)`` reads them (also from a mapped file)."""

    def __init__(self, head: np.ndarray, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.head, self.low, self.high, self.ones = head, low, high, ones
        self.n, self.bits = int(head[0]), int(head[1])
        self.zeros = None

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64, copy=False)
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        bits = max(0, (top // max(n, 1)).bit_length() - 1)
        low = _words(n * bits)
        if bits and n:
            part = values & _U((1 << bits) - 1)
            at = np.arange(n, dtype=np.uint64) * _U(bits)
            word, shift = (at >> _U(6)).astype(np.int64), at & _U(63)
            np.bitwise_or.at(low, word, part << shift)
            over = shift + _U(bits) > _U(64)
            np.bitwise_or.at(low, word[over] + 1, part[over] >> (_U(64) - shift[over]))
        place = (values >> _U(bits)).astype(np.int64) + np.arange(n) if n else np.zeros(0, np.int64)
        high = _words(int(place[-1]) + 2 if n else 1)
        np.bitwise_or.at(high, place >> 6, _U(1) << (place & 63).astype(np.uint64))
        counts = np.bitwise_count(high).astype(np.uint64)
        ones = np.concatenate(([_U(0)], np.cumsum(counts, dtype=np.uint64)))
        return cls(np.array([n, bits], np.uint64), low, high, ones)

    def parts(self) -> list[np.ndarray]:
        return [self.head, self.low, self.high, self.ones]

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), np.uint64)
        at = i.astype(np.uint64) * _U(self.bits)
        word, shift = (at >> _U(6)).astype(np.int64), at & _U(63)
        got = self.low[word] >> shift
        more = np.where(shift > 0, self.low[word + 1] << ((_U(64) - shift) & _U(63)), _U(0))
        return (got | more) & _U((1 << self.bits) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        """Values at positions ``i`` (each below n)."""
        word = np.searchsorted(self.ones, i.astype(np.uint64), side="right") - 1
        bit = _select_in_word(self.high[word], i - self.ones[word].astype(np.int64))
        return ((word * 64 + bit - i).astype(np.uint64) << _U(self.bits)) | self._low(i)

    def _zero(self, k: np.ndarray) -> np.ndarray:
        """Position of the k-th (from 0) zero of the high bits."""
        if self.zeros is None:
            self.zeros = np.arange(len(self.ones), dtype=np.uint64) * _U(64) - self.ones
        word = np.searchsorted(self.zeros, k.astype(np.uint64), side="right") - 1
        return word * 64 + _select_in_word(~self.high[word], k - self.zeros[word].astype(np.int64))

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first position whose value is at least x, or n; whether that value equals x)."""
        x = x.astype(np.uint64, copy=False)
        if not self.n:
            return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
        high = (x >> _U(self.bits)).astype(np.int64)
        last = int(self.get(np.array([self.n - 1]))[0] >> _U(self.bits))
        beyond = high > last
        high = np.minimum(high, last)
        end = np.where(high < last, self._zero(np.minimum(high, max(last - 1, 0))) - high, self.n) if last else np.full(len(x), self.n)
        begin = np.where(high > 0, self._zero(np.maximum(high - 1, 0)) - (high - 1), 0) if last else np.zeros(len(x), np.int64)
        begin = np.where(high > 0, begin, 0)
        want = x & _U((1 << self.bits) - 1)
        lo, hi = begin.copy(), end.copy()
        while True:  # binary search over the low bits of one high part
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                break
            mid = (lo[open_] + hi[open_]) >> 1
            less = self._low(mid) < want[open_]
            lo[open_[less]] = mid[less] + 1
            hi[open_[~less]] = mid[~less]
        lo = np.where(beyond, self.n, lo)
        equal = np.zeros(len(x), bool)
        inside = np.flatnonzero(~beyond & (lo < end))
        equal[inside] = self._low(lo[inside]) == want[inside]
        return lo, equal


def quantise(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(16-bit codes, [lowest value, step])."""
    lo, hi = (float(values.min()), float(values.max())) if len(values) else (0.0, 0.0)
    step = (hi - lo) / 65535 or 1.0
    return np.rint((values - lo) / step).astype(np.uint16), np.array([lo, step])


class Level:
    """Children of the nodes above: pointers (one range for each parent) and child ids, made monotone by
    adding to each range the last value before it. Ids start at 1 and ascend within a range."""

    def __init__(self, pointers: EliasFano, ids: EliasFano):
        self.pointers, self.ids = pointers, ids

    @classmethod
    def build(cls, parents: int, parent: np.ndarray, child: np.ndarray) -> Level:
        counts = np.bincount(parent, minlength=parents)
        pointers = np.concatenate(([0], np.cumsum(counts)))
        last = child[pointers[1:][counts > 0] - 1].astype(np.uint64)
        base = np.zeros(parents, np.uint64)
        full = np.flatnonzero(counts)
        base[full] = np.concatenate(([_U(0)], np.cumsum(last)[:-1])) if len(full) else 0
        return cls(EliasFano.build(pointers), EliasFano.build(child.astype(np.uint64) + base[parent]))

    def find(self, parent: np.ndarray, child: np.ndarray, portion: int = 1 << 17) -> np.ndarray:
        """Node number of each (parent, child id), or -1: successor search relative to the parent's range.
        Questions are answered in portions, which bounds the working arrays."""
        out = np.full(len(parent), -1, np.int64)
        for a in range(0, len(parent) if self.ids.n else 0, portion):
            p, c = parent[a : a + portion], child[a : a + portion]
            begin, end = self.pointers.get(p).astype(np.int64), self.pointers.get(p + 1).astype(np.int64)
            base = np.where(begin > 0, self.ids.get(np.maximum(begin - 1, 0)), _U(0))
            at, equal = self.ids.successor(c.astype(np.uint64) + base)
            ok = equal & (at >= begin) & (at < end)
            out[a : a + portion][ok] = at[ok]
        return out

    def parts(self) -> list[np.ndarray]:
        return [*self.pointers.parts(), *self.ids.parts()]


def mapped(arrays: list[np.ndarray]) -> tuple[list[np.ndarray], mmap.mmap]:
    """Read-only views of the arrays in an anonymous temporary file (it has no name, so nothing stays)."""
    with tempfile.TemporaryFile() as f:
        places = []
        for a in arrays:
            f.write(b"\0" * (-f.tell() % 8))
            places.append((f.tell(), a.dtype, len(a)))
            f.write(np.ascontiguousarray(a).data)
        f.write(b"\0" * 8)
        f.flush()
        view = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
    return [np.frombuffer(view, t, n, at) for at, t, n in places], view


class Trie:
    """Words, the words before them, and the words before those, with quantised values.

    ``words`` and ``contexts`` are ascending names; node values: two at levels 1 and 2, one at level 3."""

    def __init__(self, arrays: list[np.ndarray]):
        self.arrays, self.file = mapped(arrays)
        a = self.arrays
        self.words, self.contexts = EliasFano(*a[0:4]), EliasFano(*a[4:8])
        self.second = Level(EliasFano(*a[8:12]), EliasFano(*a[12:16]))
        self.third = Level(EliasFano(*a[16:20]), EliasFano(*a[20:24]))
        self.values = [(a[i], a[i + 1]) for i in range(24, 34, 2)]

    @classmethod
    def build(cls, words, contexts, second, third, values) -> Trie:
        """``second``: (word index, context id from 1) and ``third``: (second-level node, context id from 1),
        each in ascending order. ``values``: [num1, den1, num2, den2, num3]."""
        arrays = [*EliasFano.build(words).parts(), *EliasFano.build(contexts).parts()]
        arrays += Level.build(len(words), *second).parts() + Level.build(len(second[0]), *third).parts()
        for v in values:
            arrays += quantise(v)
        return cls(arrays)

    def value(self, which: int, node: np.ndarray) -> np.ndarray:
        codes, (lo, step) = self.values[which]
        return lo + step * codes[node]
