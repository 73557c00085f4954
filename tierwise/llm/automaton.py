"""Weighted acyclic automata over sequences of 64-bit labels, in level arrays.

A state is the prefix that leads to it; level k holds the arcs of the k-th label, ordered by the state they
leave and then by label, with the weight of the sequence that ends there (0: none does). Arcs of the last level
all lead to one final state, so it is not stored.
"""

from __future__ import annotations

import numpy as np

from tierwise.llm.blobs import deltas, pack_arrays, unpack_arrays


class Transducer:
    def __init__(self, label: list[np.ndarray], parent: list[np.ndarray], weight: list[np.ndarray]):
        self.label, self.parent, self.weight = label, parent, weight

    @classmethod
    def from_sorted(cls, columns: list[np.ndarray], weight: np.ndarray) -> Transducer:
        """From sequences of one length in ascending order (column k: their k-th labels): each adds only the
        states after the prefix that it shares with the one before it; equal ones add their weights."""
        labels, parents, weights = [], [], []
        rows = len(weight)
        new = np.zeros(rows, bool)
        new[:1] = True
        state = np.zeros(rows, np.int64)
        for k, column in enumerate(columns):
            new = new.copy()
            new[1:] |= column[1:] != column[:-1]
            labels.append(column[new])
            parents.append(state[new])
            state = np.cumsum(new) - 1
            last = k == len(columns) - 1
            weights.append(np.add.reduceat(weight, np.flatnonzero(new)) if last and rows else np.zeros(int(new.sum()), np.int64))
        return cls(labels, parents, weights)

    @classmethod
    def union(cls, parts: list[Transducer]) -> Transducer:
        """The sequences of all parts; weights of equal ones are added."""
        labels, parents, weights = [], [], []
        state = [np.zeros(1, np.int64) for _ in parts]  # of each part's states of the level before, the union's
        for k in range(max((len(p.label) for p in parts), default=0)):
            deep = [(p, s) for p, s in zip(parts, state, strict=True) if len(p.label) > k]
            label = np.concatenate([p.label[k] for p, _ in deep])
            parent = np.concatenate([s[p.parent[k]] for p, s in deep])
            weight = np.concatenate([p.weight[k] for p, _ in deep])
            order = np.lexsort((label, parent))
            sorted_label, sorted_parent = label[order], parent[order]
            new = np.ones(len(order), bool)
            new[1:] = (sorted_label[1:] != sorted_label[:-1]) | (sorted_parent[1:] != sorted_parent[:-1])
            into = np.empty(len(order), np.int64)
            into[order] = np.cumsum(new) - 1
            labels.append(sorted_label[new])
            parents.append(sorted_parent[new])
            weights.append(np.add.reduceat(weight[order], np.flatnonzero(new)) if len(order) else weight)
            cuts = np.cumsum([len(p.label[k]) for p, _ in deep])[:-1]
            parts, state = [p for p, _ in deep], np.split(into, cuts)
        return cls(labels, parents, weights)

    def compose(self, acceptor: Transducer) -> np.ndarray:
        """Weights of the sequences that end at the last level of ``acceptor`` (0 where this automaton has none);
        both are walked together, each shared prefix once."""
        image = np.zeros(1, np.int64)
        weight = np.zeros(len(acceptor.label[-1]), np.int64)
        for k, label in enumerate(acceptor.label):
            parent = image[acceptor.parent[k]]
            image = np.full(len(label), -1, np.int64)
            if k < len(self.label) and len(self.label[k]):
                alphabet, rank = np.unique(self.label[k], return_inverse=True)
                arcs = self.parent[k] * len(alphabet) + rank
                at = np.minimum(np.searchsorted(alphabet, label), len(alphabet) - 1)
                ask = np.where((parent >= 0) & (alphabet[at] == label), parent * len(alphabet) + at, -1)
                arc = np.minimum(np.searchsorted(arcs, ask), len(arcs) - 1)
                image = np.where(arcs[arc] == ask, arc, -1)
        if len(acceptor.label) <= len(self.label):
            found = image >= 0
            weight[found] = self.weight[len(acceptor.label) - 1][image[found]]
        return weight

    def sequences(self, level: int, least: int = 1) -> tuple[list[np.ndarray], np.ndarray]:
        """(columns, weights) of the sequences of ``level`` + 1 labels whose weight is at least ``least``."""
        at = np.flatnonzero(self.weight[level] >= least)
        weight, columns = self.weight[level][at], []
        for k in range(level, -1, -1):
            columns.append(self.label[k][at])
            at = self.parent[k][at]
        return columns[::-1], weight

    def pack(self) -> bytes:
        alphabet, rank = np.unique(np.concatenate(self.label), return_inverse=True)
        ranks = np.split(rank, np.cumsum([len(x) for x in self.label])[:-1])
        body = [deltas(alphabet)]
        for r, parent, weight in zip(ranks, self.parent, self.weight, strict=True):
            body += [r, np.diff(parent, prepend=0), weight]
        return pack_arrays(body)

    @classmethod
    def unpack(cls, body: bytes) -> Transducer:
        first, *rest = unpack_arrays(body)
        alphabet = np.cumsum(first.astype(np.uint64))
        labels = [alphabet[r.astype(np.int64)] for r in rest[0::3]]
        return cls(labels, [np.cumsum(p.astype(np.int64)) for p in rest[1::3]], [w.astype(np.int64) for w in rest[2::3]])
