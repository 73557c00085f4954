"""Language-model scores of whole texts with an Elias-Fano n-gram trie.

The model mixes counts: with w the token, v and u the two before it,

    P(w | u, v) = (c(u,v,w) + m2 c(v,w) + m1 P1(w)) / (c(u,v) + m2 c(v) + m1)

where P1 is the unigram distribution with absolute discounting (the discount from the numbers of words
seen once and twice), whose freed mass is the probability of an unknown word. It sums to one over the
vocabulary and one unknown word. Its logarithm is a numerator that depends on w and what precedes it,
and a denominator that depends on v and what precedes it, so one exchange by word is enough: all
occurrences of a word, with the two tokens before each, meet in the shard of that word.

1. Unigram counts over all training documents give totals, the discount, and the frequent words (more
   than a quarter of a shard: at most 4 x shards of them, sent to every task with their counts).
2. Portions of documents are dealt to shards by word; frequent words are split further by the word before.
3. A shard counts its n-grams over the training documents, builds its part of the trie in a memory-mapped
   file (Elias-Fano pointers and ids, 16-bit quantised log values) and answers the n-grams of all
   documents by successor search relative to the context.
4. Sums for each document go back to the document's portion and are added there.

Words are named by 64-bit hashes. Defined cases: a null text counts as empty and is one end token; rows without an
id are held out; repeated rows count and are
returned each; without training documents every probability is one; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwise.llm.blobs import deltas, pack_arrays, press, unpack_arrays, unpress
from tierwise.llm.common import read_table, stage, width
from tierwise.llm.eliasfano import Trie
from tierwise.llm.textarrays import slices, word_arrays

END, START = np.uint64(1), np.uint64(2)  # names of the end of a text and of what precedes its first word


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(names of all tokens, tokens of each text): the words, then the end."""
    h, n = word_arrays(texts)
    ends = np.cumsum(n + 1) - 1
    out = np.empty(len(h) + len(n), np.uint64)
    inner = np.ones(len(out), bool)
    inner[ends] = False
    out[ends] = END
    out[inner] = np.maximum(h, np.uint64(3))
    return out, n + 1


def in_training(ids: list, fold: int, folds: int) -> np.ndarray:
    return np.fromiter((i is not None and zlib.crc32(str(i).encode()) % folds != fold for i in ids), bool, len(ids))


def unigrams(docs: DataFrame, doc_id: str, text: str, fold: int, folds: int) -> DataFrame:
    """name, n over the training documents; each task sends a word once for every portion of text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> pa.RecordBatch:
            names, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(n)], ["name", "n"])

        for ids, texts in slices(batches, 2 << 20):
            t, n = tokens(texts)
            t = t[np.repeat(in_training(ids, fold, folds), n)]
            held.append(t)
            size += len(t)
            if size > 4_000_000:
                yield out()
                held, size = [], 0
        if size:
            yield out()

    rows = docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(run, "name long, n long")
    return rows.groupBy("name").agg(F.sum("n").alias("n"))


def deal(ids, t, n, train, shards: int, hot: np.ndarray) -> list[tuple[int, bytes]]:
    """(shard, body) of a portion: t are all tokens, n the tokens of each document."""
    first = np.cumsum(n) - n
    owner = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(t)) - first[owner]
    v = np.where(place > 0, np.roll(t, 1), START)
    u = np.where(place > 1, np.roll(t, 2), START)
    top = t >> np.uint64(32)
    if len(hot):
        at = np.minimum(np.searchsorted(hot, t), len(hot) - 1)
        top = np.where(hot[at] == t, (v * np.uint64(0x9E3779B97F4A7C15) ^ t * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32), top)
    shard = (top * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
    order = np.lexsort((t, shard))
    t, v, u, owner, shard = t[order], v[order], u[order], owner[order], shard[order]
    cuts = np.flatnonzero(np.diff(shard, prepend=-1))
    out = []
    for a, b in zip(cuts, [*cuts[1:], len(shard)], strict=True):
        words, w_at = np.unique(t[a:b], return_inverse=True)
        names, c_at = np.unique(np.concatenate([v[a:b], u[a:b]]), return_inverse=True)
        body = [deltas(words), deltas(names), w_at, c_at[: b - a], c_at[b - a :], owner[a:b], train]
        if a == 0:  # the document table travels once
            signed = np.array([0 if i is None else i for i in ids], np.int64)
            body += [signed.view(np.uint64), np.array([i is None for i in ids]), n]
        out.append((int(shard[a]), pack_arrays(body)))
    return out


class Totals:
    """What the shards need from the unigram counts."""

    def __init__(self, n: int, v: int, once: int, twice: int, texts: int, m1: float, m2: float):
        self.n, self.v, self.texts, self.m1, self.m2 = n, v, texts, m1, m2
        self.discount = min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5

    def unigram(self, c: np.ndarray) -> np.ndarray:
        if not self.n:
            return np.ones(len(c))
        unknown = self.discount * self.v / self.n
        return np.where(c > 0, (c - self.discount) / self.n, unknown)

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.5) / (self.n + 0.5 * (self.v + 1)))


def _ranked(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct codes, rank of each code among them)."""
    order = np.argsort(codes)
    codes = codes[order]
    new = np.ones(len(codes), bool)
    new[1:] = codes[1:] != codes[:-1]
    rank = np.empty(len(codes), np.int64)
    rank[order] = np.cumsum(new) - 1
    return codes[new], rank


def shard_scores(bodies: list[bytes], totals: Totals, hot: np.ndarray, hot_n: np.ndarray) -> list[list[np.ndarray]]:
    """For each body: [sum of log10 P, sum of base, known tokens] of its portion's documents."""
    parts = [unpack_arrays(b)[:7] for b in bodies]
    words, w_map = np.unique(np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts]), return_inverse=True)
    names, c_map = np.unique(np.concatenate([np.cumsum(p[1], dtype=np.uint64) for p in parts]), return_inverse=True)
    w_from = np.cumsum([0] + [len(p[0]) for p in parts])
    c_from = np.cumsum([0] + [len(p[1]) for p in parts])
    w, v, u = (
        np.concatenate([to[p[k].astype(np.int64) + f] for p, f in zip(parts, start, strict=False)]).astype(np.uint32)
        for k, to, start in ((2, w_map, w_from), (3, c_map, c_from), (4, c_map, c_from))
    )
    parts = [(p[5], p[6].astype(bool)) for p in parts]  # document of each position, training flag of each document
    train = np.concatenate([flag[own.astype(np.int64)] for own, flag in parts])
    del w_map, c_map
    span = np.int64(len(names))
    pair, of_pair = _ranked(w * span + v)
    triple, of_triple = _ranked(of_pair * span + u)
    del v, u
    pw, pv = (pair // span).astype(np.int32), (pair % span).astype(np.int32)
    tp, tu = (triple // span).astype(np.int32), (triple % span).astype(np.int32)
    del pair, triple
    c1 = np.bincount(w, train, len(words)).astype(np.int64)
    if len(hot):
        at = np.minimum(np.searchsorted(hot, words), len(hot) - 1)
        c1 = np.where(hot[at] == words, hot_n[at], c1)
    c2 = np.bincount(of_pair, train, len(pw)).astype(np.int64)
    c3 = np.bincount(of_triple, train, len(tp)).astype(np.int64)
    p1 = totals.unigram(c1)

    # the trie holds the training n-grams
    k1, k2, k3 = np.flatnonzero(c1), np.flatnonzero(c2), np.flatnonzero(c3)
    n1, n2 = np.cumsum(c1 > 0) - 1, np.cumsum(c2 > 0) - 1
    low1, low2 = totals.m1 * p1, totals.m2 * c2 + totals.m1 * p1[pw]
    values = [
        np.log10(low1[k1]),
        np.log10(totals.m2 * c1[k1] + totals.m1),
        np.log10(low2[k2]),
        np.log10(c2[k2] + totals.m2 * c1[pw[k2]] + totals.m1),
        np.log10(c3[k3] + low2[tp[k3]]),
    ]
    trie = Trie.build(words[k1], names, (n1[pw[k2]], pv[k2] + 1), (n2[tp[k3]], tu[k3] + 1), values)

    # and answers the n-grams of all documents
    at, found = trie.words.successor(words)
    node1 = np.where(found, at, -1)
    ctx, _ = trie.contexts.successor(names)
    node2 = np.full(len(pw), -1, np.int64)
    ask = np.flatnonzero(node1[pw] >= 0)
    node2[ask] = trie.second.find(node1[pw[ask]], ctx[pv[ask]] + 1)
    node3 = np.full(len(tp), -1, np.int64)
    ask = np.flatnonzero(node2[tp] >= 0)
    node3[ask] = trie.third.find(node2[tp[ask]], ctx[tu[ask]] + 1)

    unknown = float(np.log10(totals.m1 * totals.unigram(np.zeros(1))[0]))
    num1 = np.full(len(words), unknown)
    den1 = np.full(len(words), np.log10(totals.m1))
    num1[node1 >= 0], den1[node1 >= 0] = (trie.value(i, node1[node1 >= 0]) for i in (0, 1))
    num2, den2 = num1[pw], den1[pw]
    num2[node2 >= 0], den2[node2 >= 0] = (trie.value(i, node2[node2 >= 0]) for i in (2, 3))
    den2[words[pw] == END] = 0.0
    score = num2[tp] - den2[tp]
    score[node3 >= 0] = trie.value(4, node3[node3 >= 0]) - den2[tp[node3 >= 0]]
    base = totals.base(c1)

    out, k = [], 0
    for own, flag in parts:
        size, docs = len(own), len(flag)
        here = slice(k, k + size)
        out.append(
            [np.bincount(own, x, docs) for x in (score[of_triple[here]], base[w[here]], (c1 > 0)[w[here]])]
        )
        k += size
    return out


def score(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", fold: int = 1, folds: int = 5,
    m1: float = 20.0, m2: float = 0.005, portion: int = 1_500_000,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Training documents are those whose crc32(doc_id as text) mod ``folds`` is not ``fold``. ``portion`` is
    the number of tokens dealt together; it bounds a task's memory, a longer document stands alone."""
    spark = docs.sparkSession
    shards = width(spark)
    rows = docs.select(F.col(doc_id).cast("long"), F.col(text))
    counts = stage(unigrams(docs, doc_id, text, fold, folds), "lm-unigrams")
    n, v, once, twice, texts = counts.agg(
        F.sum("n"), F.count(F.lit(1)), F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2),
        F.max(F.when(F.col("name") == int(END), F.col("n"))),
    ).first()
    totals = Totals(n or 0, v, once, twice, texts or 0, m1, m2)
    frequent = sorted(
        (np.uint64(r[0] & (2**64 - 1)), r[1])
        for r in counts.where(F.col("n") >= max(1, totals.n // (4 * shards))).collect()
    )
    hot = np.array([r[0] for r in frequent], np.uint64)
    hot_n = np.array([r[1] for r in frequent], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = (task.partitionId() if task else 0) << 32
        held, size = [], 0

        def out() -> pa.RecordBatch:
            ids = [i for h in held for i in h[0]]
            t, count = (np.concatenate([h[k] for h in held]) for k in (1, 2))
            bodies = deal(ids, t, count, in_training(ids, fold, folds), shards, hot)
            return pa.RecordBatch.from_arrays(
                [pa.array([b[0] for b in bodies], pa.int32()), pa.array([name] * len(bodies), pa.int64()),
                 pa.array([b[1] for b in bodies], pa.binary())],
                ["shard", "portion", "body"],
            )

        for ids, texts_ in slices(batches, 2 << 20):
            t, count = tokens(texts_)
            held.append((ids, t, count))
            size += len(t)
            if size >= portion:
                yield out()
                held, size, name = [], 0, name + 1
        if held:
            yield out()

    def answer(table: pa.Table) -> pa.Table:
        bodies = table.column("body").to_pylist()
        packed = [press(np.concatenate(s).astype("<f8").tobytes()) for s in shard_scores(bodies, totals, hot, hot_n)]
        tables = [unpack_arrays(b)[7:] for b in bodies]
        return pa.table(
            {
                "portion": table.column("portion"),
                "shard": table.column("shard"),
                "sums": pa.array(packed, pa.binary()),
                "docs": pa.array([pack_arrays(t) if t else None for t in tables], pa.binary()),
            }
        )

    start = float(np.log10(totals.texts + totals.m2 * totals.texts + totals.m1))

    def gather(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("shard").to_numpy())
        sums = table.column("sums").to_pylist()
        total = None
        for i in order:
            part = np.frombuffer(unpress(sums[i]), "<f8")
            total = part if total is None else total + part
        log, base, known = total.reshape(3, -1)
        ids, null, n_tokens = unpack_arrays(next(d for d in table.column("docs").to_pylist() if d is not None))
        ids = ids.astype(np.uint64).view(np.int64)
        names = [None if x else int(i) for i, x in zip(ids, null, strict=True)]
        return pa.table(
            {
                "doc_id": pa.array(names, pa.int64()),
                "held_out": pa.array([i is None or zlib.crc32(str(i).encode()) % folds == fold for i in names]),
                "n_tokens": pa.array(n_tokens.astype(np.int64)),
                "n_known": pa.array(np.rint(known).astype(np.int64)),
                "train_tokens": pa.array(np.full(len(ids), totals.n, np.int64)),
                "base_score": pa.array(base),
                "score": pa.array(log - start),
            }
        )

    dealt = rows.mapInArrow(run, "shard int, portion long, body binary")
    answers = dealt.groupBy("shard").applyInArrow(answer, "portion long, shard int, sums binary, docs binary")
    out = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return answers.groupBy("portion").applyInArrow(gather, out)


def op1_lm_score(spark, sf_dir: str) -> DataFrame:
    return score(read_table(spark, sf_dir, "documents"))
