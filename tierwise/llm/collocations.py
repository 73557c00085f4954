"""Phrase collocations by language, counted with weighted acyclic automata.

A phrase of 2 to 5 words that occurs at least ``least`` times is a candidate. Cut after its first k words, with
a = f(phrase), l = f(first part), r = f(rest) and n words in the language, the cut scores floor(1000 a n / (l r));
the lowest cut counts. A candidate inside a longer one that occurs as often is dropped.

1. One pass over the texts writes, for each portion of documents, its words with their counts, and the text as
   word numbers. Words are counted as text; they are named by 64 bits of language and word.
2. Length by length, each portion sorts its n-grams whose two parts without the last and without the first word
   may be frequent, and builds a count transducer from them incrementally. It is dealt by ranges of the prefix
   (all words but the last); a prefix that would fill more than a quarter of a shard is dealt by the whole n-gram.
   Equal n-grams of a portion are one weighted path, so no repetition, however hot, is carried twice.
3. A shard unites the automata of its range, adding weights, and returns the n-grams with at least ``least``.
   Every part of a candidate is a candidate or a frequent word, so the shorter lengths bound the longer ones.
4. Parts are looked up by composition: the parts asked for in a range form an acceptor, which is composed with
   the automaton of the range's frequent n-grams; shared prefixes are walked once.

"May be frequent" is asked of a bitmap of a fixed size (``BITS``): two n-grams that share a bit only cost work, so
results do not depend on it. Nothing else is sent to all tasks. Totals, scores and ranks are DataFrame work; the
score's products are decimals of 38 digits. The first ``top`` of a language are chosen in two steps (a limit in
each task first).

Defined cases: a null or empty text has no words; a null language is ``und``; texts are read whole; repeated rows
count; ties fall to the greater count, then the phrase in byte order; ids are not read, so null or repeated ones do
no harm; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierwise.llm.automaton import Transducer
from tierwise.llm.blobs import deltas, pack_arrays, runs, unpack_arrays
from tierwise.llm.common import read_table, small_batches, stage, width
from tierwise.llm.textarrays import _word_bounds, mix, slices, word_arrays

BITS = 1 << 26  # of a bitmap: 8 MB
SHARD_GRAMS = 2_000_000  # most occurrences that a shard is meant to hold
PORTION_WORDS = 2_000_000
DISTINCT_WORDS = 1_000_000  # that a task counts before it passes them on
#: A-Z in lower case; the characters that end a piece as a line break; a tab as a space.
_BYTES = bytearray(range(256))
_BYTES[65:91] = bytes(range(97, 123))
for _c in b".,;:!?\n\x0b\x0c\r":
    _BYTES[_c] = 10
_BYTES[9] = 32
PIECES = bytes(_BYTES)


def language_code(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))


def extended(prefix: np.ndarray, name: np.ndarray) -> np.ndarray:
    """Names of the n-grams made of a prefix and one more word."""
    return mix(prefix * np.uint64(3) + mix(name))


def gram_names(columns: list[np.ndarray]) -> np.ndarray:
    out = columns[0]
    for c in columns[1:]:
        out = extended(out, c)
    return out


class Bitmap:
    """A set of names by their last bits: never misses a member."""

    def __init__(self, cells: np.ndarray | None):
        self.cells = cells

    @classmethod
    def of(cls, names: DataFrame) -> Bitmap:
        """Of a table's ``h``; the cells are made by the tasks, at most BITS / 64 of them come to the driver."""
        bit = f"(h & {BITS - 1}L)"
        cells = names.groupBy(F.expr(f"shiftright({bit}, 6)").alias("cell")).agg(
            F.expr("bit_or(shiftleft(1L, cast(h & 63 AS int)))").alias("bits")
        )
        table = cells.toArrow()
        if not table.num_rows:
            return cls(None)
        out = np.zeros(BITS // 64, np.int64)
        out[table.column("cell").to_numpy()] = table.column("bits").to_numpy()
        return cls(out)

    def __call__(self, names: np.ndarray) -> np.ndarray:
        if self.cells is None:
            return np.zeros(len(names), bool)
        bit = names & np.uint64(64 * len(self.cells) - 1)
        cell = self.cells.view(np.uint64)[(bit >> np.uint64(6)).astype(np.int64)]
        return (cell >> (bit & np.uint64(63))) & np.uint64(1) > 0


class _Words:
    """Words counted by a task, merged over its portions as long as they are few."""

    def __init__(self):
        self.parts: list[tuple] = []  # (names, counts, languages, spellings)
        self.size = 0

    def add(self, names: np.ndarray, counts: np.ndarray, langs: pa.Array, words: pa.Array) -> None:
        self.parts.append((names, counts, langs, words))
        self.size += len(names)
        if self.size > DISTINCT_WORDS:
            self.merge()

    def merge(self) -> None:
        names = np.concatenate([p[0] for p in self.parts])
        names, first, back = np.unique(names, return_index=True, return_inverse=True)
        counts = np.bincount(back, np.concatenate([p[1] for p in self.parts])).astype(np.int64)
        langs, words = (pa.concat_arrays([p[k] for p in self.parts]).take(pa.array(first)) for k in (2, 3))
        self.parts, self.size = [(names, counts, langs, words)], len(names)

    def rows(self) -> pa.RecordBatch:
        self.merge()
        ((names, counts, langs, words),) = self.parts
        self.parts, self.size = [], 0
        none = pa.nulls(len(names))
        return pa.RecordBatch.from_arrays(
            [langs, words, pa.array(names.view(np.int64)), pa.array(counts), none.cast(pa.int64()), none.cast(pa.binary())], KINDS
        )


KINDS = ["lang", "word", "name", "n", "portion", "body"]


def portions(docs: DataFrame, text: str = "text", lang: str = "lang", words: int = PORTION_WORDS) -> DataFrame:
    """Rows of two kinds: lang, word, name, n (body null) and portion, body (word null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        portion = (task.partitionId() if task else 0) << 32
        held, size, counted = [], 0, _Words()

        def body() -> bytes:
            langs = [x for h in held for x in h[0]]
            texts = [x for h in held for x in h[1]]
            held.clear()
            names, n = word_arrays(texts, lower=False)
            blob = b"\n".join(texts) + b"\n"
            del texts
            data = np.frombuffer(blob, np.uint8)
            starts, ends = _word_bounds(data)
            piece = np.cumsum(data == 10, dtype=np.int32)[starts]
            kinds, which = np.unique(langs, return_inverse=True)
            codes = np.array([language_code(str(x)) for x in kinds], np.uint64)
            owner = np.repeat(which, n)
            names = mix(names ^ codes[owner])
            vocabulary, first, rank, count = np.unique(names, return_index=True, return_inverse=True, return_counts=True)
            spelled = [blob[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
            counted.add(
                vocabulary, count, pa.array([str(x) for x in kinds], pa.string()).take(pa.array(owner[first])),
                pa.array(spelled, pa.binary()).cast(pa.string()),
            )
            lengths = np.diff(np.append(np.flatnonzero(np.diff(piece, prepend=-1)), len(piece)))
            return pack_arrays([deltas(vocabulary), rank, lengths])

        def row(packed: bytes) -> pa.RecordBatch:
            nulls = [pa.nulls(1, kind) for kind in (pa.string(), pa.string(), pa.int64(), pa.int64())]
            return pa.RecordBatch.from_arrays([*nulls, pa.array([portion], pa.int64()), pa.array([packed], pa.binary())], KINDS)

        for langs, texts in slices(batches):
            texts = [t.translate(PIECES) for t in texts]
            held.append((langs, texts))
            size += sum(t.count(b" ") + t.count(b"\n") + 1 for t in texts)
            if size >= words:
                yield row(body())
                size, portion = 0, portion + 1
                if counted.size > DISTINCT_WORDS // 2:
                    yield counted.rows()
        if held:
            yield row(body())
        if counted.size:
            yield counted.rows()

    small_batches(docs.sparkSession)
    rows = docs.where(F.col(text).isNotNull()).select(F.coalesce(F.col(lang).cast("string"), F.lit("und")), F.col(text))
    return rows.mapInArrow(run, "lang string, word string, name long, n long, portion long, body binary")


def _shard(prefix: np.ndarray, whole: np.ndarray, heavy: Bitmap, shards: int) -> np.ndarray:
    spot = np.where(heavy(prefix), whole, prefix) >> np.uint64(32)
    return (spot * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def deal(body: bytes, size: int, frequent: Bitmap, heavy: Bitmap, shards: int) -> list[tuple[int, bytes]]:
    """(shard, automaton) of a portion's n-grams of ``size`` words that may be frequent."""
    vocabulary, rank, lengths = unpack_arrays(body)
    vocabulary, rank = np.cumsum(vocabulary.astype(np.uint64)), rank.astype(np.int64)
    names = vocabulary[rank]
    left = np.repeat(np.cumsum(lengths.astype(np.int64)), lengths.astype(np.int64)) - np.arange(len(rank))  # words of its piece from here on
    part = names
    for k in range(1, size - 1):
        part = extended(part[:-1], names[k:]) if len(part) > 1 else part[:0]
    alive = frequent(part)
    at = np.flatnonzero(alive[:-1] & alive[1:] & (left[: max(len(part) - 1, 0)] >= size)) if len(part) > 1 else np.zeros(0, np.int64)
    if not len(at):
        return []
    prefix = part[at]
    columns = [rank[at + k] for k in range(size)]
    shard = _shard(prefix, extended(prefix, vocabulary[columns[-1]]), heavy, shards)
    order = np.lexsort((*columns[::-1], shard))
    columns, shard = [vocabulary[c[order]] for c in columns], shard[order]
    ones = np.ones(len(order), np.int64)
    return [(int(shard[a]), Transducer.from_sorted([c[a:b] for c in columns], ones[a:b]).pack()) for a, b in runs(shard)]


def frequent_grams(texts: DataFrame, size: int, shorter: DataFrame, least: int) -> DataFrame:
    """h, w, n: name, words' names and count of the n-grams of ``size`` words with at least ``least`` occurrences.
    ``shorter`` are those of one word less."""
    spark = texts.sparkSession
    total = shorter.agg(F.sum("n")).first()[0] or 0  # no more n-grams than this may be frequent
    shards = max(min(width(spark), -(-total // 100_000)), -(-total // SHARD_GRAMS), 1)
    frequent = spark.sparkContext.broadcast(Bitmap.of(shorter))
    heavy = spark.sparkContext.broadcast(Bitmap.of(shorter.where(F.col("n") > total // (4 * shards))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body in batch.column(0).to_pylist():
                dealt = deal(body, size, frequent.value, heavy.value, shards)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s for s, _ in dealt], pa.int32()), pa.array([b for _, b in dealt], pa.binary())], ["shard", "body"]
                )

    def unite(table: pa.Table) -> pa.Table:
        whole = Transducer.union([Transducer.unpack(b) for b in table.column("body").to_pylist()])
        columns, n = whole.sequences(size - 1, least)
        flat = np.column_stack(columns).astype(np.uint64).view(np.int64).ravel()
        w = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * size), pa.array(flat))
        return pa.table({"h": pa.array(gram_names(columns).view(np.int64)), "w": w, "n": pa.array(n)})

    bodies = texts.where("body IS NOT NULL").select("body").mapInArrow(run, "shard int, body binary")
    return stage(bodies.groupBy("shard").applyInArrow(unite, "h long, w array<bigint>, n long"), "collocations")


def _automaton(w: list[list[int]], n: np.ndarray) -> Transducer:
    """Of sequences of any lengths."""
    parts = []
    size = np.array([len(x) for x in w])
    for k in np.unique(size).tolist():
        at = np.flatnonzero(size == k)
        rows = np.array([w[i] for i in at], np.int64).view(np.uint64).reshape(-1, k)
        order = np.lexsort(tuple(rows.T[::-1]))
        parts.append(Transducer.from_sorted(list(rows[order].T), n[at][order]))
    return Transducer.union(parts)


def _look_up(grams: pa.Table, asked: pa.Table) -> pa.Table:
    """The rows of ``asked`` with the count ``f`` of their ``part``."""
    automaton = _automaton(grams.column("w").to_pylist(), grams.column("n").to_numpy())
    parts = asked.column("part").to_pylist()
    size = np.array([len(p) for p in parts], np.int64)
    found = np.zeros(len(parts), np.int64)
    for k in np.unique(size).tolist():
        at = np.flatnonzero(size == k)
        rows = np.array([parts[i] for i in at], np.int64).view(np.uint64).reshape(-1, k)
        order = np.lexsort(tuple(rows.T[::-1]))
        rows, at = rows[order], at[order]
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
        acceptor = Transducer.from_sorted(list(rows.T), np.ones(len(rows), np.int64))
        found[at] = automaton.compose(acceptor)[np.cumsum(new) - 1]
    return asked.select(["w", "a", "k", "side"]).append_column("f", pa.array(found))


def cuts(grams: DataFrame) -> DataFrame:
    """w, a, k, l, r for every phrase of ``grams`` (w, n: frequent n-grams of all lengths) and every cut."""
    spark = grams.sparkSession
    shards = max(1, width(spark), -(-grams.count() // 200_000))
    by_range = "CAST(pmod(xxhash64(slice({0}, 1, 2)), %d) AS int) AS shard" % shards
    asked = (
        grams.where("size(w) > 1")
        .selectExpr("w", "n AS a", "explode(sequence(1, size(w) - 1)) AS k")
        .selectExpr(
            "w", "a", "k",
            "explode(array(struct('l' AS side, slice(w, 1, k) AS part), struct('r' AS side, slice(w, k + 1, size(w)) AS part))) AS p",
        )
        .selectExpr("w", "a", "k", "p.side", "p.part", by_range.format("p.part"))
    )
    held = grams.selectExpr("w", "n", by_range.format("w"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return _look_up(left, right) if right.num_rows else right.select(["w", "a", "k", "side"]).append_column("f", pa.array([], pa.int64()))

    told = held.groupBy("shard").cogroup(asked.groupBy("shard")).applyInArrow(run, "w array<bigint>, a long, k int, side string, f long")
    return told.groupBy("w", "a", "k").agg(
        F.max(F.when(F.col("side") == "l", F.col("f"))).alias("l"), F.max(F.when(F.col("side") == "r", F.col("f"))).alias("r")
    )


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 100, longest: int = 5, share: int = 100, top: int = 2000
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score, words (of the phrase), cut (words of its first part).

    A candidate goes if its words lie inside a longer one with 100 f(longer) >= ``share`` a."""
    texts = stage(portions(docs, text, lang), "collocations")
    counted = texts.where("body IS NULL").groupBy("lang", "word", "name").agg(F.sum("n").alias("n"))
    words = stage(counted.where(F.col("n") >= least).select(F.col("name").alias("h"), "lang", "word", "n"), "collocations")
    totals = texts.where("body IS NULL").groupBy("lang").agg(F.sum("n").alias("n"))
    levels = [words.select("h", F.array("h").alias("w"), "n")]
    for size in range(2, longest + 1):
        found = frequent_grams(texts, size, levels[-1], least)
        if found.isEmpty():
            break
        levels.append(found)
    grams = levels[0]
    for level in levels[1:]:
        grams = grams.union(level)

    # a longer phrase is no more frequent than any part of it, so looking one word further is enough
    longer = grams.where("size(w) > 2")
    around = longer.selectExpr("slice(w, 1, size(w) - 1) AS w", "n").union(longer.selectExpr("slice(w, 2, size(w) - 1) AS w", "n"))
    around = around.groupBy("w").agg(F.max("n").alias("around"))
    alone = grams.where("size(w) > 1").join(around, "w", "left").where(f"around IS NULL OR 100 * around < {int(share)} * n").select("w")

    spelled = (
        alone.selectExpr("w", "posexplode(w) AS (place, h)")
        .join(words.select("h", "lang", "word"), "h")
        .groupBy("w")
        .agg(F.max("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("place", "word"))).alias("spelled"))
        .selectExpr("w", "lang", "transform(spelled, x -> x.word) AS words")
    )
    scored = (
        cuts(grams.select("w", "n"))
        .join(spelled, "w")
        .join(totals, "lang")
        .withColumn(
            "score",
            F.expr(
                "(CAST(1000 AS decimal(4,0)) * CAST(a AS decimal(19,0)) * CAST(n AS decimal(19,0)))"
                " div (CAST(l AS decimal(19,0)) * CAST(r AS decimal(19,0)))"
            ),
        )
        .groupBy("lang", "words", "a", "n")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
        .select("lang", F.array_join("words", " ").alias("phrase"), "a", "best.l", "best.r", "n", "best.score", "words", F.col("best.k").alias("cut"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score", "words", "cut")


def op12_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents")).drop("words", "cut")
