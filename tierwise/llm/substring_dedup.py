"""Substring dedup by level-wise doubling of repeated word windows.

A window is ``length`` consecutive words of one document. Every word is removed that lies in a window whose
words also start in a document with a smaller id; windows are judged on the input.

1. Portions of documents name all their windows of ``length`` words (64-bit names, made by doubling, too: two
   windows of 8 words name one of 13) and deal them by name to shards. Copies inside a portion are one entry,
   so a window that a third of all rows share is one entry for each portion.
2. A shard finds the names that occur more than once, the smallest document id of each, and gives each repeated
   window a number. Answers go back to the portion: where its repeated windows start, their numbers, and
   whether a smaller document has them, too.
3. The windows repeated at one length alone are extended: where a repeated window is followed at once by another
   of the same document, the pair of their numbers names a window of twice the length. These go through
   step 2 again, length after length, until no candidate survives. Unrepeated text is not touched again.
4. The first length gives the words to remove; the last one at which a document still has a repeated window is
   its ``longest_repeat``. Both are joined to the documents by id and text digest.

Portions and shards are bounded in words (a longer text is a portion by itself); shards follow the measured
bytes of the table, and at each later length the number of survivors. Levels are written to the shared folder.
Two different windows get one name with probability 2^-64.

Defined cases: a null, empty or blank text has no words; texts are read whole and words are not changed; a text
with fewer words than ``length`` keeps all; a null id counts as the largest long (a document with it gives way to
all that have ids, but not to others without); rows with one id do not remove each other's words; repeated rows are
returned each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwise.llm.blobs import deltas, pack_arrays, press, runs, unpack_arrays, unpress
from tierwise.llm.common import read_table, small_batches, stage, width
from tierwise.llm.textarrays import mix, slices, word_arrays

SHARD_BYTES = 8 << 20  # of text, for one shard at the first length
SHARD_WINDOWS = 1_200_000  # for one shard at later lengths
SIGN = np.uint64(1 << 63)
ROWS = "key long, portion long, body binary"
STATE = "portion long, n long, body binary"


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Names of the windows made of two windows each."""
    return mix(left * np.uint64(3) + mix(right))


def window_names(words: np.ndarray, length: int) -> np.ndarray:
    """The name of the window of ``length`` words at every place that has so many words after it."""
    names, size = words, 1
    while size < length and len(names):
        shift = min(size, length - size)
        names = joined(names[:-shift], names[shift:]) if len(names) > shift else names[:0]
        size += shift
    return names


class Docs:
    """The documents of a portion: first word of each (ascending), id as an unsigned number, digest."""

    def __init__(self, first: np.ndarray, order: np.ndarray, high: np.ndarray, low: np.ndarray):
        self.first, self.order, self.high, self.low = first, order, high, low

    @classmethod
    def unpack(cls, arrays: list[np.ndarray]) -> Docs:
        first, *rest = (a.astype(np.uint64) for a in arrays)
        return cls(np.cumsum(first), *rest)

    def packed(self) -> list[np.ndarray]:
        return [deltas(self.first), self.order, self.high, self.low]

    def at(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, place, side="right") - 1

    def only(self, rows: np.ndarray) -> Docs:
        return Docs(self.first[rows], self.order[rows], self.high[rows], self.low[rows])


def id_order(ids: list) -> np.ndarray:
    return np.array([(1 << 63) - 1 if i is None else i for i in ids], np.int64).view(np.uint64) + SIGN


def deal(portion: int, place: np.ndarray, name: np.ndarray, docs: Docs, shards: int) -> pa.RecordBatch:
    """Rows for the shards (key: the shard) and one that stays with the portion (key: below zero).

    A name is one entry, standing for its occurrence in the smallest document; the others stay behind."""
    order = np.lexsort((place, docs.order[docs.at(place)], name))
    place, name = place[order], name[order]
    new = np.ones(len(name), bool)
    new[1:] = name[1:] != name[:-1]
    cuts = np.flatnonzero(new)
    many = np.diff(np.append(cuts, len(name))) > 1
    home = place[cuts][np.cumsum(new) - 1]  # of each occurrence, the one that stands for it
    other = np.flatnonzero(~new)
    other = other[np.argsort(place[other])]
    keys = [~portion]
    bodies = [pack_arrays([*docs.packed(), deltas(place[other]), home[other]])]
    name, place = name[cuts], place[cuts]
    shard = ((name >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
    short = [deltas(docs.first), docs.order]
    for a, b in runs(shard):
        keys.append(int(shard[a]))
        bodies.append(pack_arrays([deltas(name[a:b]), place[a:b], many[a:b], *short]))
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int64()), pa.array([portion] * len(keys), pa.int64()), pa.array(bodies, pa.binary())],
        ["key", "portion", "body"],
    )


def answer(table: pa.Table, shards: int) -> pa.Table:
    """For each portion: [places of its repeated windows, their numbers, whether a smaller document has them]."""
    key = table.column("key")[0].as_py()
    if key < 0:
        return table
    parts = [[a.astype(np.uint64) for a in unpack_arrays(b)] for b in table.column("body").to_pylist()]
    sizes = [len(p[0]) for p in parts]
    name = np.concatenate([np.cumsum(p[0]) for p in parts])
    least = np.concatenate([p[4][np.searchsorted(np.cumsum(p[3]), p[1], side="right") - 1] for p in parts])
    many = np.concatenate([p[2] for p in parts]) > 0
    order = np.argsort(name, kind="stable")
    sorted_name = name[order]
    new = np.ones(len(name), bool)
    new[1:] = sorted_name[1:] != sorted_name[:-1]
    group = np.empty(len(name), np.int64)
    group[order] = np.cumsum(new) - 1
    cuts = np.flatnonzero(new)
    repeated = (np.diff(np.append(cuts, len(name))) > 1) | np.logical_or.reduceat(many[order], cuts)
    smallest = np.minimum.reduceat(least[order], cuts)
    number = (np.cumsum(repeated) - 1) * shards + key
    portions, bodies, at = [], [], 0
    for portion, part, size in zip(table.column("portion").to_pylist(), parts, sizes, strict=True):
        here = slice(at, at + size)
        at += size
        hit = np.flatnonzero(repeated[group[here]])
        if len(hit):
            hit = hit[np.argsort(part[1][hit])]
            g = group[here][hit]
            portions.append(portion)
            bodies.append(pack_arrays([deltas(part[1][hit]), number[g], smallest[g] < least[here][hit]]))
    return pa.table(
        {"key": pa.array([key] * len(bodies), pa.int64()), "portion": pa.array(portions, pa.int64()), "body": pa.array(bodies, pa.binary())}
    )


def gather(table: pa.Table) -> pa.Table:
    """A portion's repeated windows: [documents, places, numbers, whether to remove]; no row if there are none."""
    empty = pa.table({"portion": pa.array([], pa.int64()), "n": pa.array([], pa.int64()), "body": pa.array([], pa.binary())})
    keys, bodies = table.column("key").to_pylist(), table.column("body").to_pylist()
    own = [unpack_arrays(b) for k, b in zip(keys, bodies, strict=True) if k < 0]
    told = [[a.astype(np.uint64) for a in unpack_arrays(b)] for k, b in zip(keys, bodies, strict=True) if k >= 0]
    if not told:
        return empty
    docs = Docs.unpack(own[0][:4])
    place = np.concatenate([np.cumsum(t[0]) for t in told])
    number, smaller = (np.concatenate([t[k] for t in told]) for k in (1, 2))
    order = np.argsort(place)
    place, number, smaller = place[order], number[order], smaller[order]
    least = docs.order[docs.at(place)]
    other, home = np.cumsum(own[0][4].astype(np.uint64)), own[0][5].astype(np.uint64)
    at = np.searchsorted(place, home)  # a name with other occurrences is repeated, so its home is among them
    drop = (smaller[at] > 0) | (docs.order[docs.at(other)] > least[at])
    place = np.concatenate([place, other])
    number, drop = np.concatenate([number, number[at]]), np.concatenate([smaller > 0, drop])
    order = np.argsort(place)
    place, number, drop = place[order], number[order], drop[order]
    docs = docs.only(np.unique(docs.at(place)))
    body = pack_arrays([*docs.packed(), deltas(place), number, drop])
    return pa.table(
        {"portion": table.column("portion").slice(0, 1), "n": pa.array([len(place)], pa.int64()), "body": pa.array([body], pa.binary())}
    )


def _windows(docs: DataFrame, doc_id: str, text: str, length: int, shards: int, portion_words: int) -> DataFrame:
    """The dealt windows of the first length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        portion = (task.partitionId() if task else 0) << 32
        held, size = [], 0

        def out() -> pa.RecordBatch:
            rows = [r for h in held for r in h[0]]
            words, n = (np.concatenate([h[k] for h in held]) for k in (1, 2))
            ends = np.cumsum(n)
            some = np.flatnonzero(n)
            digest = np.frombuffer(b"".join(rows[i]["digest"] for i in some), "<u8").reshape(-1, 2)
            table = Docs((ends - n)[some].astype(np.uint64), id_order([rows[i]["id"] for i in some]), digest[:, 0], digest[:, 1])
            names = window_names(words, length)
            last = np.repeat(ends, n)[: len(names)]  # of the document that each window starts in
            place = np.flatnonzero(np.arange(len(names)) + length <= last)
            return deal(portion, place.astype(np.uint64), names[place], table, shards)

        for rows, texts in slices(batches):
            words, n = word_arrays(texts, lower=False)
            if size and size + len(words) > portion_words:
                yield out()
                held, size, portion = [], 0, portion + 1
            held.append((rows, words, n))
            size += len(words)
        if size:
            yield out()

    rows = docs.where(F.col(text).isNotNull()).select(
        F.struct(F.col(doc_id).cast("long").alias("id"), F.unhex(F.md5(F.col(text).cast("binary"))).alias("digest")).alias("r"), F.col(text)
    )
    return rows.mapInArrow(run, ROWS)


def _doubled(state: DataFrame, length: int, shards: int) -> DataFrame:
    """The dealt windows of twice the length, from the repeated windows of ``length``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for portion, body in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                arrays = unpack_arrays(body)
                docs, place, number = Docs.unpack(arrays[:4]), np.cumsum(arrays[4].astype(np.uint64)), arrays[5].astype(np.uint64)
                after = np.minimum(np.searchsorted(place, place + np.uint64(length)), len(place) - 1)
                owner = docs.at(place)
                pair = np.flatnonzero((place[after] == place + np.uint64(length)) & (owner[after] == owner))
                if len(pair):
                    yield deal(portion, place[pair], joined(mix(number[pair]), mix(number[after[pair]])), docs, shards)

    return state.mapInArrow(run, ROWS)


def _answered(dealt: DataFrame, shards: int) -> DataFrame:
    def reply(table: pa.Table) -> pa.Table:
        return answer(table, shards)

    return stage(dealt.groupBy("key").applyInArrow(reply, ROWS).groupBy("portion").applyInArrow(gather, STATE), "windows")


def repeated_windows(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 13, portion_words: int = 1_000_000
) -> list[tuple[int, DataFrame]]:
    """(length, the portions' repeated windows) for ``length`` and its doubles, as long as some repeat."""
    spark = docs.sparkSession
    small_batches(spark)
    size = docs.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0
    shards = max(width(spark), -(-size // SHARD_BYTES))
    levels: list[tuple[int, DataFrame]] = []
    state = _answered(_windows(docs, doc_id, text, length, shards, portion_words), shards)
    while n := state.agg(F.sum("n")).first()[0]:
        levels.append((length, state))
        shards = max(min(width(spark), -(-n // 50_000)), -(-n // SHARD_WINDOWS))
        state = _answered(_doubled(state, length, shards), shards)
        length *= 2
    return levels


def _marks(state: DataFrame, length: int, first: bool) -> DataFrame:
    """doc_id, digest, longest, spans (word places to remove as [from, to) pairs; only at the first length)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body in batch.column(2).to_pylist():
                arrays = unpack_arrays(body)
                docs, place, drop = Docs.unpack(arrays[:4]), np.cumsum(arrays[4].astype(np.uint64)), arrays[6] > 0
                spans: list = [None] * len(docs.first)
                if first:
                    place = place[drop]
                    owner = docs.at(place)
                    start = (place - docs.first[owner]).astype(np.int64)
                    for a, b in runs(owner):
                        s = start[a:b]
                        cut = np.flatnonzero(np.concatenate(([True], s[1:] > s[:-1] + length)))
                        ends = s[np.append(cut[1:], len(s)) - 1] + length
                        spans[owner[a]] = np.column_stack([s[cut], ends]).ravel().tolist()
                digest = np.column_stack([docs.high, docs.low]).astype("<u8")
                ids = (docs.order - SIGN).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids),
                        pa.array([d.tobytes() for d in digest], pa.binary()),
                        pa.array(np.full(len(ids), length, np.int64)),
                        pa.array(spans, pa.list_(pa.int64())),
                    ],
                    ["id", "digest", "longest", "spans"],
                )

    return state.mapInArrow(run, "id long, digest binary, longest long, spans array<bigint>")


def removed_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 13) -> DataFrame:
    """id (null: the largest long), digest (md5 of the text), longest, spans for each different document that has
    a repeated window; spans are the words to remove, as places [from, to, from, to, ...]."""
    marks = None
    for k, (size, state) in enumerate(repeated_windows(docs, doc_id, text, length)):
        level = _marks(state, size, k == 0)
        marks = level if marks is None else marks.union(level)
    if marks is None:
        return docs.sparkSession.createDataFrame([], "id long, digest binary, longest long, spans array<bigint>")
    # equal rows have equal spans, so any of them will do
    return marks.groupBy("id", "digest").agg(F.max("longest").alias("longest"), F.max("spans").alias("spans"))


def drop_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 13) -> DataFrame:
    """For each row: doc_id, n_words, n_removed, longest_repeat (0: no repeated window), kept (words joined by spaces)."""
    spans = removed_spans(docs, doc_id, text, length)

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body = batch.column(1).cast(pa.binary())
            small = pa.array([None if (b := x.as_py()) is None else press(b) for x in body], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), small, *batch.columns[2:]], ["doc_id", "body", "id", "digest"])

    own = docs.select(
        F.col(doc_id).cast("long"),
        F.col(text),
        F.coalesce(F.col(doc_id).cast("long"), F.lit((1 << 63) - 1)).alias("id"),
        F.unhex(F.md5(F.col(text).cast("binary"))).alias("digest"),
    ).mapInArrow(squeeze, "doc_id long, body binary, id long, digest binary")
    found = own.join(spans, ["id", "digest"], "left").select("doc_id", "body", "longest", "spans")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for body, spans in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist(), strict=True):
                words = [] if body is None else unpress(body).split()  # the six ASCII spaces
                n_words.append(len(words))
                for a, b in zip(reversed((spans or [])[0::2]), reversed((spans or [])[1::2]), strict=True):
                    del words[a:b]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                    batch.column(2).fill_null(0), pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_words", "n_removed", "longest_repeat", "kept"],
            )

    return found.mapInArrow(remove, "doc_id long, n_words long, n_removed long, longest_repeat long, kept string")


def op13_substring_dedup(spark, sf_dir: str) -> DataFrame:
    out = drop_repeats(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"), "longest_repeat")
