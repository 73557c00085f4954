"""Exact n-gram Jaccard join: a blocked sparse product of document by shingle incidence.

1. Every document becomes its set of distinct 5-word shingles. Equal sets are one class.
2. Shingle frequencies over the classes: incidence entries are dealt by shingle to shards; each shard
   counts, for every class, how many of its shingles another class has too. A class can only link if at
   least 80 in 100 of its shingles are shared, so the others are finished here.
3. The remaining classes order their shingles rarest first. Two sets that link must share one of the
   first n - ceil(0.8 n) + 1 of both, so only these are indexed. Classes that meet in the index fall into
   blocks; a block holds whole groups of meeting classes, and a group beyond ``block_rows`` is cut into
   row blocks that are multiplied pair by pair.
4. In a block the product accumulates overlap counts for meeting pairs, discards pairs below the size
   bounds, and skips pairs that are connected already. Its links are spanning links of the exact graph.
5. Connected components of the links give each document its group.

Shingles are named by 64-bit hashes, so results are exact up to hash collisions (about 2^-64 a pair).

Defined cases: null, empty and wordless texts have the empty set and link with nothing; with fewer
than five words the whole sequence is one shingle; texts are read whole; repeated rows are returned
each, in the group of their set; rows without an id link like others and make one group with what they link (its
component_id is null if no row of it has an id); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwise.llm.blobs import deltas, pack_arrays, runs, squeezed, unpack_arrays, unpress, unsqueezed
from tierwise.llm.common import read_table, small_batches, stage, unused, width
from tierwise.llm.graph import components
from tierwise.llm.textarrays import mix, shingles, slices, word_arrays
from tierwise.operators.extensions import broadcast_if_small

GONE_BYTES = 64 << 20  # most of the names of dropped rows that are broadcast


def shingle_sets(texts: list[bytes], size: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct shingle hashes ordered by text, then hash; set sizes; set names)."""
    h, n = shingles(*word_arrays(texts), size)
    owner = np.repeat(np.arange(len(texts)), n)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[keep], owner[keep]
    n = np.bincount(owner, minlength=len(texts)).astype(np.int64)
    sums = np.concatenate(([np.uint64(0)], np.cumsum(mix(h ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)))
    ends = np.cumsum(n)
    names = mix(sums[ends] - sums[ends - n] + n.astype(np.uint64))
    return h, n, names


def pack_entries(keys: np.ndarray, row: np.ndarray, *tables: np.ndarray) -> bytes:
    """Ascending 48-bit keys (as differences), the row of each, and columns of the rows."""
    return pack_arrays([deltas(keys), row, *tables])


def unpack_entries(blob: bytes) -> list[np.ndarray]:
    """Keys of the entries and, for each column of the rows, the entries' values."""
    keys, row, *tables = unpack_arrays(blob)
    return [np.cumsum(keys, dtype=np.uint64), *(t.astype(np.uint64)[row.astype(np.int64)] for t in tables)]


def dealt(keys: np.ndarray, owner: np.ndarray, shards: int, tables: list[np.ndarray]) -> list[tuple[int, bytes]]:
    """(shard, body) of incidence entries, by ranges of the 48-bit keys."""
    order = np.argsort(keys, kind="stable")
    keys, owner = keys[order], owner[order]
    shard = ((keys >> np.uint64(16)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
    out = []
    for a, b in runs(shard):
        rows, at = np.unique(owner[a:b], return_inverse=True)
        out.append((int(shard[a]), pack_entries(keys[a:b], at, *(t[rows] for t in tables))))
    return out


def _bodies(pairs: list[tuple[int, bytes]], name: str):
    return pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in pairs], pa.int32()), pa.array([b for _, b in pairs], pa.binary())], [name, "body"]
    )


def document_sets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5) -> DataFrame:
    """doc_id, digest (of the text; null if there is none), n_shingles, name (of the set; null if empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches, 1 << 20):
            _, n, names = shingle_sets(texts, size)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r["doc_id"] for r in rows], pa.int64()), pa.array([r["digest"] for r in rows], pa.int64()),
                    pa.array(n), pa.array(names.view(np.int64), mask=n == 0),
                ],
                ["doc_id", "digest", "n_shingles", "name"],
            )

    row = F.struct(F.col(doc_id).cast("long").alias("doc_id"), text_digest(text).alias("digest"))
    return docs.select(row.alias("row"), F.col(text)).mapInArrow(run, "doc_id long, digest long, n_shingles long, name long")


def text_digest(text: str = "text") -> Column:
    """With the id, what finds a row's text again; rows without an id have only this."""
    return F.when(F.col(text).isNotNull(), F.xxhash64(F.col(text)))


def shared_counts(docs: DataFrame, text: str = "text", size: int = 5) -> DataFrame:
    """name, shared: how many of the set's shingles occur in another set too (never fewer than truly)."""
    shards = width(docs.sparkSession)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in slices(batches, 2 << 20):
            h, n, names = shingle_sets(texts, size)
            _, first, row = np.unique(names, return_index=True, return_inverse=True)  # one of equal sets
            owner = np.repeat(np.arange(len(n)), n)
            keep = (first[row] == np.arange(len(n)))[owner]
            yield _bodies(dealt(h[keep] >> np.uint64(16), owner[keep], shards, [names]), "shard")

    def count(table: pa.Table) -> pa.Table:
        parts = [unpack_entries(b) for b in table.column("body").to_pylist()]
        keys, names = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.lexsort((names, keys))
        keys, names = keys[order], names[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (names[1:] != names[:-1])
        keys, names = keys[new], names[new]
        shared = np.zeros(len(keys), bool)
        shared[1:] = keys[1:] == keys[:-1]
        shared[:-1] |= shared[1:].copy()
        found, n = np.unique(names[shared], return_counts=True)
        bucket = (found % np.uint64(shards)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        found, n, bucket = found[order], n[order], bucket[order]
        pairs = [(int(bucket[a]), pack_arrays([deltas(found[a:b]), n[a:b]])) for a, b in runs(bucket)]
        return pa.Table.from_batches([_bodies(pairs, "bucket")])

    def total(table: pa.Table) -> pa.Table:
        parts = [unpack_arrays(b) for b in table.column("body").to_pylist()]
        names, at = np.unique(np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts]), return_inverse=True)
        sums = np.bincount(at, np.concatenate([p[1] for p in parts])).astype(np.int64)
        return pa.table({"name": pa.array(names.view(np.int64)), "shared": pa.array(sums)})

    bodies = docs.select(F.lit(0).cast("long").alias("id"), F.col(text)).mapInArrow(deal, "shard int, body binary")
    # a shard's counts travel as one body for each bucket of set names, not as a row for each set
    counted = bodies.groupBy("shard").applyInArrow(count, "bucket int, body binary")
    return counted.groupBy("bucket").applyInArrow(total, "name long, shared long")


def rarest(rows: DataFrame) -> DataFrame:
    """name, keys: the shingles (48 bits) of each set that are indexed: of the first n - ceil(0.8 n) + 1 in
    order of frequency among ``rows`` (name, n, hs), those that another set has too. Sets without any go."""
    shards = width(rows.sparkSession)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, n, lists = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2)
            flat = lists.flatten().to_numpy().view(np.uint64) >> np.uint64(16)
            owner = np.repeat(np.arange(len(names)), n)
            yield _bodies(dealt(flat, owner, shards, [names.view(np.uint64), n.astype(np.uint64)]), "shard")

    def count(table: pa.Table) -> pa.Table:
        parts = [unpack_entries(b) for b in table.column("body").to_pylist()]
        keys, names, n = (np.concatenate(c) for c in zip(*parts, strict=True))
        _, at, often = np.unique(keys, return_inverse=True, return_counts=True)
        often = often[at]
        keep = np.flatnonzero(often > 1)
        keep = keep[np.lexsort((names[keep], names[keep] % np.uint64(shards)))]
        keys, names, n, often = keys[keep], names[keep], n[keep], often[keep]
        bucket = (names % np.uint64(shards)).astype(np.int64)
        pairs = []
        for a, b in runs(bucket):
            first = np.array([x for x, _ in runs(names[a:b])], np.int64)
            per = np.diff(np.append(first, b - a))
            body = [names[a:b][first], n[a:b][first], per, keys[a:b], often[a:b]]
            pairs.append((int(bucket[a]), pack_arrays(body)))
        return pa.Table.from_batches([_bodies(pairs, "bucket")])

    def choose(table: pa.Table) -> pa.Table:
        parts = [[x.astype(np.uint64) for x in unpack_arrays(b)] for b in table.column("body").to_pylist()]
        names, n = (np.concatenate([np.repeat(p[k], p[2].astype(np.int64)) for p in parts]) for k in (0, 1))
        keys, often = (np.concatenate([p[k] for p in parts]) for k in (3, 4))
        order = np.lexsort((keys, often, names))
        names, n, keys = names[order], n[order].astype(np.int64), keys[order]
        out_names, out_keys = [], []
        for a, b in runs(names):
            # the unshared shingles come first in the order
            left = (n[a] - least_overlap(n[a]) + 1) - (n[a] - (b - a))
            if left > 0:
                out_names.append(names[a])
                out_keys.append(keys[a : a + left].view(np.int64))
        named = np.array(out_names, np.uint64).view(np.int64)
        return pa.table({"name": pa.array(named), "keys": pa.array(out_keys, pa.list_(pa.int64()))})

    bodies = rows.select("name", "n", "hs").mapInArrow(deal, "shard int, body binary")
    counted = bodies.groupBy("shard").applyInArrow(count, "bucket int, body binary")
    return counted.groupBy("bucket").applyInArrow(choose, "name long, keys array<bigint>")


def least_overlap(n: np.ndarray) -> np.ndarray:
    """ceil(0.8 n)"""
    return (4 * n + 4) // 5


def block_links(names: np.ndarray, sizes: np.ndarray, sets: list[np.ndarray], index: list[np.ndarray], hubs: int = 3):
    """Spanning links [(i, j)] of the rows of one block. ``sets`` are ascending, ``index`` the rarest shingles.

    A first rounds compare the rows of an index column with one of them (a hub): copies of one text are then
    connected at linear cost. What is still apart is compared pair by pair, in bounded portions."""
    rows = len(names)
    lengths = np.array([len(s) for s in sets])
    flat = np.concatenate(sets) if rows else np.zeros(0, np.int64)
    values, ids = np.unique(flat, return_inverse=True)
    starts = np.cumsum(lengths) - lengths
    span = np.int64(len(values) + 1)
    cell = np.repeat(np.arange(rows), lengths) * span + ids
    cell.sort()
    column = np.unique(np.concatenate(index), return_inverse=True)[1] if rows else np.zeros(0, np.int64)
    member = np.repeat(np.arange(rows), [len(x) for x in index])
    order = np.lexsort((member, column))
    column, member = column[order], member[order]
    label = np.arange(rows)
    tested = np.zeros(0, np.int64)
    links: list[tuple[int, int]] = []

    def test(a: np.ndarray, b: np.ndarray) -> None:
        """Exact overlap of row pairs that are apart and not yet tested; merges what links."""
        nonlocal tested, label
        a, b = np.minimum(a, b), np.maximum(a, b)
        small, large = np.minimum(sizes[a], sizes[b]), np.maximum(sizes[a], sizes[b])
        keep = (label[a] != label[b]) & (5 * small >= 4 * large)
        code = np.setdiff1d(a[keep] * np.int64(rows) + b[keep], tested)
        tested = np.union1d(tested, code)
        for at in range(0, len(code), 4096):
            x, y = code[at : at + 4096] // rows, code[at : at + 4096] % rows
            apart = label[x] != label[y]
            x, y = x[apart], y[apart]
            if not len(x):
                continue
            n = lengths[x]
            inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            want = np.repeat(y, n) * span + ids[np.repeat(starts[x], n) + inner]
            hit = np.minimum(np.searchsorted(cell, want), len(cell) - 1)
            overlap = np.bincount(np.repeat(np.arange(len(x)), n), cell[hit] == want, len(x)).astype(np.int64)
            for i, j in zip(x[9 * overlap >= 4 * (sizes[x] + sizes[y])], y[9 * overlap >= 4 * (sizes[x] + sizes[y])], strict=True):
                if label[i] != label[j]:
                    links.append((int(i), int(j)))
                    label = np.where(label == max(label[i], label[j]), min(label[i], label[j]), label)

    def apart_columns() -> tuple[np.ndarray, np.ndarray]:
        """(first, end) of the index columns whose rows are not all connected."""
        cut = np.flatnonzero(np.diff(column, prepend=-1))
        if not len(cut):
            return cut, cut
        end = np.append(cut[1:], len(column))
        low, high = np.minimum.reduceat(label[member], cut), np.maximum.reduceat(label[member], cut)
        return cut[low != high], end[low != high]

    for k in range(hubs):
        first, end = apart_columns()
        hub = first + ((end - first - 1) * k) // max(1, hubs - 1)
        n = end - first
        at = np.repeat(first, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        test(member[at], np.repeat(member[hub], n))
    first, end = apart_columns()
    portion_a, portion_b, held = [], [], 0
    for f, e in zip(first, end, strict=True):
        group = member[f:e]
        for i in range(len(group) - 1):
            rest = group[i + 1 :]
            rest = rest[label[rest] != label[group[i]]]
            portion_a.append(np.full(len(rest), group[i]))
            portion_b.append(rest)
            held += len(rest)
            if held > 1_000_000:
                test(np.concatenate(portion_a), np.concatenate(portion_b))
                portion_a, portion_b, held = [], [], 0
    if held:
        test(np.concatenate(portion_a), np.concatenate(portion_b))
    return links


def set_links(docs: DataFrame, sets: DataFrame, text: str = "text", size: int = 5, block_rows: int = 2000) -> DataFrame:
    """(a, b): spanning links between set names. ``sets``: staged output of ``document_sets``."""
    spark = docs.sparkSession
    # one row stands for its class; it is found again by id (null-safe) and text digest
    classes = sets.where("name IS NOT NULL").groupBy("name").agg(
        F.min(F.struct("doc_id", "digest")).alias("row"), F.first("n_shingles").alias("n")
    )
    open_classes = shared_counts(docs, text, size).join(classes, "name").where("5 * shared >= 4 * n")
    wanted = open_classes.select(F.col("row.doc_id").alias("_id"), F.col("row.digest").alias("_of"), F.col("name").alias("_name"))
    texts = docs.select(F.col("doc_id").cast("long").alias("_doc"), text_digest(text).alias("_digest"), F.col(text).alias("_text"))
    same_row = F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_digest") == F.col("_of"))
    texts = squeezed(texts, "_text").join(wanted, same_row).select("_name", "_text")

    def incidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, bodies in slices(batches, 1 << 20):
            h, n, names = shingle_sets([unpress(b) if b else b"" for b in bodies], size)
            same = np.flatnonzero(names.view(np.int64) == np.array(ids, np.int64))  # a repeated id may bring another text
            cut = np.concatenate(([0], np.cumsum(n)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names.view(np.int64)[same]),
                    pa.array(n[same]),
                    pa.array([h[cut[i] : cut[i + 1]].view(np.int64) for i in same], pa.list_(pa.int64())),
                ],
                ["name", "n", "hs"],
            )

    rows = stage(texts.mapInArrow(incidence, "name long, n long, hs array<bigint>").dropDuplicates(["name"]), "jaccard-rows")
    index = stage(rarest(rows), "jaccard-index")
    cells = index.select("name", F.explode("keys").alias("h"))
    hub = cells.groupBy("h").agg(F.min("name").alias("b"), F.count(F.lit(1)).alias("c")).where("c > 1")
    meet = cells.join(hub, "h").select(F.col("name").alias("a"), "b").distinct()
    groups = components(meet)
    groups = stage(groups, "jaccard-groups")
    sizes = groups.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    bins = 4 * width(spark)
    placed = rows.join(index, "name").join(groups.withColumnRenamed("node", "name"), "name").join(sizes, "root")
    many = F.ceil(F.col("size") / F.lit(block_rows)).cast("int")
    mine = F.pmod(F.xxhash64("name"), many).cast("int")
    small = F.array(F.struct(F.pmod(F.xxhash64("root"), F.lit(bins)).alias("g"), F.lit(-1).alias("i"), F.lit(-1).alias("j")))
    large = F.transform(
        F.sequence(F.lit(0), many - 1),
        lambda j: F.struct(F.col("root").alias("g"), F.least(mine, j).alias("i"), F.greatest(mine, j).alias("j")),
    )
    block = F.explode(F.when(F.col("size") <= block_rows, small).otherwise(large)).alias("block")
    in_blocks = placed.select("name", "n", "hs", "keys", block).select("name", "n", "hs", "keys", "block.*")

    def links(table: pa.Table) -> pa.Table:
        names = table.column("name").to_numpy()
        lists = [[x.values.to_numpy() for x in table.column(c).combine_chunks()] for c in ("hs", "keys")]
        ordered_sets = [np.sort(x) for x in lists[0]]
        found = block_links(names, table.column("n").to_numpy(), ordered_sets, lists[1])
        a, b = ([names[p[k]] for p in found] for k in (0, 1))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return in_blocks.groupBy("g", "i", "j").applyInArrow(links, "a long, b long")


def _grouped(docs: DataFrame, text: str = "text", size: int = 5) -> DataFrame:
    """doc_id, digest, n_shingles, r (the group's root name; null for the empty set), component_id."""
    small_batches(docs.sparkSession)
    sets = stage(document_sets(docs, "doc_id", text, size), "jaccard-sets")
    roots = stage(components(set_links(docs, sets, text, size)), "jaccard-roots")
    named = sets.join(roots.withColumnRenamed("node", "name"), "name", "left")
    root = F.coalesce("root", "name")
    first = named.where("name IS NOT NULL").groupBy(root.alias("r")).agg(F.min("doc_id").alias("component_id"))
    out = named.withColumn("r", root).join(first, "r", "left")
    return out.select("doc_id", "digest", "n_shingles", "r", F.coalesce("component_id", "doc_id").alias("component_id"))


def groups_of(docs: DataFrame, text: str = "text", size: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of ``docs`` (columns doc_id and ``text``)."""
    return _grouped(docs, text, size).select("doc_id", "n_shingles", "component_id")


def keep_first_of_groups(docs: DataFrame) -> DataFrame:
    """One row (all columns) of each group of ``docs``: that with the smallest doc_id, one without an id only if none
    of the group has one. Rows without words are groups by themselves; of rows equal in id and text one stays.
    Rows that go are named to every task when their checked size allows; else rows and names meet by id."""
    groups = stage(_grouped(docs), "jaccard-kept")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "digest")).alias("k")
    stays = groups.where("r IS NOT NULL").groupBy("r").agg(first).select(F.col("r").alias("of"), "k")
    same = F.col("doc_id").eqNullSafe(F.col("k.doc_id")) & F.col("digest").eqNullSafe(F.col("k.digest"))
    gone = groups.join(stays, F.col("r") == F.col("of")).where(~same)
    gone = stage(gone.select(F.col("doc_id").alias("gone_id"), F.col("digest").alias("gone_digest")).distinct(), "jaccard-gone")
    mark = unused("digest", docs.columns)
    marked = docs.withColumn(mark, text_digest())
    small = broadcast_if_small(gone, GONE_BYTES, materialize=False)
    if small is gone:  # too many for every executor: the rows meet them by id, with their texts compressed
        marked = squeezed(marked, "text")
    met = marked["doc_id"].cast("long").eqNullSafe(gone["gone_id"]) & marked[mark].eqNullSafe(gone["gone_digest"])
    out = marked.join(small, met, "left_anti")
    repeated = groups.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("c")).agg(F.max("c")).first()[0]
    if repeated and repeated > 1:
        out = out.dropDuplicates(["doc_id", mark])
    out = out.select(*docs.columns)
    return unsqueezed(out, "text") if small is gone else out


def op5_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return groups_of(read_table(spark, sf_dir, "documents"))
