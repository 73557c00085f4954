"""SimHash fingerprints and a Hamming-radius search over permuted block tables (DataFrame functions only).

Terms are shingles of five words (a shorter text is one term), weighted by how often they occur. Each
occurrence votes +1 or -1 on each of 64 bits by its hash; a bit is set when the set votes outnumber
the others. The votes are summed two bits to a 64-bit word (32-bit lanes), so a row costs 32 additions.

Search: a fingerprint is cut into ``blocks`` blocks. Two fingerprints within ``radius`` bits differ in
at most ``radius`` blocks, so some choice of ``blocks - radius`` blocks is equal: there is one table
for each choice, keyed by those blocks, and joining on the keys finds every pair (then verified).
Three bits find almost identical texts only: about 1% of the pairs at shingle Jaccard 0.8, a third at 0.95
(README, known limits).

Defined cases: a null text counts as empty; a text without words has the all-zero fingerprint;
repeated rows are documents of their own (ordered by doc_id, then text hash); documents without an id
come before all others and are no search queries; an empty table gives no rows; other input columns are
ignored.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierwise.llm.common import let, read_table, stage, width, words

BITS = 64
LANES = 0x0000000100000001


def shingle_hashes(text: Column, size: int = 5) -> Column:
    def hashes(hs: Column) -> Column:
        n = F.size(hs)
        at = F.sequence(F.lit(0), n - size)
        return (
            F.when(n == 0, F.array().cast("array<bigint>"))
            .when(n < size, F.array(F.xxhash64(hs)))
            .otherwise(F.transform(at, lambda i: F.xxhash64(*[F.get(hs, i + j) for j in range(size)])))
        )

    return let(F.transform(words(text), lambda w: F.xxhash64(w)), hashes)


def fingerprints(rows: DataFrame, keys: list[str], text: str = "text", size: int = 5) -> DataFrame:
    """``keys`` and fp (long) for the text of each distinct key. The terms of a text are summed in the
    task that reads it; only one row of sums for a key is exchanged."""
    terms = rows.select(*keys, F.explode_outer(shingle_hashes(F.col(text), size)).alias("h"))
    sums = [F.sum(F.shiftrightunsigned("h", j).bitwiseAND(F.lit(LANES))).alias(f"s{j}") for j in range(BITS // 2)]
    votes = terms.groupBy(*keys).agg(F.count("h").alias("n"), *sums)
    fp = F.lit(0).cast("long")
    for j in range(BITS // 2):
        for lane, bit in ((F.col(f"s{j}").bitwiseAND(F.lit(0xFFFFFFFF)), j), (F.shiftrightunsigned(f"s{j}", 32), j + 32)):
            value = (1 << bit) - (1 << 64 if bit == 63 else 0)
            fp = fp.bitwiseOR(F.when(2 * lane > F.col("n"), F.lit(value).cast("long")).otherwise(F.lit(0).cast("long")))
    return votes.select(*keys, fp.alias("fp"))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits, 0 to 1."""
    return 1.0 - hamming(a, b) / F.lit(float(BITS))


def as_text(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def block_masks(radius: int = 3, blocks: int = 5) -> list[int]:
    """Signed 64-bit masks, one for each choice of ``blocks - radius`` blocks."""
    if blocks <= radius:
        raise ValueError("blocks must exceed radius")
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    each = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(edges, edges[1:], strict=False)]
    masks = [sum(c) for c in combinations(each, blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def block_tables(prints: DataFrame, masks: list[int]) -> DataFrame:
    """All tables in one DataFrame: the columns of ``prints`` (with fp), table number and block key."""
    rows = F.array(*[F.struct(F.lit(i).alias("block_table"), F.col("fp").bitwiseAND(F.lit(m)).alias("block_key")) for i, m in enumerate(masks)])
    return prints.withColumn("_t", F.explode(rows)).select(*prints.columns, "_t.block_table", "_t.block_key")


def within_radius(queries: DataFrame, index: DataFrame, radius: int = 3, blocks: int = 5) -> DataFrame:
    """(fp, near_fp, distance) for every distinct query fingerprint and every distinct fingerprint of
    ``index`` within ``radius`` bits, itself included. A pair that meets in several tables is made in the
    first of them only. Copies are one fingerprint here; join ``index`` back to name the documents."""
    masks = block_masks(radius, blocks)
    q = block_tables(queries.select("fp").distinct(), masks).alias("q")
    x = block_tables(index.select("fp").distinct(), masks).alias("x")
    diff = F.col("q.fp").bitwiseXOR(F.col("x.fp"))
    first = F.coalesce(*[F.when(diff.bitwiseAND(F.lit(m)) == 0, F.lit(i)) for i, m in enumerate(masks)])
    same = (F.col("q.block_table") == F.col("x.block_table")) & (F.col("q.block_key") == F.col("x.block_key"))
    pairs = q.join(x, same & (F.bit_count(diff) <= radius) & (first == F.col("q.block_table")))
    return pairs.select(F.col("q.fp").alias("fp"), F.col("x.fp").alias("near_fp"), F.bit_count(diff).alias("distance"))


def with_next(docs: DataFrame, cells_per_bucket: int = 64) -> DataFrame:
    """doc_id, pos (its place: the id, or one below all ids), th (text hash), t, next_pos, next_th, next_t:
    the following document by (pos, th), after the last the first, and (bucket, row), which name one row
    each: of equal rows too, whose other columns are all alike.

    The range of pos is cut into equal cells; neighbouring cells are joined to buckets of about equal row
    counts (only cell counts reach the driver, bounded by the cell number). A bucket is one window; the
    first document of each bucket is copied to the end of the bucket before it."""
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("t")
    ).withColumn("th", F.xxhash64("t"))
    low, high, rows = base.agg(F.min("doc_id"), F.max("doc_id"), F.count(F.lit(1))).first()
    low, high = (low or 0) - 1, high or 0
    base = base.withColumn("pos", F.coalesce("doc_id", F.lit(low)))
    buckets = 4 * width(docs.sparkSession)
    cells = max(1, min(cells_per_bucket * buckets, 100_000, high - low + 1))
    span = -(-(high - low + 1) // cells)
    cell = F.floor((F.col("pos") - F.lit(low)) / F.lit(span)).cast("int")
    counts = dict(base.groupBy(cell.alias("c")).count().collect())
    of_cell, bucket, held = [], 0, 0
    for c in range(cells):
        n = counts.get(c, 0)
        if held and held + n > rows / buckets:
            bucket, held = bucket + 1, 0
        of_cell.append(bucket)
        held += n
    placed = base.withColumn("bucket", F.get(F.lit(of_cell).cast("array<int>"), cell))
    firsts = placed.groupBy("bucket").agg(F.min(F.struct("pos", "th")).alias("k")).select("bucket", "k.*").collect()
    firsts.sort(key=lambda r: r["bucket"])
    moved = {(r["pos"], r["th"]): firsts[i - 1]["bucket"] for i, r in enumerate(firsts)}  # the first goes to the last
    to = docs.sparkSession.createDataFrame([(p, h, b) for (p, h), b in moved.items()], "pos long, th long, to int")
    copies = placed.where(F.col("pos").isin([p for p, _ in moved])).join(F.broadcast(to), ["pos", "th"])
    copies = copies.select("doc_id", "t", "th", "pos", F.col("to").alias("bucket"), F.lit(1).alias("copy"))
    copies = copies.dropDuplicates(["pos", "th"])
    order = Window.partitionBy("bucket").orderBy("copy", "pos", "th")
    both = placed.withColumn("copy", F.lit(0)).unionByName(copies)
    out = both.select(
        "doc_id", "pos", "th", "t", "copy", "bucket",
        F.row_number().over(order).alias("row"),
        F.lead("pos").over(order).alias("next_pos"),
        F.lead("th").over(order).alias("next_th"),
        F.lead("t").over(order).alias("next_t"),
    )
    return out.where("copy = 0").drop("copy")


def edited(text: Column, following: Column) -> Column:
    """The last floor(n/2) code points replaced by the first as many (or all) of ``following``."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(following, F.lit(1), half))


def op2_simhash(spark, sf_dir: str, radius: int = 3, query_every: int = 50) -> DataFrame:
    """Fingerprint of each text and of its edited text, their likeness, the likeness to the next
    document, and near_docs: how many other documents lie within ``radius`` bits, for the documents
    whose id is a multiple of ``query_every`` (null for the rest)."""
    rows = with_next(read_table(spark, sf_dir, "documents"))
    rows = rows.withColumn("e", edited(F.col("t"), F.col("next_t")))
    kinds = F.array(F.struct(F.lit(0).alias("kind"), F.col("t").alias("x")), F.struct(F.lit(1).alias("kind"), F.col("e").alias("x")))
    meta = ["bucket", "row", "doc_id", "pos", "th", "next_pos", "next_th", "n_chars", "edited_sha256"]
    texts = rows.select(
        "bucket", "row", "doc_id", "pos", "th", "next_pos", "next_th",
        F.length("t").cast("long").alias("n_chars"), F.sha2("e", 256).alias("edited_sha256"), F.explode(kinds).alias("k"),
    ).select(*meta, "k.kind", F.col("k.x").alias("text"))
    prints = fingerprints(texts, [*meta, "kind"])
    own = stage(
        prints.groupBy(*meta).agg(
            F.max(F.when(F.col("kind") == 0, F.col("fp"))).alias("fp"),
            F.max(F.when(F.col("kind") == 1, F.col("fp"))).alias("efp"),
        ),
        "simhash",
    )
    following = own.select(F.col("pos").alias("next_pos"), F.col("th").alias("next_th"), F.col("fp").alias("nfp"))
    following = following.dropDuplicates(["next_pos", "next_th"])
    asked = F.col("doc_id") % query_every == 0
    sizes = own.groupBy(F.col("fp").alias("near_fp")).agg(F.count(F.lit(1)).alias("docs"))
    near = within_radius(own.where(asked), own, radius).join(sizes, "near_fp")
    near = near.groupBy("fp").agg((F.sum("docs") - 1).alias("near_docs"))
    out = own.join(following, ["next_pos", "next_th"], "left").join(near, "fp", "left")
    return out.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("fp")).alias("fingerprint"),
        as_text(F.col("efp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("efp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("nfp")).alias("near_next"),
        F.when(asked, F.col("near_docs")).alias("near_docs"),
    )
