"""Host-level quality rules (DataFrame functions only).

Every document is measured against rules on its whole text. Failures are aggregated by host, each
host's failure rate is shrunk with a beta prior fitted to all hosts by the method of moments, and
hosts whose shrunk rate passes a limit are rejected; that verdict is joined back to the documents.

Defined cases: a null text counts as empty; a document without words fails the length rule; a null
host is never rejected (its documents are judged alone); repeated rows are counted and returned as
they are; an empty table gives no rows; other input columns are ignored, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwise.llm.common import SPACES, let, read_table, stage, words

#: Characters counted as symbols.
SYMBOLS = "#*$%&|<>"
WINDOW = 8


def covered_words(windows: Column, size: int = WINDOW) -> Column:
    """Number of words inside windows whose hash occurs twice or more (``windows``: hashes by position)."""

    def same(a: Column, b: Column) -> Column:
        return F.coalesce(a["h"] == b["h"], F.lit(False))

    def repeated(ordered: Column) -> Column:
        kept = F.filter(ordered, lambda e, k: same(F.get(ordered, k - 1), e) | same(F.get(ordered, k + 1), e))
        return F.array_sort(F.transform(kept, lambda e: e["i"]))

    ordered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    start = F.struct(F.lit(-size).alias("last"), F.lit(0).alias("total"))
    return F.aggregate(
        let(ordered, repeated),
        start,
        lambda acc, i: F.struct(i.alias("last"), (acc["total"] + F.least(F.lit(size), i - acc["last"])).alias("total")),
        lambda acc: acc["total"],
    )


def window_hashes(hashes: Column, size: int = WINDOW) -> Column:
    n = F.size(hashes)
    at = F.sequence(F.lit(0), n - size)
    return F.when(
        n >= size, F.transform(at, lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(size)]))
    ).otherwise(F.array().cast("array<bigint>"))


def measure(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """doc_id, host and the counts of the whole text."""
    raw = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(host).alias("host"), raw.alias("t"))
    lines = F.filter(F.split(F.col("t"), "\n", -1), lambda x: F.translate(x, SPACES, "") != "")
    parts = base.select(
        "doc_id",
        "host",
        F.transform(words(F.col("t")), lambda w: F.xxhash64(w)).alias("hashes"),
        F.length(F.translate(F.col("t"), SPACES, "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate(F.col("t"), SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    )
    repeat = let(
        let(F.col("hashes"), window_hashes),
        lambda g: F.when(F.size(F.array_distinct(g)) < F.size(g), covered_words(g)).otherwise(F.lit(0)),
    )
    return parts.select(
        "doc_id",
        "host",
        F.size("hashes").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        repeat.cast("long").alias("n_repeat_words"),
    )


def base_failed(min_words: int = 20, repeat_pct: int = 30) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeat_pct * F.col("n_words"))


def host_verdicts(measured: DataFrame, failed: Column, max_rate: float = 0.5) -> DataFrame:
    """host, host_docs, host_failures, host_rate (shrunk), host_rejected for each non-null host.

    Prior: mean m and variance v of the hosts' raw rates give alpha + beta = m(1-m)/v - 1 (at least
    1; a strength of 1 document per host if the hosts do not differ or there is only one)."""
    hosts = measured.where(F.col("host").isNotNull()).groupBy("host").agg(
        F.count(F.lit(1)).alias("host_docs"), F.sum(F.when(failed, 1).otherwise(0)).alias("host_failures")
    )
    rate = F.col("host_failures") / F.col("host_docs")
    m, v = hosts.agg(F.avg(rate), F.var_pop(rate)).first()
    m = 0.0 if m is None else float(m)
    strength = max(1.0, m * (1 - m) / v - 1) if v else 1.0
    shrunk = (F.col("host_failures") + F.lit(m * strength)) / (F.col("host_docs") + F.lit(strength))
    return hosts.withColumn("host_rate", shrunk).withColumn("host_rejected", F.col("host_rate") > max_rate)


def host_rules(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    min_words: int = 20,
    repeat_pct: int = 30,
    symbol_pct: int = 50,
    dup_line_pct: int = 50,
    max_rate: float = 0.5,
) -> DataFrame:
    """One row per input row: counts, base_failed, rules_failed (array of names), host verdict, kept.

    The counts are staged once, since the host aggregate and the join back both read them. The join
    is left to the optimizer: it broadcasts the host table when its measured size allows, else it
    shuffles and splits the hot host."""
    measured = stage(measure(docs, doc_id, text, host), "host-rules")
    base = base_failed(min_words, repeat_pct)
    rules = {
        "few_words": F.col("n_words") < min_words,
        "repeated_words": 100 * F.col("n_repeat_words") > repeat_pct * F.col("n_words"),
        "symbols": 100 * F.col("n_symbols") > symbol_pct * F.col("n_words"),
        "repeated_lines": 100 * F.col("n_dup_lines") * 10 > dup_line_pct * F.col("n_words"),
    }
    failed = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules.items()]))
    measured = measured.withColumn("base_failed", base).withColumn("rules_failed", failed)
    verdicts = host_verdicts(measured, F.size("rules_failed") > 0, max_rate)
    rejected = F.coalesce(F.col("host_rejected"), F.lit(False))
    return measured.join(verdicts, "host", "left").withColumn("kept", ~F.col("base_failed") & ~rejected)


def op10_host_rules(spark, sf_dir: str) -> DataFrame:
    out = host_rules(read_table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
