"""Substring dedup against brute force over sets of windows."""

import hashlib
import random
import re

import pytest

from tierwise.llm import substring_dedup
from tierwise.llm.substring_dedup import drop_repeats, op13_substring_dedup, repeated_windows

FAR = (1 << 63) - 1


def brute(rows, length=13):
    """{row: (id, n_words, n_removed, kept)} and the longest doubled length with a repeated window."""
    words = [re.findall("[^\\x20\\x09-\\x0D]+", t or "") for _, t in rows]
    ids = [FAR if i is None else i for i, _ in rows]
    first, out = {}, []
    for i, ws in zip(ids, words):
        for k in range(len(ws) - length + 1):
            w = tuple(ws[k : k + length])
            first[w] = min(first.get(w, i), i)
    longest = [0] * len(rows)
    size = length
    while True:
        seen = {}
        for ws in words:
            for k in range(len(ws) - size + 1):
                w = tuple(ws[k : k + size])
                seen[w] = seen.get(w, 0) + 1
        hit = [any(seen[tuple(ws[k : k + size])] > 1 for k in range(len(ws) - size + 1)) for ws in words]
        if not any(hit):
            break
        longest = [size if h else x for h, x in zip(hit, longest)]
        size *= 2
    for (i, _), own, ws, far in zip(rows, ids, words, longest):
        drop = set()
        for k in range(len(ws) - length + 1):
            if first[tuple(ws[k : k + length])] < own:
                drop.update(range(k, k + length))
        kept = " ".join(w for k, w in enumerate(ws) if k not in drop)
        out.append((i, len(ws), len(drop), far, kept))
    return out


def run(spark, rows, length=13):
    docs = spark.createDataFrame([(t, i, 1, "x") for i, t in rows], "text string, doc_id long, n long, spans string")
    return [tuple(r) for r in drop_repeats(docs.repartition(3), length=length).collect()]


def key(r):
    return (r[0] is None, r[0] or 0, *r[1:])


def corpus(seed, n=60):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(30)] + ["É", "é", "W1"]
    passages = [" ".join(rng.choices(vocab, k=k)) for k in (13, 14, 27, 60, 130)]
    rows = []
    for i in range(n):
        parts = [" ".join(rng.choices(vocab, k=rng.randrange(20))) for _ in range(3)]
        for p in rng.sample(passages, rng.randrange(3)):
            parts.insert(rng.randrange(len(parts) + 1), p)
        rows.append((rng.choice([i, i, i, None, 5]), rng.choice([" ", "\n", "\t\x0b", "  "]).join(parts)))
    return rows + [rows[3]] * 4 + [(7, rows[9][1]), (None, rows[9][1]), (900, None), (901, ""), (902, " \n "), (None, None)]


@pytest.mark.parametrize(("seed", "length"), [(1, 13), (2, 13), (3, 3), (4, 1), (5, 8)])
def test_against_brute_force(spark, seed, length):
    rows = corpus(seed)
    assert sorted(run(spark, rows, length), key=key) == sorted(brute(rows, length), key=key)


def test_one_word_repeated(spark):
    """All windows of all documents have one name; overlaps inside a document are no reason to remove."""
    rows = [(i, "a " * (40 + i)) for i in range(1, 6)]
    got = {r[0]: r for r in run(spark, rows)}
    assert got[1][2] == 0 and all(got[i][2] == 40 + i and got[i][4] == "" for i in range(2, 6))


def test_portions_do_not_matter(spark, monkeypatch):
    """Documents dealt in many small portions and shards, as on a large table."""
    rows = corpus(8)
    monkeypatch.setattr(substring_dedup, "SHARD_BYTES", 500)
    monkeypatch.setattr(substring_dedup, "SHARD_WINDOWS", 20)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    expected = brute(rows)
    levels = repeated_windows(docs, portion_words=50)
    assert [n for n, _ in levels] == sorted({13 * 2**k for k in range(9) if 13 * 2**k <= max(r[3] for r in expected)})
    assert sorted(run(spark, rows), key=key) == sorted(expected, key=key)


def test_levels_end(spark):
    assert repeated_windows(spark.createDataFrame([(1, "a b c"), (2, "a b c")], "doc_id long, text string")) == []


def test_empty_table(spark):
    assert run(spark, []) == []


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    expected = [(i, n, k, hashlib.sha256(t.encode()).hexdigest(), far) for i, n, k, far, t in brute(rows)]
    assert sorted(map(tuple, op13_substring_dedup(spark, sf).collect())) == sorted(expected)
