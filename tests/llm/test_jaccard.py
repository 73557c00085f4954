"""The Jaccard join against all pairs, on texts with copies, near copies, shared passages and edge cases."""

import random
import re

import numpy as np
import pytest

from tierwise.llm import jaccard_join

WORD = re.compile("[^\x20\x09-\x0d]+")


def sets(texts):
    out = []
    for t in texts:
        w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        out.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    return out


def brute(ids, texts):
    s = sets(texts)
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            inter = len(s[i] & s[j])
            if s[i] and s[j] and 100 * inter >= 80 * (len(s[i]) + len(s[j]) - inter):
                root[find(i)] = find(j)
    low = {}
    for i, d in enumerate(ids):
        low[find(i)] = min(d, low.get(find(i), d))
    return sorted((d, len(s[i]), low[find(i)]) for i, d in enumerate(ids))


def corpus(seed=3):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(400)}"
    passage = " ".join(word() for _ in range(60))
    texts = [None, "", " \n", "Four words only here", "four WORDS only\there", "one two three four five", "é " * 40, "É " * 40, "x" * 50000]
    for _ in range(12):
        base = [word() for _ in range(rng.randrange(20, 120))]
        texts.append(" ".join(base))
        for _ in range(rng.randrange(0, 9)):
            copy = list(base)
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy) + (" " + word()) * rng.randrange(3))
        texts.append(passage + " " + " ".join(word() for _ in range(30)))
        texts.append(" ".join(base[:60]) + " " + passage)
    texts += texts[20:30]
    return texts


@pytest.mark.parametrize("block_rows", [2000, 7])
def test_groups_match_all_pairs(spark, block_rows, monkeypatch):
    texts = corpus()
    ids = [i * 3 + 1 for i in range(len(texts))]
    ids[-1] = ids[-2]  # a repeated id with another text
    rows = [(d, t, 0, "z") for d, t in zip(ids, texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long, name string").repartition(3)
    plain = jaccard_join.set_links
    monkeypatch.setattr(jaccard_join, "set_links", lambda *a, **k: plain(*a, **k, block_rows=block_rows))
    got = sorted(tuple(r) for r in jaccard_join.groups_of(docs).collect())
    assert got == brute(ids, texts)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard_join.groups_of(docs).count() == 0


def test_one_of_each_group_stays_with_all_columns(spark):
    texts = corpus()
    rows = [(i, t, None if i % 3 else "en", i) for i, t in enumerate(texts)] + [(0, texts[0], "de", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long").repartition(2)
    out = jaccard_join.keep_first_of_groups(docs)
    assert out.columns == docs.columns
    got = {r["doc_id"]: r for r in out.collect()}
    want = {c for _, _, c in brute(list(range(len(texts))), texts)}
    assert set(got) == want and out.count() == len(want)
    assert all(got[i]["text"] == texts[i] for i in got)


def test_entries_round_trip():
    rng = np.random.default_rng(1)
    keys = np.sort(rng.integers(0, 2**48, 5000, dtype=np.uint64))
    names = rng.integers(0, 2**63, 70, dtype=np.uint64)
    row = rng.integers(0, 70, 5000, dtype=np.uint64)
    k, n = jaccard_join.unpack_entries(jaccard_join.pack_entries(keys, row, names))
    assert (k == keys).all() and (n == names[row.astype(int)]).all()
