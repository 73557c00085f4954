"""The trie against sorted arrays, and document scores against the model's formula."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tierwise.llm import lm_score
from tierwise.llm.eliasfano import EliasFano, Level

WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.mark.parametrize("top", [1, 3, 200, 10**6, 2**63])
@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 65, 1000])
def test_elias_fano_get_and_successor(n, top):
    rng = np.random.default_rng(n + top % 97)
    values = np.sort(rng.integers(0, top, n, dtype=np.uint64))
    ef = EliasFano.build(values)
    if n:
        assert (ef.get(np.arange(n)) == values).all()
    ask = np.concatenate([values, rng.integers(0, top, 50, dtype=np.uint64), np.array([0, top, 2 * top - 1], np.uint64)])
    at, equal = ef.successor(ask)
    want = np.searchsorted(values, ask)
    assert (at == want).all()
    assert (equal == np.isin(ask, values)).all()


def test_level_finds_children_of_their_parent_only():
    rng = np.random.default_rng(2)
    pairs = sorted({(int(a), int(b)) for a, b in zip(rng.integers(0, 50, 600), rng.integers(1, 40, 600))})
    level = Level.build(60, np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs]))
    ask = [(a, b) for a in range(60) for b in range(1, 42)]
    got = level.find(np.array([a for a, _ in ask]), np.array([b for _, b in ask]))
    index = {p: i for i, p in enumerate(pairs)}
    assert got.tolist() == [index.get(p, -1) for p in ask]


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def model(rows, m1=20.0, m2=0.005):
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows}
    toks = [(i, WORD.findall(lower(t)) + ["</s>"]) for i, t in rows]
    c1, c2, c3 = Counter(), Counter(), Counter()
    texts = 0
    for i, t in toks:
        if not held[i]:
            texts += 1
            full = ["<s>", "<s>", *t]
            c1.update(t)
            c2.update(zip(full[1:], full[2:]))
            c3.update(zip(full, full[1:], full[2:]))
    n, v = sum(c1.values()), len(c1)
    once, twice = (sum(x == k for x in c1.values()) for k in (1, 2))
    d = min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5
    out = []
    for i, t in toks:
        base = sum(math.log10((c1[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)
        s, full = 0.0, ["<s>", "<s>", *t]
        for u, p, w in zip(full, full[1:], full[2:]):
            p1 = (c1[w] - d) / n if c1[w] else d * v / n
            cuv, cv = (texts, texts) if p == "<s>" else (c2[(u, p)], c1[p])
            s += math.log10((c3[(u, p, w)] + m2 * c2[(p, w)] + m1 * p1) / (cuv + m2 * cv + m1))
        out.append((i, held[i], len(t), sum(c1[w] > 0 for w in t), n, base, s))
    return sorted(out)


def test_scores_match_the_formula(spark):
    import random

    rng = random.Random(1)
    words = [f"w{min(rng.randrange(60), rng.randrange(60))}" for _ in range(4000)] + ["Rare" + str(i) for i in range(40)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 60)))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, " \n\x0b "), (203, "the the " * 4000), (204, "É é É"), (7, rows[7][1])]
    docs = spark.createDataFrame([(i, t, 5, "x") for i, t in rows], "doc_id long, text string, n long, body string").repartition(3)
    got = sorted(tuple(r) for r in lm_score.score(docs, portion=900).collect())
    for a, b in zip(got, model(rows), strict=True):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5], abs=1e-6, rel=1e-9)
        assert a[6] == pytest.approx(b[6], abs=2e-3 * a[2])


def test_no_rows_and_no_training_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert lm_score.score(docs).count() == 0
    held = next(i for i in range(50) if zlib.crc32(str(i).encode()) % 5 == 1)
    row = lm_score.score(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).first()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (3, 0, 0)
    assert row["score"] == pytest.approx(0.0, abs=1e-9)
