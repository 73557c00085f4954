"""Collocations and their automata against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tierwise.llm import collocations as module
from tierwise.llm.automaton import Transducer
from tierwise.llm.collocations import collocations, op12_collocations


def brute(rows, least=100, longest=5, share=100, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\\x0A-\\x0D]", text):
            ws = re.findall("[^\\x20\\x09]+", piece)
            n[lang] += len(ws)
            for size in range(1, longest + 1):
                f[lang].update(tuple(ws[i : i + size]) for i in range(len(ws) - size + 1))
    out = []
    for lang, counts in f.items():
        cands = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for p, a in cands.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    inside[p[i : i + size]] = max(inside[p[i : i + size]], a)
        scored = []
        for p, a in cands.items():
            if 100 * inside[p] >= share * a and inside[p]:
                continue
            s, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-s, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]], k))
        for rank, (s, a, phrase, left, right, k) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -s, k))
    return sorted(out)


def run(spark, rows, **options):
    docs = spark.createDataFrame([(b, a, 3, "x") for a, b in rows], "text string, lang string, n long, words string")
    out = collocations(docs.repartition(3), **options).select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "cut")
    return sorted(map(tuple, out.collect()))


def corpus(seed, n=120):
    rng = random.Random(seed)
    vocab = ["the", "The", "of", "a", "É", "é", "new", "york", "city", "stock", "x1", "x-2"]
    fixed = ["new york city", "the stock of a", "é a é a é", "of the new york stock"]
    rows = []
    for _ in range(n):
        parts = [rng.choice([*vocab, *fixed]) for _ in range(rng.randrange(60))]
        text = "".join(p + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ",", "\x0b"]) for p in parts)
        rows.append((rng.choice(["en", "en", "de", None, "und"]), text))
    return [*rows, ("en", None), (None, None), ("en", ""), ("xx", " . \n"), rows[0], rows[0]]


@pytest.mark.parametrize(("seed", "options"), [(1, {"least": 5}), (2, {"least": 20, "share": 60}), (3, {"least": 3, "top": 7}), (4, {"least": 2, "longest": 3})])
def test_against_brute_force(spark, seed, options):
    rows = corpus(seed)
    assert run(spark, rows, **options) == brute(rows, **options)


def test_portions_shards_and_bits_do_not_matter(spark, monkeypatch):
    """Small portions and shards (so that some prefixes are heavy), and a bitmap in which names share bits."""
    monkeypatch.setattr(module, "SHARD_GRAMS", 40)
    monkeypatch.setattr(module, "BITS", 64)
    rows = corpus(5)
    monkeypatch.setattr(module.portions, "__defaults__", ("text", "lang", 30))
    assert run(spark, rows, least=4) == brute(rows, least=4)


def test_products_beyond_64_bits(spark):
    """a = 10^4 of n = 2 10^4 ... scaled: the decimal expression itself, at counts no fixture can hold."""
    a, n, left, right = 4 * 10**15, 9 * 10**15, 10**16 - 1, 10**15 + 7
    got = spark.sql(
        f"SELECT (CAST(1000 AS decimal(4,0)) * CAST({a} AS decimal(19,0)) * CAST({n} AS decimal(19,0)))"
        f" div (CAST({left} AS decimal(19,0)) * CAST({right} AS decimal(19,0)))"
    ).first()[0]
    assert got == 1000 * a * n // (left * right)


@pytest.mark.parametrize("rows", [[], [("en", None)], [("en", "one two three")]])
def test_nothing_found(spark, rows):
    assert run(spark, rows) == []


def test_one_phrase_holds_all(spark):
    rows = [("en", "a b " * 200)] * 5
    assert run(spark, rows) == brute(rows)


def test_automata():
    rng = random.Random(7)
    seqs = [tuple(rng.randrange(5) for _ in range(rng.randrange(1, 5))) for _ in range(400)]
    parts = []
    for k in range(0, 400, 50):
        for size in range(1, 5):
            rows = sorted(s for s in seqs[k : k + 50] if len(s) == size)
            if rows:
                columns = [np.array(c, np.uint64) for c in zip(*rows)]
                parts.append(Transducer.unpack(Transducer.from_sorted(columns, np.ones(len(rows), np.int64)).pack()))
    whole = Transducer.unpack(Transducer.union(parts).pack())
    counts = Counter(seqs)
    for size in range(1, 5):
        columns, weight = whole.sequences(size - 1)
        got = dict(zip(zip(*(c.tolist() for c in columns)), weight.tolist()))
        assert got == {s: c for s, c in counts.items() if len(s) == size}
        ask = sorted({tuple(rng.randrange(6) for _ in range(size)) for _ in range(60)})
        acceptor = Transducer.from_sorted([np.array(c, np.uint64) for c in zip(*ask)], np.ones(len(ask), np.int64))
        assert whole.compose(acceptor).tolist() == [counts.get(s, 0) for s in ask]


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["lang"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("lang", "text").collect()]
    assert sorted(map(tuple, op12_collocations(spark, sf).collect())) == [r[:8] for r in brute(rows)]
