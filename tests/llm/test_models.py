"""Language ID, quality and mixing: brute-force checks of the algorithms and held-out accuracy."""

import itertools
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierwise.llm import lang_id, mixing, quality_crf

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def tiny_model():
    pieces = ["▁", "▁a", "a", "b", "ab", "ba", "aba"]
    codes, starts, lengths = lang_id.marked(pieces)
    keys = lang_id._span_hash(codes, starts + 1, lengths - 1)
    rng = np.random.default_rng(0)
    probs = rng.dirichlet(np.ones(len(pieces)), 2).T
    order = np.argsort(keys)
    return lang_id.Model(["x", "y"], keys[order], probs[order]), {p: probs[i] for i, p in enumerate(pieces)}


def all_segmentations(word, probs, unknown, k):
    total = 0.0
    n = len(word)
    for cuts in itertools.product([False, True], repeat=n - 1):
        parts, start = [], 0
        for i, c in enumerate([*cuts, True]):
            if c:
                parts.append(word[start : i + 1])
                start = i + 1
        p = 1.0
        for part in parts:
            p *= probs[part][k] if part in probs else (unknown if len(part) == 1 else 0.0)
        total += p
    return total


@pytest.mark.parametrize("word", ["a", "b", "ab", "abab", "abacaba", "ccc", "ababababab"])
def test_word_probability_sums_all_segmentations(word):
    model, probs = tiny_model()
    codes, starts, lengths = lang_id.marked([word])
    got = model.word_scores(codes, starts, lengths)[0]
    want = [math.log(all_segmentations("▁" + word, probs, model.unknown, k)) for k in range(2)]
    assert got == pytest.approx(want, rel=1e-9)


def test_long_words_stay_in_range_and_parts_agree():
    model, _ = tiny_model()
    codes, starts, lengths = lang_id.marked(["z" * 3000, "ab" * 5000])
    scores = model.word_scores(codes, starts, lengths)
    assert np.isfinite(scores).all()
    assert scores[0] == pytest.approx([3000 * math.log(model.unknown)] * 2, rel=0.01)


def test_expectation_maximisation_does_not_lose_likelihood():
    counts = [("x", w, n) for w, n in (("ab", 9), ("aba", 5), ("b", 3))] + [("y", w, n) for w, n in (("ba", 7), ("a", 4))]

    def likelihood(rounds):
        m = lang_id.fit(counts, ["▁", "▁a", "a", "b", "ab", "ba", "aba"], rounds, prior=1e-9)
        codes, starts, lengths = lang_id.marked([w for _, w, _ in counts])
        s = m.word_scores(codes, starts, lengths)
        return sum(n * s[i, m.langs.index(lang)] for i, (lang, _, n) in enumerate(counts))

    values = [likelihood(r) for r in range(5)]
    assert all(b >= a - 1e-6 for a, b in zip(values, values[1:]))


def test_language_of_held_out_documents(spark, table):
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    model = lang_id.train(table, ~held, sample_docs=100)
    rows = lang_id.predict(table.where(held), model).join(table.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    odd = [(1, None), (2, ""), (3, "123 %% !!"), (4, "x" * 9000), (4, "x" * 9000), (5, "東京 ℵ"), (6, "the and with this for")]
    docs = spark.createDataFrame([(i, t, 0.1, "q") for i, t in odd], "doc_id long, text string, score double, lang_pred string")
    got = {r["doc_id"]: r for r in lang_id.predict(docs, model).collect()}
    assert [got[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and got[1]["score"] == 0
    assert got[4]["lang_pred"] != "und" and got[6]["lang_pred"] == "en"
    assert lang_id.predict(docs, model).count() == len(odd) and lang_id.predict(docs.limit(0), model).count() == 0
    kept = lang_id.keep_identified(docs, model)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} >= {6} and not {1, 2, 3} & {r["doc_id"] for r in kept.collect()}
    none = lang_id.train(docs.withColumn("lang", F.lit(None).cast("string")), F.lit(True))
    assert {r["lang_pred"] for r in lang_id.predict(docs, none).collect()} == {"und"}


def test_chain_marginals_match_all_labelings():
    rng = np.random.default_rng(3)
    owner = np.array([0, 0, 0, 0, 2, 3, 3])
    emit, move = rng.normal(size=7), rng.normal(size=(2, 2))
    good, steps, z = quality_crf.chain(emit, move, owner)
    want_steps, want_z = np.zeros((2, 2)), 0.0
    for o in (0, 2, 3):
        at = np.flatnonzero(owner == o)
        weights = {}
        for y in itertools.product([0, 1], repeat=len(at)):
            s = sum(emit[i] for i, v in zip(at, y) if v) + sum(move[a, b] for a, b in zip(y, y[1:]))
            weights[y] = math.exp(s)
        total = sum(weights.values())
        want_z += math.log(total)
        for k, i in enumerate(at):
            assert good[i] == pytest.approx(sum(w for y, w in weights.items() if y[k]) / total)
        for y, w in weights.items():
            for a, b in zip(y, y[1:]):
                want_steps[a, b] += w / total
    assert steps == pytest.approx(want_steps) and z == pytest.approx(want_z)


def test_quality_of_held_out_documents(spark, table, labels):
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))
    model = quality_crf.train(table, labels, fold != 0, sample_docs=400)
    rows = quality_crf.score(table, model).join(labels, "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    good = [r["score"] for r in held if r["quality"] == 1]
    bad = [r["score"] for r in held if r["quality"] == 0]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc >= 0.95
    odd = [(1, None), (2, ""), (3, " \n \n"), (4, "one"), (4, "one"), (5, "y " * 40000), (6, "a\n" * 3000)]
    docs = spark.createDataFrame([(i, t, 2.0) for i, t in odd], "doc_id long, text string, score double")
    out = quality_crf.score(docs, model).collect()
    assert len(out) == len(odd) and all(0 <= r["score"] <= 1 for r in out)
    assert {r["score"] for r in out if r["doc_id"] <= 3} == {model.prior}
    assert quality_crf.score(docs.limit(0), model).count() == 0
    nothing = quality_crf.train(table, labels.where("quality = 1"), fold != 0)
    assert {r["score"] for r in quality_crf.score(docs, nothing).collect()} == {0.99}
    assert quality_crf.train(table, labels.limit(0), fold != 0).prior == 0.5


def test_rates_meet_targets_and_are_the_nearest(spark):
    rng = np.random.default_rng(5)
    p = rng.dirichlet([0.3, 0.3, 0.3], 300)
    tokens = rng.integers(0, 500, 300)
    df = spark.createDataFrame([(i, int(t), [float(x) for x in q]) for i, (t, q) in enumerate(zip(tokens, p))], "doc_id long, tokens long, p array<double>")
    natural = tokens @ p
    targets = natural * np.array([1.0, 0.4, 1.5])
    collected, expected = mixing.fit_rates(df, targets)
    assert expected == pytest.approx(targets, rel=1e-6)
    rates = np.array([r["rate"] for r in df.withColumn("rate", mixing.rate_of(collected)).orderBy("doc_id").collect()])
    assert (rates >= 0).all() and (rates * tokens) @ p == pytest.approx(targets, rel=1e-6)
    # no nonnegative rates with these totals are nearer to one: random feasible moves cost more
    null = np.linalg.svd((tokens[:, None] * p).T)[2][3:]
    for _ in range(50):
        move = null.T @ rng.normal(size=len(null)) * 0.01
        other = rates + move
        if (other >= 0).all():
            assert (tokens * (other - 1) ** 2).sum() >= (tokens * (rates - 1) ** 2).sum() - 1e-6


def test_targets_out_of_reach_end_near(spark):
    df = spark.createDataFrame([(1, 10, [1.0, 0.0]), (2, 0, [0.0, 1.0])], "doc_id long, tokens long, p array<double>")
    collected, expected = mixing.fit_rates(df, np.array([5.0, 100.0]))
    assert expected[0] == pytest.approx(5.0, abs=1e-3) and expected[1] == 0


def test_domains_and_copies(spark, table, labels):
    model = mixing.train(table, labels, mixing.domain_of_label())
    out, report = mixing.mix(table, model, mixing.SHARES)
    rows = out.join(labels, "doc_id").collect()
    clean = [r["rate"] for r in rows if r["quality"] == 1 and r["toxic"] == 0]
    other = [r["rate"] for r in rows if r["quality"] == 0 or r["toxic"] == 1]
    assert np.mean(np.array(clean) >= 0.5) >= 0.98 and np.mean(np.array(other) < 0.5) >= 0.9
    for v in report.values():
        assert v["expected"] == pytest.approx(v["target"], rel=1e-3)
    odd = [(1, None), (2, ""), (3, "x " * 50000), (4, "plain words here"), (4, "plain words here")]
    docs = spark.createDataFrame([(i, t, "p") for i, t in odd], "doc_id long, text string, tokens string")
    mixed = mixing.apply_rates(docs, model, {})
    assert mixed.columns == docs.columns and mixed.count() == len(odd)  # natural targets change nothing
    doubled = mixing.apply_rates(docs, model, {}, total=2.0)
    assert doubled.where("doc_id in (3, 4)").count() == 6
    assert mixing.apply_rates(docs.limit(0), model, mixing.SHARES).count() == 0
    alone = mixing.train(table, labels.limit(0), mixing.domain_of_label())
    assert alone.names == ["unlabelled"]
    assert mixing.posteriors(docs, alone).select("p").distinct().collect()[0]["p"] == [1.0]
