"""Rows without an id as bridges, clashing column names, whole words of any length."""

import math
import warnings

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierwise.llm import jaccard_join, lang_id, lm_score, mixing


def words(a, b):
    return [f"w{k}" for k in range(a, b)]


#: Jaccard of neighbours above 0.8, of the outer two below it.
A, B, C = " ".join(words(0, 104)), " ".join(words(6, 110)), " ".join(words(12, 116))


@pytest.mark.parametrize("ids", [(1, 2, 3), (1, None, 3), (None, None, 3), (1, None, None), (None, None, None), (None, 2, 2)])
def test_a_row_without_id_links_like_others(spark, ids):
    rows = list(zip(ids, (A, B, C))) + [(9, "alone here"), (None, "alone there"), (None, None)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, name string, digest int")
    jaccard_join.GONE_BYTES = 0 if ids == (None, 2, 2) else 64 << 20  # beyond the bound the rows are exchanged
    got = {r["n_shingles"]: set() for r in jaccard_join.groups_of(docs).collect()}
    for r in jaccard_join.groups_of(docs).collect():
        got[r["n_shingles"]].add(r["component_id"])
    least = min((i for i in ids if i is not None), default=None)
    assert got == {100: {least}, 1: {9, None}, 0: {None}}
    kept = sorted(((r["doc_id"], r["text"], r["digest"]) for r in jaccard_join.keep_first_of_groups(docs).collect()), key=str)
    group = [k for k in kept if k[1] in (A, B, C)]
    assert len(group) == 1 and group[0][0] == least
    assert [k[1] for k in kept if k[1] not in (A, B, C)].count("alone there") == 1 and len(kept) == 4


def test_mixing_takes_any_column_name(spark):
    rows = [(i, f"some text number {i}", i, i, i) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _draw long, draw long, Draw_ long")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    model = mixing.train(docs, labels, mixing.domain_of_label())
    out = mixing.apply_rates(docs, model, mixing.SHARES)
    assert out.columns == docs.columns and out.count() > 0


def test_unmet_targets_are_warned_of(spark):
    rows = [(i, "good words here" if i % 2 else "bad stuff there", 1) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    model = mixing.train(docs, labels, mixing.domain_of_label())
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        mixing.mix(docs, model, {"clean": -5.0})
    assert any("are not the targets" in str(w.message) for w in seen)


def test_held_out_of_rows_without_id(spark):
    docs = spark.createDataFrame([(None, "a b c", None), (3, "a b c d", "en")], "doc_id long, text string, lang string")
    assert {r["doc_id"]: r["held_out"] for r in lm_score.score(docs).collect()}[None] is True


def model_of(pieces, seed=1):
    codes, starts, lengths = lang_id.marked(pieces)
    keys = np.sort(lang_id._span_hash(codes, starts + 1, lengths - 1))
    rng = np.random.default_rng(seed)
    return lang_id.Model(["a", "b"], keys, rng.dirichlet(np.ones(len(keys)), 2).T, longest=max(map(len, pieces)))


def test_a_window_over_a_long_word_loses_no_segmentation():
    pieces = ["▁", "▁a", "ab", "ba", "a", "abab", "bbbbbbbbbbbbbbbbbbbbb", "c"]
    model = model_of(pieces)
    rng = np.random.default_rng(3)
    word = "".join(rng.choice(list("abbc"), 3000))
    whole = model.word_scores(*lang_id.marked([word]))
    for part in (1, 7, 21, 100, 2999, 3001):
        model.part = part
        assert np.allclose(model.word_scores(*lang_id.marked([word])), whole, rtol=1e-9)


def test_long_words_train_like_short_ones():
    """Expected counts of a word that overflows doubles are those of its logarithms; both sum to its pieces."""
    begin, end = np.array([0, 0, 1, 1, 2]), np.array([1, 2, 2, 3, 3])
    probs = np.array([[0.5, 0.1], [0.2, 0.3], [0.4, 0.4], [0.1, 0.2], [0.3, 0.9]])
    paths = [(0, 2, 4), (1, 4), (0, 3)]
    share = np.zeros((5, 2))
    for k in range(2):
        mass = [math.prod(probs[e, k] for e in p) for p in paths]
        for p, m in zip(paths, mass):
            for e in p:
                share[e, k] += m / sum(mass)
    assert np.allclose(lang_id._log_shares(begin, end, probs, 3), share)
    counts = [("a", "ab" * 40, 3), ("b", "ba" * 9000, 2), ("b", "abc", 1), ("a", "cab", 2)]
    model = lang_id.fit(counts, ["▁", "ab", "ba", "a", "b", "abab", "c"], rounds=2)
    assert np.isfinite(model.probs).all() and np.allclose(model.probs.sum(0), 1)
    codes, starts, lengths = lang_id.marked(["ab", "ba", "abab", "c"])
    at = np.searchsorted(model.keys, lang_id._span_hash(codes, starts + 1, lengths - 1))
    assert model.probs[at[:3], 1].sum() > 0.9 > 0.1 > model.probs[at[3], 1]  # the 18,000 letters count


def test_vocabulary_keeps_pieces_of_any_length():
    import sentencepiece

    path = lang_id.vocabulary_file()
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    longest = max(len(p) for p in (model.id_to_piece(i) for i in range(model.get_piece_size())) if p.lstrip("▁").isalpha())
    assert max(map(len, lang_id.pieces_of(path))) == longest


def test_lang_id_of_rows_without_id(spark):
    docs = spark.createDataFrame([(None, "a b c", "en", 1), (3, "a b c d", "en", 2)], "doc_id long, text string, lang string, score long")
    model = lang_id.train(docs, F.lit(True))
    assert lang_id.keep_identified(docs, model).columns == docs.columns
