"""Whitening against whole-number brute force, and the defined cases."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import types as T

from tierwise.llm import whitening
from tierwise.llm.whitening import fit, integers, op11_whitening, whiten

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("i", T.StringType()),
        T.StructField("n", T.LongType()),
    ]
)


def frame(spark, vectors):
    return spark.createDataFrame([(k, v, "x", k) for k, v in vectors], SCHEMA).repartition(3)


def brute(vectors):
    """(n, sums, covariance as fractions, deviations) from Python's whole numbers."""
    x = [[int(np.floor(np.float64(np.float32(c)) * 64)) + 1_000_000 for c in v] for v in vectors]
    n, size = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(size)]
    z = [[n * r[i] - s[i] for i in range(size)] for r in x]
    cov = [[Fraction(sum(r[i] * r[j] for r in z), n**3) for j in range(size)] for i in range(size)]
    return n, s, cov, [sum(c * c for c in r) for r in z]


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(5)
    mix = rng.normal(size=(6, 6))
    return [[float(c) for c in np.float32(v)] for v in rng.normal(size=(300, 6)) @ mix]


def test_covariance_is_exact(spark, vectors):
    model = fit(frame(spark, list(enumerate(vectors))))
    n, _, cov, _ = brute(vectors)
    assert model.n == n
    assert np.array_equal(model.covariance, np.array([[float(c) for c in r] for r in cov]))


def test_rows_against_brute_force(spark, vectors):
    n, s, cov, deviations = brute(vectors)
    values, axes = np.linalg.eigh(np.array([[float(c) for c in r] for r in cov]))
    values, axes = values[::-1], axes[:, ::-1]
    x = np.array([integers(np.array(v)) for v in np.float32(vectors)], dtype=np.float64)
    expected = (x - np.array([si / n for si in s])) @ axes / np.sqrt(values)
    rows = whiten(frame(spark, list(enumerate(vectors)))).collect()
    assert len(rows) == 300 * 6
    got = np.zeros((300, 6))
    for r in rows:
        got[r["vec_id"], r["component"] - 1] = r["whitened"]
        assert r["n"] == n and r["deviation"] == deviations[r["vec_id"]] == int(r["deviation_exact"])
        assert abs(r["explained"] - values[r["component"] - 1] / values.sum()) < 1e-12
        assert r["identity_error"] < 1e-9
    sign = np.sign((got * expected).sum(axis=0))
    assert np.abs(got * sign - expected).max() < 1e-8


def test_far_from_zero_keeps_every_digit(spark):
    """Means of 10^12 units, spread of a few: squares before centring would lose the spread in 64 bits."""
    rng = np.random.default_rng(9)
    vectors = [[float(2**34 + 2**12 * int(a)), float(2**34 + 2**12 * int(b))] for a, b in rng.integers(0, 9, (50, 2))]
    model = fit(frame(spark, list(enumerate(vectors))))
    _, _, cov, _ = brute(vectors)
    assert np.array_equal(model.covariance, np.array([[float(c) for c in r] for r in cov]))


def test_large_entries_do_not_wrap(spark):
    vectors = [[1e15, 1.0], [-1e15, 2.0], [3e14, -4.0], [5.0, 1e14]]
    _, _, cov, deviations = brute(vectors)
    got = fit(frame(spark, list(enumerate(vectors))))
    assert np.array_equal(got.covariance, np.array([[float(c) for c in r] for r in cov]))
    rows = {r["vec_id"]: r for r in whiten(frame(spark, list(enumerate(vectors)))).where("component = 1").collect()}
    for k, d in enumerate(deviations):
        assert rows[k]["deviation"] == (d if d < 2**63 else None)
        assert rows[k]["deviation_exact"] == (d if d < 10**38 else None)


def test_dropped_and_repeated_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, 1.0]), (4, [0.0, 5.0])]
    bad = [(5, None), (6, [None, 1.0]), (7, [nan, 1.0]), (8, [inf, 1.0]), (9, []), (10, [1.0]), (11, [1.0, 2.0, 3.0])]
    rows = whiten(frame(spark, good + bad)).collect()
    assert sorted((r["vec_id"] is None, r["vec_id"], r["component"]) for r in rows if r["vec_id"]) == [
        (False, 1, 1), (False, 1, 1), (False, 1, 2), (False, 1, 2), (False, 4, 1), (False, 4, 2),
    ]
    assert sum(r["vec_id"] is None for r in rows) == 2 and {r["n"] for r in rows} == {4}


def test_length_ties_take_the_longer(spark):
    rows = [(1, [1.0]), (2, [2.0]), (3, [1.0, 5.0]), (4, [2.0, 3.0])]
    assert {r["vec_id"] for r in whiten(frame(spark, rows)).collect()} == {3, 4}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [3.0, 3.0]), (2, [3.0, 3.0])]])
def test_nothing_to_whiten(spark, rows):
    out = whiten(frame(spark, rows))
    assert out.count() == 0 and out.columns == [c.split()[0] for c in whitening.OUT.split(", ")]


def test_no_variance_in_one_dimension(spark):
    rows = whiten(frame(spark, [(1, [1.0, 7.0]), (2, [2.0, 7.0]), (3, [4.0, 7.0])])).collect()
    assert {r["component"] for r in rows} == {1} and all(abs(r["explained"] - 1) < 1e-12 for r in rows)


def test_query_on_the_table(spark):
    n = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").where("embedding IS NOT NULL").count()
    rows = op11_whitening(spark, "/root/testdata/sf0.001")
    assert rows.count() == n * 32
    assert rows.selectExpr("max(identity_error) e", "max(component) c").first()["c"] == 32
    assert rows.selectExpr("max(identity_error) e").first()["e"] < 1e-4
