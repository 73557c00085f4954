"""Random keys of every alphabet are found at about the rate that README states; names and paths are not."""

import random
import string

import pytest

from tierwise.llm import secret_scan

LOWER, UPPER, DIGITS = string.ascii_lowercase, string.ascii_uppercase, string.digits
LEAST = {
    ("base62", LOWER + UPPER + DIGITS, 20): 0.95,
    ("lower", LOWER + DIGITS, 20): 0.95,
    ("lower", LOWER + DIGITS, 32): 0.98,
    ("upper", UPPER + DIGITS, 20): 0.95,
    ("base32", UPPER + "234567", 20): 0.93,
    ("letters", LOWER + UPPER, 20): 0.8,
    ("letters", LOWER + UPPER, 32): 0.95,
}
NAMES = [
    "getElementsByClassName", "SizeOfTheInnerListBox", "averylongwordwithoutadigit", "A_LONG_CONSTANT_WITHOUT_DIGIT",
    "path/to/some/module/file", "2024-01-01T00:00:00Z", "123e4567-e89b-12d3-a456-426614174000",
    "Donaudampfschifffahrtsgesellschaft", "x" * 5000, "aB" * 5000,
]


@pytest.fixture(scope="module")
def counts(spark):
    rng = random.Random(17)
    rows = [(f"{name}{n}", "".join(rng.choice(a) for _ in range(n))) for name, a, n in LEAST for _ in range(200)]
    docs = spark.createDataFrame([(i, f"a {t} z") for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    found = {r["doc_id"] for r in secret_scan.scan(docs.repartition(8)).collect() if r["base"] or r["extra"]}
    out = {}
    for i, (name, _) in enumerate(rows):
        out.setdefault(name, []).append(i in found)
    return out


def test_random_keys_of_every_class_are_found(counts):
    for (name, _, n), least in LEAST.items():
        assert sum(counts[f"{name}{n}"]) >= least * 200, (name, n)


def test_names_and_paths_are_not(spark):
    docs = spark.createDataFrame(list(enumerate(NAMES)), "doc_id long, text string")
    assert {r["doc_id"] for r in secret_scan.scan(docs).collect() if r["extra"]} == set()
