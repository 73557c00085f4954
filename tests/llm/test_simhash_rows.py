"""op2_simhash end to end: equal rows and rows without an id all come back and are all counted."""

from collections import Counter

import pytest

from tierwise.llm import simhash

SAME = " ".join(f"w{i}" for i in range(30))
ROWS = [(50, SAME)] * 3 + [(None, SAME)] * 3 + [(None, None)] * 4 + [(7, "some other words"), (100, "the last one of all")]


@pytest.fixture(scope="module")
def out(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("equal-rows")
    spark.createDataFrame(ROWS, "doc_id long, text string").repartition(4).write.parquet(f"{folder}/documents.parquet")
    return simhash.op2_simhash(spark, str(folder)).collect()


def test_every_equal_row_comes_back(out):
    got = Counter((r["doc_id"], r["n_chars"]) for r in out)
    assert got == Counter((i, len(t or "")) for i, t in ROWS)
    assert all(r["near_next"] is not None for r in out)


def test_near_documents_count_every_equal_row(out):
    near = {(r["doc_id"], r["near_docs"]) for r in out if r["doc_id"] in (50, 100)}
    assert near == {(50, 5), (100, 0)}
    assert all(r["near_docs"] is None for r in out if r["doc_id"] not in (50, 100))
