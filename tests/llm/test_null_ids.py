"""Rows without an id pass through every operator; a null source, language or label does no harm."""

import pytest
from pyspark.sql import functions as F

from tierwise.llm import (
    host_rules, jaccard_join, lang_id, license_scan, lm_score, mixing, packing, quality_crf, secret_scan, simhash,
)

TEXTS = ["the same few words in a row here", "the same few words in a row here", None, "other words\nthat stand in two lines", "x"]
IDS = [None, 3, None, 0, 50]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None, None, None) for i, t in zip(IDS, TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(2)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(3, 1, 0), (0, 0, None), (None, 1, 1)], "doc_id long, quality int, toxic int")


def ids(df):
    return sorted((r["doc_id"] for r in df.collect()), key=lambda i: (i is not None, i or 0))


def test_every_row_comes_back(docs, labels):
    want = [None, None, 0, 3, 50]
    crf = quality_crf.train(docs, labels, F.lit(True))
    domains = mixing.train(docs, labels, mixing.domain_of_label())
    nothing = lang_id.train(docs, F.lit(True))
    assert ids(host_rules.host_rules(docs)) == want
    assert ids(secret_scan.scan(docs)) == want and ids(secret_scan.redact(docs)) == want
    assert ids(license_scan.scan(docs)) == want
    assert ids(quality_crf.score(docs, crf)) == want
    assert ids(mixing.mix(docs, domains, mixing.SHARES)[0]) == want
    assert ids(lang_id.predict(docs, nothing)) == want
    assert ids(lm_score.score(docs)) == want
    groups = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in jaccard_join.groups_of(docs).collect()}
    assert groups == {(None, 4): 3, (3, 4): 3, (None, 0): None, (0, 3): 0, (50, 1): 50}
    assert ids(jaccard_join.keep_first_of_groups(docs)) == [None, 0, 3, 50]  # the row without id and words is no copy
    assert sum(r["length"] for r in packing.pack(docs, packing.tokenizer_file()).collect() if r["doc_id"] is None) > 2


def test_neighbours_of_documents_without_id(docs):
    rows = sorted(simhash.with_next(docs).collect(), key=lambda r: (r["pos"], r["th"]))
    assert [r["doc_id"] for r in rows] == [None, None, 0, 3, 50]
    for a, b in zip(rows, rows[1:] + rows[:1]):
        assert (a["next_pos"], a["next_th"], a["next_t"]) == (b["pos"], b["th"], b["t"])
