"""The pipeline's stages on their own inputs, and the whole run on sf0.001."""

from collections import defaultdict

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from test_jaccard import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], SF).write.parquet(f"{folder}/{i}")
        out.append(spark.read.parquet(f"{folder}/{i}"))
    return out


def test_all_but_the_last_return_documents(stages):
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID", "n-gram Jaccard join", "secret scans", "mixing sources to target weights", "packing"
    ]


def test_language_stage_keeps_documents_with_words(stages):
    before = {r["doc_id"]: r["text"] for r in stages[0].collect()}
    kept = {r["doc_id"] for r in stages[1].collect()}
    assert all(i in kept for i, t in before.items() if sum(c.isalpha() for c in t) > 100)


def test_one_document_of_each_group_stays(stages):
    rows = stages[1].orderBy("doc_id").collect()
    want = {c for _, _, c in brute([r["doc_id"] for r in rows], [r["text"] for r in rows])}
    assert {r["doc_id"] for r in stages[2].collect()} == want


def test_secrets_are_gone_and_no_document(stages):
    from tierwise.llm import secret_scan

    assert stages[3].count() == stages[2].count()
    spans = secret_scan.scan(stages[3]).collect()
    assert all(not r["extra"] and not [s for s in r["base"] if s["kind"]] for r in spans)
    before, after = ({r["doc_id"]: r["text"] for r in s.collect()} for s in (stages[2], stages[3]))
    had = {r["doc_id"] for r in secret_scan.scan(stages[2]).collect() if r["base"] or r["extra"]}
    assert {i for i, t in after.items() if "<SECRET>" in t} == had
    assert all(after[i] == t for i, t in before.items() if "<SECRET>" not in after[i])


def test_packing_covers_what_mixing_kept(stages):
    tokens = defaultdict(int)
    for r in stages[5].collect():
        tokens[r["doc_id"]] += r["length"]
    assert set(tokens) == {r["doc_id"] for r in stages[4].collect()}


def test_run_is_registered_and_repeats(spark, stages):
    key = lambda rows: sorted((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    assert key(entry.queries()["pipeline"](spark, SF).collect()) == key(stages[5].collect())
    assert corpus_pipeline.ORACLE_SQL is None
