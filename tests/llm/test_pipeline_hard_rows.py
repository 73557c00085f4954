"""The pipeline on rows that are hard: null ids and texts, repeated rows, clashing column names, empty tables."""

import pytest

import corpus_pipeline

PROSE = "the quick brown fox jumps over the lazy dog while many people watch from the old stone bridge near the river"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, draw long, digest string, kept_id long, name string, body string"


def table(spark, folder, rows):
    extra = (7, "x", 1, "y", "z")
    docs = spark.createDataFrame([(i, t, lang, "s", 1, *extra) for i, t, lang in rows], COLUMNS)
    docs.repartition(2).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, (i or 0) % 2, 0) for i, _, _ in rows if i is not None][:20]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return docs


def test_hard_rows(spark, scratch):
    rows = [(k, f"{PROSE} number {k} and then some more words about {k * 7} other things", "en") for k in range(30)]
    rows += [(None, f"{PROSE} that has no number of its own at all", "en"), (None, f"{PROSE} that has no number of its own at all", "en")]
    rows += [(100, None, "en"), (None, None, None), (101, "", "de"), (102, " \n ", None), (103, "12 34", "en")]
    rows += [(5, rows[5][1], "en"), (104, "password = abcdef123456 " + PROSE, "en"), (105, PROSE.upper() * 300, "en")]
    docs = table(spark, scratch, rows)
    at, now = [docs.columns], docs
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, scratch).write.parquet(f"{scratch}/out/{i}")
        now = spark.read.parquet(f"{scratch}/out/{i}")
        at.append(now.columns)
        if i == 1:
            kept = [r["text"] for r in now.collect()]
    assert all(c == docs.columns for c in at[:-1])
    assert sum("no number of its own" in t for t in kept) == 1  # one row of the group without ids
    assert sum(t == rows[5][1] for t in kept) == 1
    assert now.count() > 0 and corpus_pipeline.run(spark, scratch).columns == now.columns


@pytest.mark.parametrize("rows", [[], [(None, None, None)]])
def test_nothing_to_keep(spark, scratch, rows):
    table(spark, scratch, rows)
    assert corpus_pipeline.run(spark, scratch).count() == 0
