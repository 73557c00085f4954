"""Training-corpus pipeline: five stages over ``documents``, each written as Parquet and read by the next.

1. language ID (operator 6): documents whose language it cannot tell, or whose posterior is below 0.5, go.
2. n-gram Jaccard join (operator 5): of each group of copies and near copies one document stays.
3. secret scans (operator 7): found spans are replaced by ``<SECRET>``; no document goes.
4. mixing (operator 4): each document stays as many times as its fitted rate, rounded up or down by a fixed
   hash of the row, so the tokens of each domain meet their targets: about a quarter of the low-quality and a
   tenth of the toxic documents stay; with the targets here clean documents have rates near one.
5. packing (operator 9): token sequences, one row per piece.

All stages but the last return the columns of ``documents``. Nulls: a null text is empty (stage 1 removes
it, as it has no letter); rows with a null doc_id are rows like others (stage 2 keeps one of a group only if no row
of the group has an id); repeated rows count as copies.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.llm import jaccard_join, lang_id, mixing, packing, secret_scan
from tierwise.llm.common import crc_mod, read_table
from tierwise.session import checkpoint_dir

#: Least posterior of the predicted language.
LEAST_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; the model learns from the table's labelled rows of four folds in five."""
    table = read_table(spark, sf_dir, "documents")
    model = lang_id.train(table, crc_mod(F.col("doc_id"), 5) != 0)
    return lang_id.keep_identified(docs, model, LEAST_SCORE)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of the Jaccard join at 0.8: the one with the smallest id."""
    return jaccard_join.keep_first_of_groups(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as its rate, rounded up or down by its hash."""
    model = mixing.train(docs, read_table(spark, sf_dir, "labels"), mixing.domain_of_label())
    return mixing.apply_rates(docs, model, mixing.SHARES)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, packing.tokenizer_file())


STAGES = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", drop_near_copies),
    ("secret scans", redact_secrets),
    ("mixing sources to target weights", mix_to_targets),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, from ``documents``; each result is written below the shared checkpoint folder
    and read again, so a lost executor costs no finished stage."""
    docs = read_table(spark, sf_dir, "documents")
    folder = f"{checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{i}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


#: Stages 1, 4 and 5 (trained models, a tokenizer) have no SQL; tests compare each stage with brute force.
ORACLE_SQL = None
