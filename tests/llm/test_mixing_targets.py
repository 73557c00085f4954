"""The rows that mixing keeps hold the tokens that the targets ask for."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierwise.llm import mixing

SF = "/root/testdata/sf0.01"


def test_copies_are_the_rate_on_average():
    draws = np.random.default_rng(2).integers(-(2**63), 2**63 - 1, 20000)
    for rate in (0.0, 0.1, 0.25, 0.5, 1.0, 1.2, 2.0):
        copies = mixing.copies_of(np.full(len(draws), rate), draws)
        assert set(copies) <= {int(rate), int(rate) + (rate % 1 > 0)}
        assert copies.mean() == pytest.approx(rate, abs=0.015)


def test_kept_tokens_meet_the_targets_of_every_domain(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = mixing.train(table, labels, mixing.domain_of_label())
    docs = table.crossJoin(spark.range(8).withColumnRenamed("id", "n"))  # more draws
    docs = docs.withColumn("doc_id", F.col("doc_id") * 8 + F.col("n")).drop("n").cache()
    out, report = mixing.mix(docs, model, mixing.SHARES)
    rows = out.collect()
    rate = np.array([r["rate"] for r in rows])
    mass = np.array([[r["tokens"] * x for x in r["p"]] for r in rows])
    left = rate % 1
    scatter = np.sqrt((left * (1 - left)) @ mass**2)
    kept = mixing.natural_tokens(mixing.posteriors(mixing.apply_rates(docs, model, mixing.SHARES), model), model)
    for name, tokens, sd in zip(model.names, kept, scatter):
        target = report[name]["target"]
        print(name, round(target), round(tokens), round(sd))
        assert abs(tokens - target) <= 4 * sd and sd < 0.2 * target
