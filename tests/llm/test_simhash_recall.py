"""What the three bits of op2_simhash's near search find, by similarity (README, known limits)."""

import random

from pyspark.sql import functions as F

from tierwise.llm import simhash


def test_three_bits_find_almost_identical_texts_only(spark):
    rng, rows = random.Random(3), []
    word = lambda: f"q{rng.getrandbits(40)}"
    for likeness in (0.8, 0.98):
        for i in range(100):
            words = [word() for _ in range(404)]
            changed = round(400 * (1 - likeness) / (1 + likeness))
            other = words[:-changed] + [word() for _ in range(changed)]
            rows += [(likeness, i, 0, " ".join(words)), (likeness, i, 1, " ".join(other))]
    texts = spark.createDataFrame(rows, "likeness double, i int, side int, text string").repartition(8)
    prints = simhash.fingerprints(texts, ["likeness", "i", "side"])
    a, b = (prints.where(F.col("side") == k).select("likeness", "i", F.col("fp").alias(f"fp{k}")) for k in (0, 1))
    near = (simhash.hamming(F.col("fp0"), F.col("fp1")) <= 3).cast("int")
    found = {r["likeness"]: r["near"] for r in a.join(b, ["likeness", "i"]).groupBy("likeness").agg(F.avg(near).alias("near")).collect()}
    assert found[0.8] <= 0.05 and 0.55 <= found[0.98] <= 0.85
    assert "almost identical texts only" in simhash.__doc__
