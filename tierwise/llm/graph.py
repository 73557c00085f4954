"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwise.llm.common import stage


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long); root is the component's smallest node.

    Each round rewrites the edges to point to smaller nodes, staged in the shared folder; it ends when
    a round changes nothing. Self-loops and repeated edges do no harm; no edges give no rows."""
    canonical = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    now = stage(canonical, "components")
    for _ in range(max_rounds):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        after = stage(small.union(down.select("u", F.col("m").alias("v"))).distinct(), "components")
        mark = [F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long"))]
        changed = after.agg(*mark).first() != now.agg(*mark).first()
        now = after
        if not changed:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
