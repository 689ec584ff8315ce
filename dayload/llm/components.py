"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved

#: Rounds after which an edge table that still changes is an error (a round shrinks every component's diameter).
ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """(v, component) for every vertex of ``edges`` (a long, b long); the component is its smallest vertex.

    Both stars are a minimum for each vertex (summed up before the shuffle) and
    a join with that minimum, so a hub costs no task more than its edges, which
    Spark splits.  Every round is written to the shared scratch folder.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now, before = saved(now, "edges"), None
    for _ in range(ROUNDS):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small_least.select("u", F.col("m").alias("v")))
        now = saved(small.where("u <> v").distinct(), "edges")
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == before:
            stars = now.select(F.col("u").alias("v"), F.col("v").alias("component"))
            return stars.union(stars.select("component", "component").distinct())
        before = state
    raise RuntimeError("components did not settle")
