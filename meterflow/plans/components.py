"""Connected components of an undirected edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.plans.stage import release, staged

MAX_ROUNDS = 60


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """One row (id, component) per node of an edge; component is the smallest node id reached.

    Every round lowers each label to the smallest label among its neighbours and then follows
    label -> label once (pointer jumping), so the rounds needed grow with the logarithm of the
    longest chain. Each round is written out, which cuts the lineage. Self loops and repeated
    edges are allowed; edges with a null end are ignored; no edges give no rows. A graph whose
    labels still change after `max_rounds` raises.
    """
    e = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a is not null and b is not null")
    both = staged(e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = staged(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("component")), "labels")
    for _ in range(max_rounds):
        near = (
            both.join(labels.select(F.col("id").alias("b"), "component"), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("component").alias("near"))
        )
        now = labels.select("id", "component")
        lowered = now.join(near, "id", "left").select("id", F.col("component").alias("was"), F.least("component", F.coalesce("near", "component")).alias("low"))
        jump = now.select(F.col("id").alias("low"), F.col("component").alias("up"))
        step = staged(
            lowered.join(jump, "low", "left").select("id", F.least("low", F.coalesce("up", "low")).alias("component"), "was"), "labels"
        )
        release(labels)
        if step.where("component <> was").isEmpty():
            release(both)
            return step.select("id", "component")
        labels = step
    raise RuntimeError(f"components still change after {max_rounds} rounds")
