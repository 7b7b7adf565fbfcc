"""Connected components of an edge table, by labels that only get smaller."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lockgate.llm.common import Work


def components(edges: DataFrame, work: Work, name: str) -> DataFrame:
    """(id, comp) for every end of ``edges`` (a, b): the smallest id that is reachable.

    Each round takes the smallest label among neighbours and then the label of the label,
    so the rounds grow with the logarithm of the longest path.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = work.write(both.distinct(), f"{name}-edges")
    labels = work.write(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("comp")), f"{name}-0")
    turn = 0
    while True:
        near = (
            both.join(labels.select(F.col("a").alias("b"), "comp"), "b")
            .groupBy("a")
            .agg(F.min("comp").alias("near"))
        )
        hooked = labels.join(near, "a").select("a", "comp", F.least("comp", "near").alias("to"))
        jump = labels.select(F.col("a").alias("to"), F.col("comp").alias("beyond"))
        after = hooked.join(jump, "to", "left").select(
            "a", F.least("to", F.coalesce("beyond", "to")).alias("comp"), F.col("comp").alias("was")
        )
        turn += 1
        after = work.write(after, f"{name}-{turn}")
        work.drop(f"{name}-{turn - 1}")
        labels = after.select("a", "comp")
        if after.filter("comp <> was").isEmpty():
            return labels.withColumnRenamed("a", "id")
