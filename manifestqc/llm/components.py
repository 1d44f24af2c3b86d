"""Connected components of a link table, without collecting it.

Every vertex takes the smallest label among itself and its neighbours, then the
label of its label, until nothing changes.  Each round is cut by a reliable
checkpoint, so that the link side of the join (where one vertex may hold most
rows) and the label side are both plain exchanges, which adaptive execution can
split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from manifestqc.llm.common import checkpoint


def connected(links: DataFrame, max_rounds: int = 200) -> DataFrame:
    """(id, component): the smallest id reachable, for every id in ``links`` (a, b).  Raises if it does not settle."""
    links = links.where("a <> b")
    links = checkpoint(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = checkpoint(links.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("label")))
    for _ in range(max_rounds):
        near = (links.join(labels.withColumnRenamed("id", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
                .select(F.col("a").alias("id"), "near"))
        lower = checkpoint(labels.join(near, "id").select("id", "label", F.least("label", "near").alias("lower")))
        if lower.where("lower < label").isEmpty():
            return labels.select("id", F.col("label").alias("component"))
        jump = lower.select(F.col("id").alias("lower"), F.col("lower").alias("lowest"))
        labels = checkpoint(lower.join(jump, "lower").select("id", F.col("lowest").alias("label")))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
