"""Connected components of a table of links, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.store import forget, written


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """links: a, b (bigint). Gives id, label for each id in links: the smallest id that it is connected with. Each round is written to the shared folder, and at least halves the way of a label to its root."""
    both = written(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "edges")
    labels = written(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("id"), F.least("a", "b").alias("label")), "labels")
    last = labels
    for _ in range(most_rounds):
        near = both.join(labels.select(F.col("id").alias("b"), "label"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near"))
        least = labels.join(near, "id").select("id", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        up = least.select(F.col("id").alias("label"), F.col("label").alias("up"))
        jumped = least.join(up, "label", "left").select("id", "old", F.least("label", F.coalesce("up", "label")).alias("label"))
        after = written(jumped, "labels")
        changed = after.where("label <> old").limit(1).count()
        forget(last)
        labels, last = after.select("id", "label"), after
        if not changed:
            forget(both)
            return labels
    raise RuntimeError("components did not settle")
