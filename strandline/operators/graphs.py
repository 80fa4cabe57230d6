"""Independent sets over tables of conflicts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.sources import shared


def independent(nodes: DataFrame, conflicts: DataFrame, key: str, rank: str) -> DataFrame:
    """Ids that stay when nodes (key, rank) are taken in the order of rank, then id, and each goes that is in conflict with one taken before: key. conflicts: a, b, in either order; those of unknown ids do not count.

    Rounds of local firsts: a node that no undecided node precedes stays, and what it is in conflict with goes. That is what the ordered pass gives, in as many rounds as the longest chain of conflicts in falling order is long. Each round's remaining conflicts are written to the shared folder."""
    spark = nodes.sparkSession
    place = nodes.select(F.col(key).alias("id"), F.struct(F.col(rank), F.col(key)).alias("at"))
    first, second = (place.select(F.col("id").alias(c), F.col("at").alias(f"at_{c}")) for c in "ab")
    known = conflicts.select("a", "b").where("a <> b").join(first, "a").join(second, "b")
    ahead = F.col("at_a") < F.col("at_b")
    edges = shared.kept(known.select(F.when(ahead, F.col("a")).otherwise(F.col("b")).alias("before"), F.when(ahead, F.col("b")).otherwise(F.col("a")).alias("after")).distinct(), "conflicts")
    gone = []
    while edges.limit(1).count():
        heads = edges.select("before").distinct().join(edges.select(F.col("after").alias("before")).distinct(), "before", "left_anti")
        out = shared.kept(edges.join(heads, "before", "left_semi").select(F.col("after").alias("id")).distinct(), "decided")
        rest = edges.join(out.select(F.col("id").alias("before")), "before", "left_anti").join(out.select(F.col("id").alias("after")), "after", "left_anti")
        now = shared.kept(rest, "conflicts")  # heads have no conflicts left: all of theirs are out
        shared.forget(edges)
        edges = now
        gone.append(out)
    shared.forget(edges)
    removed = gone[0] if gone else spark.createDataFrame([], place.select("id").schema)
    for more in gone[1:]:
        removed = removed.union(more)
    return nodes.select(key).join(removed.select(F.col("id").alias(key)), key, "left_anti")
