"""Exact dedup: group by a 128-bit content hash, compare bytes inside a group, keep the smallest id.

Texts are equal when they are identical after each run of ASCII white space becomes one space; a null text counts as
empty. The hash leads the grouping key and the normalised text follows it, so rows meet by their hash and the
aggregate's key comparison holds the bytes of equal hashes against each other: a collision gives two groups. The
aggregate combines on the map side, so a group of copies of any size reaches the shuffle as one row a task. Only
(id, hashes) rows are joined back, in a join that adaptive execution may split.

Defined results: a null id sorts after every other id, and stays only where all of its group are null. Rows that
repeat both id and text are the same document: each has the same keep_id and counts in group_size, and
``drop_copies`` leaves one of them. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.text import fresh, one_spaced


def text_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each distinct text: h (128 bits), sha (hex of 256 bits), keep_id, group_size."""
    return (
        docs.select(F.col(id_col).alias("id"), one_spaced(text_col).alias("t"))
        .select("id", F.unhex(F.md5("t")).alias("h"), "t")
        .groupBy("h", "t")
        .agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("h", F.sha2("t", 256).alias("sha"), "keep_id", "group_size")
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: id, keep_id, group_size, kept, text_sha256 (see the module)."""
    rows = docs.select(F.col(id_col).alias("id"), one_spaced(text_col).alias("t")).select("id", F.unhex(F.md5("t")).alias("h"), F.sha2("t", 256).alias("sha"))
    return rows.join(text_groups(docs, id_col, text_col), ["h", "sha"]).select(
        F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256")
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without copies: of equal texts the row with the smallest id, once, with all its columns."""
    h, sha, n = fresh(docs, "h", "sha", "n")
    t = one_spaced(text_col)
    stay = text_groups(docs, id_col, text_col).select(F.col("h").alias(h), F.col("sha").alias(sha), F.col("keep_id").alias(n))
    keyed = docs.withColumns({h: F.unhex(F.md5(t)), sha: F.sha2(t, 256)})
    same = (keyed[h] == stay[h]) & (keyed[sha] == stay[sha]) & keyed[id_col].eqNullSafe(stay[n])
    once = Window.partitionBy(h, sha, id_col).orderBy(F.lit(1))
    return keyed.join(stay, same, "left_semi").withColumn(n, F.row_number().over(once)).where(F.col(n) == 1).select(*docs.columns)
