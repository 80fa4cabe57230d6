"""Digests of tables that do not depend on the order of rows, and what they prove."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WIDE = "decimal(38,0)"


def row_digest(*columns: str | Column) -> Column:
    """128 bits of a row as text; nulls, and values that only join to the same text, are told apart."""
    parts = [F.coalesce(F.concat(F.length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in (F.col(x) if isinstance(x, str) else x for x in columns)]
    return F.md5(F.concat(*parts))


def _half(digest: Column, k: int) -> Column:
    return F.conv(F.substring(digest, 1 + 16 * k, 16), 16, 10).cast(_WIDE)


def multiset_digest(table: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """By group (or over all without keys) the number of rows and an order-free digest: the sums of both halves of the rows' digests. One aggregate, combined before its shuffle, however many rows a group has. Equal multisets have equal digests; a lost, changed or doubled row changes them."""
    d = table.withColumn("the digest", row_digest(*columns))
    sums = [F.coalesce(F.sum(_half(F.col("the digest"), k)), F.lit(0).cast(_WIDE)) for k in (0, 1)]
    return d.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.concat_ws("-", *(s.cast("string") for s in sums)).alias("digest"))


def unlike(one: DataFrame, other: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Groups whose rows are not the same multiset on both sides, with both numbers of rows (0 where a side has none): keys, n_one, n_other."""
    a, b = (multiset_digest(t, keys, columns).withColumnsRenamed({"n": f"n_{s}", "digest": f"digest_{s}"}) for t, s in ((one, "one"), (other, "other")))
    out = a.join(b, keys, "full").where(~F.col("digest_one").eqNullSafe(F.col("digest_other")))
    return out.na.fill(0, ["n_one", "n_other"]).select(*keys, "n_one", "n_other")


def verified(parts: DataFrame, merged: DataFrame, used: DataFrame) -> DataFrame:
    """Faults of a merge of scores over splits: fault, accession, n. parts: split, accession, vid of all variants that each split used; merged: accession, n_variants (what the merge counted); used: accession, vid (what should have been used). A variant that several splits used, one that none did, one that was none of the score's, and a count that is not the splits' sum."""
    each = parts.groupBy("accession", "vid").agg(F.count(F.lit(1)).alias("times"))
    want = used.select("accession", "vid").distinct().withColumn("wanted", F.lit(True))
    met = each.join(want, ["accession", "vid"], "full")
    fault = F.when(F.col("times").isNull(), "lost").when(F.col("wanted").isNull(), "foreign").when(F.col("times") > 1, "doubled")
    counted = parts.groupBy("accession").agg(F.count(F.lit(1)).alias("n_parts")).join(merged.select("accession", "n_variants"), "accession", "full").na.fill(0, ["n_parts", "n_variants"])
    return met.withColumn("fault", fault).where("fault is not null").groupBy("fault", "accession").agg(F.count(F.lit(1)).alias("n")).unionByName(
        counted.where("n_parts <> n_variants").select(F.lit("counted otherwise").alias("fault"), "accession", (F.col("n_variants") - F.col("n_parts")).alias("n"))
    )
