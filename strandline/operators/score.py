"""Scores: weighted dosage sums for many samples and many scores in one plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Shares of an allele in fixed point, so sums are exact whatever their order.
UNIT = 1_000_000


def effect_dosage(dosage: Column | str = "dosage") -> Column:
    """Copies of the effect allele."""
    d = F.col(dosage) if isinstance(dosage, str) else dosage
    return F.when(F.col("effect_is_alt"), d).otherwise(2 - d)


def typed(dosage: Column, kind: Column | str = "effect_type") -> Column:
    """Dominant counts one copy at most, recessive those beyond the first."""
    k = F.col(kind) if isinstance(kind, str) else kind
    return F.when(k == "dominant", F.least(dosage, F.lit(1))).when(k == "recessive", F.greatest(dosage - 1, F.lit(0))).otherwise(dosage)


def sums(rows: DataFrame, genotypes: DataFrame, by_type: bool = False) -> DataFrame:
    """By sample and accession: the sum of dosage times weight, the number of alleles, and their ratio. rows: accession, vid, w, effect_is_alt (and effect_type)."""
    own = genotypes.where("dosage is not null").join(rows, "vid")
    d = effect_dosage()
    d = typed(d) if by_type else d
    out = own.groupBy("iid", "accession").agg(F.sum(d.cast("bigint") * F.col("w")).alias("score_sum"), (2 * F.count(F.lit(1))).alias("denom"))
    return out.withColumn("score_avg", F.round(F.col("score_sum") / F.col("denom"), 6))


def imputed_sums(rows: DataFrame, genotypes: DataFrame, frequencies: DataFrame) -> DataFrame:
    """Like sums, with missing genotypes (a record without dosage) at the panel's mean; absent records take no part. score_sum is in 1 / UNIT of a weight. frequencies: vid, alt_freq."""
    mean = F.round(2 * F.col("alt_freq") * UNIT).cast("bigint")
    own = genotypes.join(rows, "vid").join(frequencies.select("vid", mean.alias("mean")), "vid", "left")
    alt = F.coalesce(F.col("dosage").cast("bigint") * UNIT, "mean")
    d = F.when(F.col("effect_is_alt"), alt).otherwise(2 * UNIT - alt)
    return own.groupBy("iid", "accession").agg(F.sum(d * F.col("w")).alias("score_sum"), (2 * F.count(F.lit(1))).alias("denom"), F.count_if(F.col("dosage").isNull()).alias("n_imputed"))


def merged(splits: DataFrame) -> DataFrame:
    """Sums over the splits of a score; splits: iid, accession, split, score_sum, denom."""
    out = splits.groupBy("iid", "accession").agg(F.sum("score_sum").alias("score_sum"), F.sum("denom").alias("denom"), F.count(F.lit(1)).alias("n_splits"))
    return out.withColumn("score_avg", F.round(F.col("score_sum") / F.col("denom"), 6))


def coverage(rows: DataFrame, genotypes: DataFrame) -> DataFrame:
    """By sample and accession: rows matched in the sample (0 where none is), the accession's rows, and their ratio. rows: accession, vid (null where unmatched). The result has a row for each sample and score, so the scores, one small row each, are sent to all samples."""
    totals = rows.groupBy("accession").agg(F.count(F.lit(1)).alias("n_rows"))
    got = genotypes.where("dosage is not null").join(rows.where("vid is not null"), "vid").groupBy("iid", "accession").agg(F.count(F.lit(1)).alias("n_matched"))
    every = genotypes.select("iid").distinct().join(F.broadcast(totals))
    return every.join(got, ["iid", "accession"], "left").na.fill(0, ["n_matched"]).select("iid", "accession", "n_matched", "n_rows", F.round(F.col("n_matched") / F.col("n_rows"), 6).alias("match_rate"))


def coverage_or_denominator(scores: DataFrame, covered: DataFrame, sizes: DataFrame) -> DataFrame:
    """Adds n_matched and match_rate to scores (sample, pgs_id, denom): those of a match summary (covered: pgs_id, matched, total, and sample if it is of several) where it has the score, else half of the denominator over the score's own number of variants (sizes: pgs_id, n_variants). Adds n_variants too: the score's own number, else the summary's."""
    out = scores.join(covered, ["sample", "pgs_id"] if "sample" in covered.columns else "pgs_id", "left").join(sizes.select("pgs_id", F.col("n_variants").alias("size")), "pgs_id", "left")
    known = F.col("total").isNotNull()
    n = F.when(known, F.col("matched")).otherwise(F.floor(F.col("denom") / 2))
    rate = F.when(known, F.when(F.col("total") > 0, F.col("matched") / F.col("total"))).otherwise(F.when(F.col("size") > 0, F.floor(F.col("denom") / 2) / F.col("size")))
    return out.withColumns({"n_matched": n.cast("bigint"), "match_rate": rate, "n_variants": F.coalesce("size", "total")}).drop("matched", "total", "size")


def passing(covered: DataFrame, least_overlap: float) -> DataFrame:
    """Whether the share of rows without a match is small enough."""
    return covered.withColumn("score_pass", 1 - F.col("match_rate") <= F.lit(1 - least_overlap))
