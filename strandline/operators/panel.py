"""Target variants against a reference panel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions import alleles as A


def allele_key(chrom: str = "chrom", pos: str = "pos", a: str = "a1", b: str = "a2") -> Column:
    """CHR:POS:A0:A1 with alleles in order, the same on both sides whichever is the reference."""
    return F.concat_ws(":", F.col(chrom), F.col(pos).cast("string"), F.least(a, b), F.greatest(a, b))


def intersect(panel: DataFrame, target: DataFrame, least_maf: float = 0.01, most_missing: float = 0.1) -> DataFrame:
    """Variant pairs with the same allele key. panel: vid, chrom, pos, a1, a2; target: also alt_freq, f_miss. Says whether the reference alleles agree, and whether the pair may enter a PCA: not multi-allelic in the panel, not an indel, not strand-ambiguous, frequent and called."""
    many = panel.groupBy("chrom", "pos").agg((F.count(F.lit(1)) > 1).alias("is_ma_ref"))
    ref = panel.join(many, ["chrom", "pos"]).select(allele_key().alias("key"), F.col("vid").alias("id_ref"), F.col("a1").alias("ref_ref"), "is_ma_ref", (F.greatest(F.length("a1"), F.length("a2")) > 1).alias("is_indel"), A.ambiguous("a1", "a2").alias("strandamb"))
    own = target.select(allele_key().alias("key"), F.col("vid").alias("id_target"), F.col("a1").alias("ref_target"), "alt_freq", "f_miss")
    out = ref.join(own, "key").withColumn("same_ref", F.col("ref_ref") == F.col("ref_target"))
    maf = F.least(F.col("alt_freq"), 1 - F.col("alt_freq"))
    return out.withColumn("pca_eligible", ~F.col("is_ma_ref") & ~F.col("is_indel") & ~F.col("strandamb") & F.coalesce((maf >= least_maf) & (F.col("f_miss") <= most_missing), F.lit(False)))


def derived(canonical: DataFrame, own: DataFrame, extra: DataFrame) -> DataFrame:
    """A sample's intersect from the canonical one: its rows for variants that the sample has, with the sample's own frequency and missingness, and the pairs found for variants that only the sample has. canonical: intersect's columns; own: vid, alt_freq, f_miss; extra: intersect's columns."""
    mine = canonical.drop("alt_freq", "f_miss").join(own.select(F.col("vid").alias("id_target"), "alt_freq", "f_miss"), "id_target")
    return mine.select(*canonical.columns).unionByName(extra.select(*canonical.columns))


def relabelled(rows: DataFrame, names: DataFrame, key: str = "vid") -> DataFrame:
    """rows with their id replaced by names' (old, new); an id without a new one stops the job."""
    out = rows.join(names, rows[key] == names["old"], "left")
    checked = F.when(F.col("new").isNull(), F.raise_error(F.concat(F.lit("no new id for "), F.col(key).cast("string")))).otherwise(F.col("new"))
    return out.withColumn(key, checked).drop("old", "new")


def unmapped(rows: DataFrame, names: DataFrame, key: str = "vid") -> DataFrame:
    """Ids that relabelled() would stop at."""
    return rows.select(key).distinct().join(names, rows[key] == names["old"], "left_anti")


def thinned(pairs: DataFrame, kept: DataFrame) -> DataFrame:
    """Pairs that may enter a PCA and whose panel variant pruning left (kept: vid)."""
    return pairs.where("pca_eligible").join(kept.select(F.col("vid").alias("id_ref")), "id_ref", "left_semi")


def clashing(samples: DataFrame, panel: DataFrame, key: str = "iid") -> DataFrame:
    """Samples whose id a panel individual has; scoring asks for none."""
    return samples.select(key).distinct().join(panel.select(key), key, "left_semi")
