"""Scoring rows, and the sites that a sample is to be genotyped at."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions import alleles as A

REASONS = ("off_contig", "sex_chromosome", "bad_position", "missing_allele", "not_acgt", "reference_mismatch")
MOST_ALTS = 100


def normalised(rows: DataFrame) -> DataFrame:
    """Scoring rows with a chr prefix, upper-case alleles, the inferred other allele where none is given, and the catalogue id."""
    other = F.coalesce(F.nullif(F.upper("other_allele"), F.lit("")), F.nullif(F.upper("inferred_other"), F.lit("")))
    return rows.select(A.score_id("accession").alias("pgs_id"), A.with_chr("chr_name").alias("chrom"), F.col("position").try_cast("bigint").alias("pos"), F.upper("effect_allele").alias("effect_allele"), other.alias("other_allele"))


def reject_reason(ref: str = "ref") -> Column:
    """Why a scoring row cannot become a site, or null; the first reason counts."""
    chrom, pos, ea, oa = map(F.col, ("chrom", "pos", "effect_allele", "other_allele"))
    return (
        F.when(chrom.isin("chrX", "chrY", "chrM"), "sex_chromosome").when(~chrom.isin(*A.AUTOSOMES), "off_contig").when(pos.isNull() | (pos <= 0), "bad_position")
        .when(ea.isNull() | oa.isNull(), "missing_allele").when(~A.is_acgt(ea) | ~A.is_acgt(oa), "not_acgt").when(oriented_ref(ea, oa, F.col(ref)).isNull(), "reference_mismatch")
    )


def oriented_ref(a: Column, b: Column, genome: Column) -> Column:
    """Of two alleles the one that the reference sequence begins with, the longer of two, the first of equal ones; null if none or if they are equal."""
    fits = lambda x: genome.startswith(x)
    return F.when(a == b, None).when(fits(a) & (~fits(b) | (F.length(a) >= F.length(b))), a).when(fits(b), b)


def target_sites(rows: DataFrame) -> DataFrame:
    """One row for each site: chrom, pos, ref (of the first row), alts (distinct, in order of first sight, MOST_ALTS at most), conflicts (rows whose ref differs). rows: chrom, pos, effect_allele, other_allele, genome, ord."""
    a, b = F.col("effect_allele"), F.col("other_allele")
    ref = oriented_ref(a, b, F.col("genome"))
    known = rows.withColumn("ref", ref).where("ref is not null").withColumn("alt", F.when(F.col("ref") == a, b).otherwise(a))
    first = known.groupBy("chrom", "pos").agg(F.min_by("ref", "ord").alias("site_ref"), F.count(F.lit(1)).alias("n"))
    same = known.join(first, ["chrom", "pos"]).where("ref = site_ref").groupBy("chrom", "pos", "ref", "n", "alt").agg(F.min("ord").alias("ord"), F.count(F.lit(1)).alias("k"))
    alts = F.slice(F.transform(F.array_sort(F.collect_list(F.struct("ord", "alt"))), lambda x: x["alt"]), 1, MOST_ALTS)
    return same.groupBy("chrom", "pos", "ref", "n").agg(alts.alias("alts"), F.sum("k").alias("k")).select("chrom", "pos", "ref", "alts", (F.col("n") - F.col("k")).alias("conflicts"))


def genome_order(chrom: str = "chrom") -> Column:
    """Numeric contig order; other contigs last."""
    return F.coalesce(F.substring(chrom, 4, 10).try_cast("int"), F.lit(1000))


def first_alt_table(sites: DataFrame) -> DataFrame:
    return sites.select("chrom", "pos", "ref", F.element_at("alts", 1).alias("first_alt"))


def best_of(df: DataFrame, keys: list[str], *order) -> DataFrame:
    """The first row of each group in the order given."""
    return df.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("place = 1").drop("place")
