"""Quality control of a reference panel in two passes: people first, then variants by an exact test."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions import alleles as A


def exact_p(hom: int, het: int, other: int) -> float:
    """P-value of the exact Hardy-Weinberg test: the share of probability, over all numbers of heterozygotes that these alleles allow, of those no likelier than the number seen."""
    n, rare = hom + het + other, 2 * min(hom, other) + het
    if not n:
        return 1.0
    h = np.arange(rare % 2, rare + 1, 2)
    both = _log_factorials(n)
    few = (rare - h) // 2
    log = h * math.log(2) - both[h] - both[few] - both[n - h - few]
    p = np.exp(log - log.max())
    return float(p[log <= log[(het - rare % 2) // 2] + 1e-8].sum() / p.sum())


_TABLE = [np.zeros(1)]


def _log_factorials(n: int) -> np.ndarray:
    if len(_TABLE[0]) <= n:
        _TABLE[0] = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, 2 * n + 1)))])
    return _TABLE[0]


def hardy_weinberg(counts: DataFrame) -> DataFrame:
    """counts (vid, n0, n1, n2 and what else) with hwe_p. Equal counts of a batch are worked out once."""

    def run(batches):
        for batch in batches:
            n = np.stack([batch.column(c).to_numpy() for c in ("n0", "n1", "n2")], axis=1)
            own, of = np.unique(n, axis=0, return_inverse=True)
            p = np.array([exact_p(*map(int, x)) for x in own])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p[of.reshape(-1)] if len(n) else np.zeros(0))], [*batch.schema.names, "hwe_p"])

    kinds = ", ".join(f"`{c}` {t}" for c, t in counts.dtypes)
    return counts.mapInArrow(run, f"{kinds}, hwe_p double")


def single_base(variants: DataFrame) -> DataFrame:
    """Autosomal variants (vid, chrom, pos, a1, a2) of two single ACGT alleles whose id (place and alleles) occurs once; of a repeated id none stays."""
    once = Window.partitionBy("chrom", "pos", F.least("a1", "a2"), F.greatest("a1", "a2"))
    same = variants.withColumn("n_here", F.count(F.lit(1)).over(once))
    return same.where((F.col("n_here") == 1) & A.is_acgt("a1") & A.is_acgt("a2") & (F.length("a1") == 1) & (F.length("a2") == 1) & F.col("chrom").isin(*A.AUTOSOMES)).drop("n_here")


def called_people(genotypes: DataFrame, most_missing: float = 0.1) -> DataFrame:
    """People (iid) of whose genotypes no larger share is missing."""
    return genotypes.groupBy("iid").agg((1 - F.count("dosage") / F.count(F.lit(1))).alias("missing")).where(F.col("missing") <= most_missing).select("iid")


def panel_quality(genotypes: DataFrame, variants: DataFrame, people_missing: float = 0.1, variant_missing: float = 0.1, least_maf: float = 0.05, least_p: float = 1e-4) -> DataFrame:
    """Variants that pass, over the people who pass before them: vid, alt_freq, hwe_p, n_people. People go by their missing genotypes at single-base variants; variants by missing genotypes, minor-allele frequency and the exact test among the people left."""
    own = genotypes.join(single_base(variants).select("vid"), "vid", "left_semi")
    left = own.join(called_people(own, people_missing), "iid", "left_semi")
    n = left.groupBy("vid").agg(*(F.count_if(F.col("dosage") == k).alias(f"n{k}") for k in (0, 1, 2)), F.count("dosage").alias("called"), F.count(F.lit(1)).alias("n_people"))
    q = (F.col("n1") + 2 * F.col("n2")) / (2 * F.col("called"))
    good = n.where("called > 0").withColumn("q", q).where((1 - F.col("called") / F.col("n_people") <= variant_missing) & (F.least(F.col("q"), 1 - F.col("q")) >= least_maf))
    return hardy_weinberg(good).where(F.col("hwe_p") >= least_p).select("vid", F.round("q", 6).alias("alt_freq"), F.round("hwe_p", 6).alias("hwe_p"), "n_people")
