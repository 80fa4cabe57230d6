"""Allele, genotype and id expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AUTOSOMES = tuple(f"chr{i}" for i in range(1, 23))
#: chrX outside the pseudo-autosomal regions (GRCh38).
CHRX_NON_PAR = (2781480, 155701382)


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number(c: str | Column) -> Column:
    """A number, or null for NA and other text."""
    return col(c).try_cast("double")


def with_chr(c: str | Column) -> Column:
    return F.when(col(c).startswith("chr"), col(c)).otherwise(F.concat(F.lit("chr"), col(c)))


def is_acgt(c: str | Column) -> Column:
    return F.coalesce(col(c).rlike("^[ACGT]+$"), F.lit(False))


def complement(c: str | Column) -> Column:
    return F.translate(col(c), "ACGT", "TGCA")


def reverse_complement(c: str | Column) -> Column:
    return F.reverse(complement(c))


def ambiguous(a: str | Column, b: str | Column) -> Column:
    """An allele pair that reads the same on both strands."""
    return F.coalesce(col(a) == reverse_complement(b), F.lit(False))


def score_id(c: str | Column) -> Column:
    """The catalogue id that an accession begins with, or the accession itself."""
    hit = F.regexp_extract(col(c), r"^(PGS\d+)", 1)
    return F.when(hit != "", hit).otherwise(col(c))


def internal_id(c: str | Column) -> Column:
    """A sample name without its other characters than letters and digits; null where nothing is left or the name is reserved."""
    kept = F.regexp_replace(col(c), "[^A-Za-z0-9]", "")
    return F.when((kept != "") & (F.lower(kept) != "reference"), kept)


def alleles_of(gt: str | Column) -> Column:
    return F.split(F.translate(col(gt), "|", "/"), "/")


def gt_called(gt: str | Column) -> Column:
    return ~F.array_contains(alleles_of(gt), ".")


def gt_class(gt: str | Column) -> Column:
    """het, homalt or null; diploid genotypes without a missing allele only."""
    a = alleles_of(gt)
    return F.when((F.size(a) == 2) & gt_called(gt), F.when(F.get(a, F.lit(0)) != F.get(a, F.lit(1)), "het").when(F.get(a, F.lit(0)) != "0", "homalt"))


def european_only(c: str | Column) -> Column:
    label = F.upper(F.trim(col(c)))
    return F.coalesce(label.isin("EUR", "EUR100%", "EUR (100%)", "EUROPEAN") | label.startswith("EUR ("), F.lit(False))


def downgraded(grade: str | Column, steps: Column) -> Column:
    """A grade of A to D, some steps lower, D at least."""
    place = F.array_position(F.array(*map(F.lit, "ABCD")), col(grade)).cast("int")
    return F.element_at(F.array(*map(F.lit, "ABCD")), F.least(F.lit(4), place + steps))
