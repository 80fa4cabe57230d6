"""Variant matching, labels, summaries, and their incremental maintenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions import alleles as A
from strandline.sources import shared

#: Match types in order of priority.
TYPES = ("refalt", "altref", "refalt_flip", "altref_flip", "no_oa_ref", "no_oa_alt", "no_oa_ref_flip", "no_oa_alt_flip")
STATUS = ("unmatched", "matched", "excluded", "not_best")


def candidates(rows: DataFrame, variants: DataFrame) -> DataFrame:
    """Every way in which a scoring row's alleles fit the target variant at its position. rows: accession, row_nr, chrom, pos, effect_allele, other_allele; variants: vid, chrom, pos, a1 (REF), a2 (ALT). Adds vid, a1, a2, priority (1 is best), match_type, flipped, effect_is_alt, ambiguous."""
    ea, oa, ref, alt = map(F.col, ("effect_allele", "other_allele", "a1", "a2"))
    fea, foa = A.complement(ea), A.complement(oa)
    none = oa.isNull()
    fits = ((ea == ref) & (oa == alt), (ea == alt) & (oa == ref), (fea == ref) & (foa == alt), (fea == alt) & (foa == ref), none & (ea == ref), none & (ea == alt), none & (fea == ref), none & (fea == alt))
    hits = F.filter(F.array(*(F.when(x, F.lit(i)) for i, x in enumerate(fits, 1))), lambda i: i.isNotNull())
    out = rows.join(variants.select("vid", "chrom", "pos", "a1", "a2"), ["chrom", "pos"]).withColumn("priority", F.explode(hits))
    kind = F.element_at(F.array(*map(F.lit, TYPES)), F.col("priority"))
    return out.withColumns({"match_type": kind, "flipped": kind.endswith("_flip"), "effect_is_alt": kind.rlike("^(altref|no_oa_alt)"), "ambiguous": A.ambiguous("a1", "a2")})


def match_status(best: Column, exclude: Column) -> Column:
    """unmatched, matched, excluded or not_best; null where both flags are null."""
    m = F.when(best.isNull(), 0).when(best, 1).otherwise(3)
    e = F.when(F.coalesce(exclude, F.lit(False)), 2).otherwise(0)
    return F.when(best.isNull() & exclude.isNull(), None).otherwise(F.element_at(F.array(*map(F.lit, STATUS)), F.greatest(m, e) + 1))


def labelled(found: DataFrame, drop_ambiguous: bool = True) -> DataFrame:
    """Candidates with best_match, duplicate_best_match, duplicate_id, exclude and match_status. A target variant that several rows of an accession match best is excluded for all of them."""
    row = Window.partitionBy("accession", "row_nr")
    place = F.rank().over(row.orderBy("priority", "vid"))
    out = found.withColumn("best_match", place == 1).withColumn("duplicate_best_match", F.count_if("best_match").over(row) > 1)
    out = out.withColumn("duplicate_id", F.count_if("best_match").over(Window.partitionBy("accession", "vid")) > 1)
    out = out.withColumn("exclude", (F.lit(drop_ambiguous) & F.col("ambiguous")) | F.col("duplicate_id"))
    return out.withColumn("match_status", match_status(F.col("best_match"), F.col("exclude")))


LABELS = ("match_status", "ambiguous", "flipped", "duplicate_id")


def counted(rows: DataFrame, best: DataFrame, how: str = "full") -> DataFrame:
    """Counts (n) of scoring rows by accession and labels of their best candidates, each pair of a row and a candidate of its number once. Rows without a candidate are unmatched."""
    all_rows = rows.select("accession", "row_nr").join(best.select("accession", "row_nr", *LABELS), ["accession", "row_nr"], how).withColumn("match_status", F.coalesce("match_status", F.lit("unmatched")))
    return all_rows.groupBy("accession", *LABELS).agg(F.count(F.lit(1)).alias("n"))


def summary(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts of scoring rows by accession and labels of their best candidate, and the share of the accession's rows."""
    share = 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy("accession"))
    return counted(rows, labels.where("best_match")).withColumn("percent", F.round(share, 6))


def matched(labels: DataFrame) -> DataFrame:
    return labels.where("best_match and not exclude")


def maintained(cached: DataFrame, old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Cached counts less those of the rows' old labels plus those of the new ones; groups that reach zero go. Null keys are values like others. old, new: keys, and n where they are counts already."""
    n = lambda df: df.select(*keys, "n") if "n" in df.columns else df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    signed = n(cached).unionByName(n(old).withColumn("n", -F.col("n"))).unionByName(n(new))
    return signed.groupBy(*keys).agg(F.sum("n").alias("n")).where("n <> 0")


def affected(labels: DataFrame, changed: DataFrame) -> DataFrame:
    """Scoring rows whose labels may change with the variants changed (vid): those with such a variant, then those that share a variant with one of them inside an accession, until none is added, however many rounds that takes. Each round is a checkpoint in the shared folder."""
    shared.folder(labels.sparkSession)  # of the checkpoints
    links = labels.select("accession", "row_nr", "vid").distinct()
    rows = links.join(changed.select("vid"), "vid", "left_semi").select("accession", "row_nr").distinct().checkpoint()
    n = rows.count()
    while True:
        met = links.join(rows, ["accession", "row_nr"], "left_semi").select("accession", "vid").distinct()
        rows = links.join(met, ["accession", "vid"], "left_semi").select("accession", "row_nr").union(rows).distinct().checkpoint()
        m = rows.count()
        if m == n:
            return rows
        n = m


def wide_weights(rows: DataFrame, accessions: list[str] | None = None) -> DataFrame:
    """One row for each variant and effect allele, a column of weights for each accession, 0 where it has none; for export."""
    return rows.groupBy("vid", "matched_allele").pivot("accession", accessions).agg(F.sum("w")).na.fill(0)


#: All labels by which a summary may count.
ALL_LABELS = ("match_status", "ambiguous", "is_multiallelic", "duplicate_best_match", "duplicate_id", "flipped", "match_type", "exclude")


def label_counts(labels: DataFrame) -> DataFrame:
    """Best candidates by accession and all labels; is_multiallelic: several target variants at the position."""
    many = labels.groupBy("chrom", "pos").agg((F.count_distinct("vid") > 1).alias("is_multiallelic"))
    return labels.where("best_match").join(many, ["chrom", "pos"]).groupBy("accession", *ALL_LABELS).agg(F.count(F.lit(1)).alias("n"))


def splits(rows: DataFrame) -> DataFrame:
    """Rows of a wide scoring file with the split (0, 1, ...) of their effect type that each stands in: a variant and allele of several effect types or weights within an accession cannot share one. rows: accession, row_nr, vid, matched_allele, effect_type, w."""
    order = Window.partitionBy("accession", "vid", "matched_allele", "effect_type").orderBy("row_nr")
    return rows.withColumn("split", F.row_number().over(order) - 1)


def rewritten(rows: DataFrame, gone: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A cached wide file less the variants that have gone (vid), and by effect type and split what guards it: rows before, deleted and after, and whether the cached file may be used so: none is empty, and each split stays smaller than the one before. rows: what splits gives."""
    own = rows.join(gone.select("vid").distinct().withColumn("is_gone", F.lit(True)), "vid", "left").withColumn("is_gone", F.coalesce("is_gone", F.lit(False)))
    n = own.groupBy("effect_type", "split").agg(F.count(F.lit(1)).alias("n_before"), F.count_if("is_gone").alias("n_deleted")).withColumn("n_after", F.col("n_before") - F.col("n_deleted"))
    last = F.lag("n_after").over(Window.partitionBy("effect_type").orderBy("split"))
    return own.where("not is_gone").drop("is_gone"), n.withColumn("usable", (F.col("n_after") > 0) & F.coalesce(F.col("n_after") < last, F.lit(True)))


def rewrite_faults(rows: DataFrame, deleted: DataFrame, cached: DataFrame, passing: DataFrame) -> DataFrame:
    """What forbids to delete variants from a cached wide file instead of writing it anew: fault, effect_type, split, accession, n. None is left where the rewritten file is what a new one would be.

    rows: what splits gives; deleted: accession, vid, matched_allele, effect_type of the matched rows that go; cached, passing: accessions that the file was made for, and those that pass now. A passing set that changed; a deleted row without a cached one; a split that is empty, or no smaller than the one before it, before or after; an accession that a split loses; and variants whose deletion takes other rows with them."""
    where = ["effect_type", "split"]
    own = deleted.select("accession", "vid", "matched_allele", "effect_type").join(passing, "accession", "left_semi")
    ids = rows.select("vid", "matched_allele", *where).distinct()
    found = own.join(ids, ["vid", "matched_allele", "effect_type"], "left")
    gone = found.where("split is not null")
    n = rows.groupBy(*where, "accession").agg(F.count(F.lit(1)).alias("n")).join(gone.groupBy(*where, "accession").agg(F.count(F.lit(1)).alias("gone")), [*where, "accession"], "left").na.fill(0, ["gone"])
    before = Window.partitionBy("effect_type").orderBy("split")
    sizes = n.groupBy(*where).agg(F.sum("n").alias("before"), F.sum("gone").alias("gone")).withColumn("after", F.col("before") - F.col("gone"))
    badly = sizes.withColumn("badly", (F.col("before") >= F.lag("before").over(before)) | (F.col("after") >= F.lag("after").over(before))).where("badly")
    changed = cached.join(passing, "accession", "left_anti").union(passing.join(cached, "accession", "left_anti"))
    removed = ids.join(gone.select("vid").distinct(), "vid", "left_semi").groupBy(*where).agg(F.count(F.lit(1)).alias("removed"))
    expected = gone.select("vid", "matched_allele", *where).distinct().groupBy(*where).agg(F.count(F.lit(1)).alias("expected"))
    others = removed.join(expected, where, "full").withColumn("n", F.coalesce("removed", F.lit(0)) - F.coalesce("expected", F.lit(0))).where("n <> 0")
    text, none = F.lit(None).cast("string"), F.lit(None).cast("int")
    shown = lambda df, fault, effect_type=F.col("effect_type"), split=F.col("split"), accession=text, n=F.col("n"): df.select(F.lit(fault).alias("fault"), effect_type.alias("effect_type"), split.cast("int").alias("split"), accession.alias("accession"), n.cast("bigint").alias("n"))
    faults = [
        shown(changed.groupBy("accession").agg(F.count(F.lit(1)).alias("n")), "passing set changed", text, none, F.col("accession")),
        shown(found.where("split is null").groupBy("effect_type", "accession").agg(F.count(F.lit(1)).alias("n")), "no cached row", split=none, accession=F.col("accession")),
        shown(sizes.where("after <= 0"), "empty", n=F.col("after")), shown(badly, "sizes do not fall", n=F.col("after")),
        shown(n.where("n <= gone"), "accession vanishes", accession=F.col("accession"), n=F.col("n") - F.col("gone")), shown(others, "removes others"),
    ]
    out = faults[0]
    for more in faults[1:]:
        out = out.union(more)
    return out


def restricted(rows: DataFrame, variants: DataFrame, own: DataFrame) -> DataFrame:
    """Labels for one sample from the start: candidates among the variants that it has (vid) alone, labelled anew; what maintained() must come to."""
    return labelled(candidates(rows, variants.join(own.select("vid").distinct(), "vid", "left_semi")))
