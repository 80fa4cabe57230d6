"""Genotype records: repair, filling, gates and frequencies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions import alleles as A

LONGEST_ID = 100
LEAST_EXPLICIT = 0.5
LEAST_SITES = 50


def repaired(records: DataFrame) -> DataFrame:
    """Records of a position made consistent: fate is kept, dropped_homref (a reference record beside a variant) or dropped_dup (REF and ALT seen before); multi: the position has several records."""
    site = Window.partitionBy("iid", "chrom", "pos")
    same = Window.partitionBy("iid", "chrom", "pos", "ref", "alt").orderBy("ord")
    return (
        records.withColumn("multi", F.count(F.lit(1)).over(site) > 1)
        .withColumn("variant", F.max(F.col("alt") != ".").over(site))
        .withColumn("fate", F.when((F.col("alt") == ".") & F.col("variant"), "dropped_homref").when(F.row_number().over(same) > 1, "dropped_dup").otherwise("kept"))
        .drop("variant")
    )


def alt_filled(records: DataFrame, alleles: DataFrame) -> DataFrame:
    """Single reference records get the table's first ALT at their contig and position where REF agrees, and a zero count for it (a missing count stays so); filled says which."""
    table = alleles.select("chrom", "pos", F.col("ref").alias("table_ref"), "first_alt")
    fits = (F.col("r.chrom") == F.col("t.chrom")) & (F.col("r.pos") == F.col("t.pos")) & (F.upper("r.ref") == F.col("t.table_ref")) & (F.col("r.alt") == ".") & ~F.col("r.multi")
    out = records.alias("r").join(table.alias("t"), fits, "left")
    filled = F.col("t.first_alt").isNotNull()
    depth = F.col("r.depth").cast("string")
    return out.select("r.*", filled.alias("filled"), F.coalesce("t.first_alt", "r.alt").alias("new_alt"), F.when(filled & ~depth.isin(".", ""), F.concat(depth, F.lit(",0"))).otherwise(depth).alias("ad"))


def repair_counters(filled: DataFrame) -> DataFrame:
    """By sample: reference records, filled ones, positions of several records (never filled), and records dropped beside a variant or as repeats. filled: alt_filled of repaired."""
    several = F.count_distinct(F.when(F.col("multi"), F.struct("chrom", "pos")))
    return filled.groupBy("iid").agg(
        F.count_if(F.col("alt") == ".").alias("homref"), F.count_if("filled").alias("filled"), several.alias("skipped_multirecord"), F.count_if(F.col("fate") == "dropped_homref").alias("dropped_homref"), F.count_if(F.col("fate") == "dropped_dup").alias("dropped_dup"),
    )


def on_chrx_alone(records: DataFrame) -> DataFrame:
    """Records of chrX outside the regions that it shares with chrY, and called."""
    lo, hi = A.CHRX_NON_PAR
    return records.where((F.col("chrom") == "chrX") & F.col("pos").between(lo, hi) & A.gt_called("gt"))


def genotyped_at_targets(records: DataFrame, targets: DataFrame, depth: DataFrame, least_depth: int = 1) -> DataFrame:
    """A genotype for each sample and target: the record's where there is one, 0/0 where the sample is covered, else ./. (iid, chrom, pos, ref, alt, gt). targets: chrom, pos, ref; depth: iid, chrom, pos, depth, for each sample and target that was looked at."""
    own = records.select("iid", "chrom", "pos", F.col("alt").alias("own_alt"), F.col("gt").alias("own_gt"))
    seen = depth.join(targets, ["chrom", "pos"]).join(own, ["iid", "chrom", "pos"], "left")
    return seen.select("iid", "chrom", "pos", "ref", F.coalesce("own_alt", F.lit(".")).alias("alt"), F.coalesce("own_gt", F.when(F.col("depth") >= least_depth, "0/0").otherwise("./.")).alias("gt"))


def sex_from_genotypes(gts: DataFrame) -> DataFrame:
    """By sample: het and homalt counts on chrX outside the shared regions, and the sex that their ratio tells. gts: iid, gt."""
    n = gts.withColumn("kind", A.gt_class("gt")).groupBy("iid").agg(F.count_if(F.col("kind") == "het").alias("n_het"), F.count_if(F.col("kind") == "homalt").alias("n_hom"))
    total = F.col("n_het") + F.col("n_hom")
    ratio = F.col("n_het") / total
    return n.withColumn("sex", F.when(total < LEAST_SITES, "unknown").when(ratio >= 0.25, "female").when(ratio < 0.10, "male").otherwise("unknown"))


def sex_from_coverage(stats: DataFrame) -> DataFrame:
    """By sample: coverage of X and Y against the mean of covered autosomes. stats: iid, contig, length, mapped."""
    cov = stats.withColumn("cov", F.col("mapped") / F.col("length"))
    auto = F.avg(F.when(F.col("contig").isin(*A.AUTOSOMES) & (F.col("cov") > 0), F.col("cov")))
    on = lambda c: F.max(F.when(F.col("contig") == c, F.col("cov")))
    out = cov.groupBy("iid").agg(F.round(on("chrX") / auto, 6).alias("x_ratio"), F.round(on("chrY") / auto, 6).alias("y_ratio"))
    x, y = F.col("x_ratio"), F.col("y_ratio")
    return out.withColumn("sex", F.when((x >= 0.80) & (y <= 0.15), "female").when((x <= 0.70) & (y >= 0.12), "male").otherwise("unknown"))


#: Positions of a block in which targets are counted.
BLOCK = 1 << 15


def explicit_fraction(records: DataFrame, targets: DataFrame) -> DataFrame:
    """By sample: explicit genotypes at targets, targets inside the contig's span of records, their ratio, and whether the input looks like all sites. The spans are one row a contig and sample; they meet the counts of whole blocks of targets, and targets themselves at their two ends alone."""
    block = lambda c: F.floor(F.col(c) / BLOCK)
    sites = targets.select("chrom", "pos").distinct()
    blocked = sites.withColumn("block", block("pos"))
    span = records.groupBy("iid", "chrom").agg(F.min("pos").alias("lo"), F.max("pos").alias("hi"))
    whole = span.join(blocked.groupBy("chrom", "block").agg(F.count(F.lit(1)).alias("n")), "chrom").where((F.col("block") > block("lo")) & (F.col("block") < block("hi")))
    ends = span.withColumn("block", F.explode(F.array_distinct(F.array(block("lo"), block("hi"))))).join(blocked, ["chrom", "block"]).where("pos between lo and hi")
    counts = whole.groupBy("iid").agg(F.sum("n").alias("n")).unionByName(ends.groupBy("iid").agg(F.count(F.lit(1)).alias("n")))
    inside = counts.groupBy("iid").agg(F.sum("n").alias("n_targets"))
    explicit = records.where(A.gt_called("gt")).join(sites, ["chrom", "pos"], "left_semi").groupBy("iid").agg(F.count_distinct("chrom", "pos").alias("n_explicit"))
    share = F.col("n_explicit") / F.col("n_targets")
    return inside.join(explicit, "iid", "left").na.fill(0, ["n_explicit"]).select("iid", "n_explicit", "n_targets", F.round(share, 6).alias("fraction"), (share >= LEAST_EXPLICIT).alias("all_sites"))


def variant_id(chrom: str = "chrom", pos: str = "pos", ref: str = "ref", alt: str = "alt") -> Column:
    """chrom:pos:ref:alt; null where an allele is too long."""
    whole = F.concat_ws(":", F.col(chrom), F.col(pos).cast("string"), F.col(ref), F.col(alt))
    return F.when(F.greatest(F.length(ref), F.length(alt)) <= LONGEST_ID, whole)


def frequencies(genotypes: DataFrame) -> DataFrame:
    """By variant: alternate frequency over called genotypes, share of missing ones, minor-allele frequency."""
    out = genotypes.groupBy("vid").agg(F.sum("dosage").alias("alt"), F.count("dosage").alias("called"), F.count(F.lit(1)).alias("n"))
    freq = F.when(F.col("called") > 0, F.col("alt") / (2 * F.col("called")))
    return out.select("vid", F.round(freq, 6).alias("alt_freq"), F.round(1 - F.col("called") / F.col("n"), 6).alias("f_miss"), F.round(F.least(freq, 1 - freq), 6).alias("maf"))


def panel_qc(genotypes: DataFrame, variants: DataFrame, most_missing: float = 0.1, least_maf: float = 0.05, least_hwe_chi: float = 15.136705) -> DataFrame:
    """Variants that pass panel quality control: single-base alleles, an id that occurs once, few missing genotypes, frequent enough, and a Hardy-Weinberg chi-square below that of p = 1e-4."""
    once = Window.partitionBy("chrom", "pos")
    snp = variants.withColumn("n_here", F.count(F.lit(1)).over(once)).where((F.col("n_here") == 1) & A.is_acgt("a1") & A.is_acgt("a2") & (F.length("a1") == 1) & (F.length("a2") == 1))
    n = genotypes.groupBy("vid").agg(*(F.count_if(F.col("dosage") == k).alias(f"n{k}") for k in (0, 1, 2)), F.count(F.lit(1)).alias("n"))
    called = F.col("n0") + F.col("n1") + F.col("n2")
    q = (F.col("n1") + 2 * F.col("n2")) / (2 * F.col("called"))
    expect = lambda share: share * F.col("called")
    term = lambda seen, share: F.when(expect(share) > 0, F.pow(F.col(seen) - expect(share), F.lit(2)) / expect(share)).otherwise(0.0)
    n = n.withColumn("called", called).where("called > 0").withColumn("q", q)
    chi = term("n0", (1 - F.col("q")) * (1 - F.col("q"))) + term("n1", 2 * F.col("q") * (1 - F.col("q"))) + term("n2", F.col("q") * F.col("q"))
    good = (1 - F.col("called") / F.col("n") <= most_missing) & (F.least(F.col("q"), 1 - F.col("q")) >= least_maf)
    return snp.join(n.withColumn("hwe_chi", chi), "vid").where(good & (F.col("hwe_chi") < least_hwe_chi)).select("vid", F.round("q", 6).alias("alt_freq"), F.round("hwe_chi", 6).alias("hwe_chi"))
