"""Batching of scores by size, merging of their results, ids, comparisons and fits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_fit_decreasing(files: DataFrame, budget: int) -> DataFrame:
    """Bins of files (name, size) under a byte budget: largest first, names break ties, each into the first bin with room; what is larger than the budget gets a bin alone. A catalogue's list of files is small: it is folded as one array."""
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("size")).alias("neg"), "name")))
    empty = F.struct(F.expr("array()").cast("array<bigint>").alias("bins"), F.expr("array()").cast("array<struct<bin:int,name:string,size:bigint>>").alias("out"))

    def put(state: Column, item: Column) -> Column:
        size = (-item["neg"]).cast("bigint")
        fits = F.array_position(F.transform(state["bins"], lambda used: used + size <= budget), True).cast("int")
        at = F.when(fits > 0, fits).otherwise(F.size(state["bins"]) + 1)
        bins = F.when(fits > 0, F.transform(state["bins"], lambda used, i: F.when(i + 1 == fits, used + size).otherwise(used))).otherwise(F.concat(state["bins"], F.array(size)))
        return F.struct(bins.alias("bins"), F.concat(state["out"], F.array(F.struct(at.alias("bin"), item["name"].alias("name"), size.alias("size")))).alias("out"))

    return files.agg(F.aggregate(ordered, empty, put).alias("s")).select(F.inline("s.out"))


def least_loaded(files: DataFrame, n_bins: int) -> DataFrame:
    """n_bins bins of files (name, size): largest first, names break ties, each into the least loaded bin, the first of equal ones."""
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("size")).alias("neg"), "name")))
    empty = F.struct(F.array_repeat(F.lit(0).cast("bigint"), n_bins).alias("bins"), F.expr("array()").cast("array<struct<bin:int,name:string,size:bigint>>").alias("out"))

    def put(state: Column, item: Column) -> Column:
        size = (-item["neg"]).cast("bigint")
        at = F.array_position(state["bins"], F.array_min(state["bins"])).cast("int")
        bins = F.transform(state["bins"], lambda used, i: F.when(i + 1 == at, used + size).otherwise(used))
        return F.struct(bins.alias("bins"), F.concat(state["out"], F.array(F.struct(at.alias("bin"), item["name"].alias("name"), size.alias("size")))).alias("out"))

    return files.agg(F.aggregate(ordered, empty, put).alias("s")).select(F.inline("s.out"))


def in_several_bins(scores: DataFrame) -> DataFrame:
    """Scores that more than one bin holds; merging asks for none. scores: bin, pgs_id."""
    return scores.groupBy("pgs_id").agg(F.count_distinct("bin").alias("n_bins")).where("n_bins > 1")


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of either that the other lacks, with the side that has them."""
    return a.distinct().join(b, a.columns, "left_anti").withColumn("side", F.lit("left")).unionByName(b.distinct().join(a, b.columns, "left_anti").withColumn("side", F.lit("right")))


def multiset_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows whose number differs, with both numbers."""
    n = lambda df, c: df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(c))
    return n(a, "n_left").join(n(b, "n_right"), a.columns, "full").na.fill(0, ["n_left", "n_right"]).where("n_left <> n_right")


def compared(a: DataFrame, b: DataFrame, keys: list[str], values: list[str], rtol: float = 1e-9) -> DataFrame:
    """Cell-wise comparison of two keyed tables of numbers: by column the keys on one side only, equal cells, cells within rtol, cells beyond, largest relative difference."""
    left, right = (df.select(*keys, *(F.col(c).cast("double").alias(f"{side}_{c}") for c in values), F.lit(1).alias(f"in_{side}")) for df, side in ((a, "l"), (b, "r")))
    both = left.join(right, keys, "full")
    cells = both.select("in_l", "in_r", F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"l_{c}").alias("x"), F.col(f"r_{c}").alias("y")) for c in values))).alias("c")).select("in_l", "in_r", "c.*")
    paired = F.col("in_l").isNotNull() & F.col("in_r").isNotNull()
    equal = paired & F.col("x").eqNullSafe(F.col("y"))
    rel = F.when(paired & F.col("x").isNotNull() & F.col("y").isNotNull(), F.abs(F.col("x") - F.col("y")) / F.greatest(F.abs("x"), F.abs("y"), F.lit(1e-300)))
    return cells.groupBy("column").agg(
        F.count_if(F.col("in_r").isNull()).alias("only_left"), F.count_if(F.col("in_l").isNull()).alias("only_right"), F.count_if(equal).alias("equal"), F.count_if(~equal & (rel <= rtol)).alias("close"),
        F.count_if(paired & ~equal & ~F.coalesce(rel <= rtol, F.lit(False))).alias("different"), F.round(F.max(rel), 6).alias("max_rel"),
    )


def gigabytes(text: Column) -> Column:
    """A size like '108 GB' in GB; '-' is 0."""
    unit = F.element_at(F.split(F.trim(text), r"\s+"), -1)
    value = F.element_at(F.split(F.trim(text), r"\s+"), 1).try_cast("double")
    power = F.array_position(F.array(*map(F.lit, ("B", "KB", "MB", "GB", "TB"))), F.upper(unit)).cast("int")
    return F.when(F.trim(text) == "-", 0.0).when(power > 0, value * F.pow(F.lit(1024.0), power - 4))


def peaks(trace: DataFrame) -> DataFrame:
    """Largest peak by step, and over all steps (step null). trace: step, gb."""
    return trace.rollup("step").agg(F.max("gb").alias("peak_gb"), F.count(F.lit(1)).alias("n"))


def budget_fit(points: DataFrame, target: float) -> DataFrame:
    """Least-squares line of y over x, and the x at which it reaches target: 0 at least, infinite where the slope is not positive; null where all x are equal."""
    fit = points.agg(F.regr_slope("y", "x").alias("slope"), F.regr_intercept("y", "x").alias("cut"))
    size = F.when(F.col("slope") <= 0, F.lit(float("inf"))).otherwise(F.greatest(F.lit(0.0), (F.lit(target) - F.col("cut")) / F.col("slope")))
    return fit.select(F.round("slope", 6).alias("slope"), F.round("cut", 6).alias("cut"), F.round(size, 6).alias("budget"))


def id_collisions(names: DataFrame, internal: Column) -> DataFrame:
    """Names that share an internal id with another name. names: name."""
    own = names.select("name", internal.alias("sid")).distinct()
    return own.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("sid"))).where("sid is not null and n > 1").drop("n")


def equivalent(one: DataFrame, bins: DataFrame, rel: float = 1e-4, absolute: float = 1e-3) -> DataFrame:
    """Scores that a batched run gives otherwise than a single one: missing on a side, other matched counts, or sums apart by more than both tolerances. Both: iid, accession, score_sum, denom."""
    a, b = one.select("iid", "accession", F.col("score_sum").alias("sa"), F.col("denom").alias("da")), bins.select("iid", "accession", F.col("score_sum").alias("sb"), F.col("denom").alias("db"))
    gap = F.abs(F.col("sa") - F.col("sb"))
    far = (gap > absolute) & (gap > rel * F.greatest(F.abs("sa"), F.abs("sb")))
    return a.join(b, ["iid", "accession"], "full").where(F.col("sa").isNull() | F.col("sb").isNull() | (F.col("da") != F.col("db")) | far)


def bin_summary(bins: DataFrame) -> DataFrame:
    """By bin its files and bytes, and whether it is the fullest (the first of equal ones). bins: bin, name, size."""
    own = bins.groupBy("bin").agg(F.count(F.lit(1)).alias("n_files"), F.sum("size").alias("size"))
    worst = own.agg(F.max(F.struct("size", (-F.col("bin")).alias("neg"))).alias("w"))
    return own.join(F.broadcast(worst), (F.col("w.size") == F.col("size")) & (-F.col("bin") == F.col("w.neg")), "left").select("bin", "n_files", "size", F.col("w").isNotNull().alias("worst"))


def archaic_calls(records: DataFrame, panel: DataFrame) -> DataFrame:
    """Copies of the archaic allele and called alleles at a panel's sites (chrom, pos, archaic), by sample: iid, archaic, total, sites. Contigs may have their prefix or not. Of several records at a place the first (ord) whose call lacks no allele counts; alleles that its list does not have are not called. records: iid, chrom, pos, ref, alt, gt, ord, and nth where ord may tie: the place in the table, by which ties go."""
    from strandline.functions.alleles import alleles_of, with_chr

    sites = panel.select(with_chr("chrom").alias("site"), "pos", "archaic")
    whole = records.where(F.col("gt").isNotNull() & (F.col("gt") != "") & ~F.col("gt").contains("."))
    own = whole.withColumn("site", with_chr("chrom")).join(sites, ["site", "pos"])
    first = own.groupBy("iid", "chrom", "pos", "archaic").agg(F.min_by(F.struct("ref", "alt", "gt"), F.struct(*(c for c in ("ord", "nth") if c in records.columns))).alias("r"))
    names = F.concat(F.array("r.ref"), F.when(F.col("r.alt") == ".", F.array().cast("array<string>")).otherwise(F.split("r.alt", ",")))
    called = F.filter(F.transform(alleles_of("r.gt"), lambda a: a.try_cast("int")), lambda a: a < F.size(names))
    n = first.select("iid", F.size(F.filter(called, lambda a: F.upper(F.get(names, a)) == F.upper("archaic"))).alias("archaic"), F.size(called).alias("total")).where("total > 0")
    return n.groupBy("iid").agg(F.sum("archaic").alias("archaic"), F.sum("total").alias("total"), F.count(F.lit(1)).alias("sites"))


def archaic_estimate(genotypes: DataFrame, panel: DataFrame, slope: float = 3.0, intercept: float = 0.0, most: float = 10.0, version: str = "v1", least_sites: int = 50, provisional: int = 500) -> DataFrame:
    """By sample: archaic alleles over alleles called at the panel's sites as a percentage on a linear calibration (see sources.files.calibration), null below least_sites sites. genotypes: iid, vid, dosage (ALT copies); panel: vid, archaic_is_alt (a small table)."""
    n_sites = panel.agg(F.count(F.lit(1)).alias("n_panel"))
    own = genotypes.where("dosage is not null").join(panel, "vid").groupBy("iid").agg(F.sum(F.when(F.col("archaic_is_alt"), F.col("dosage")).otherwise(2 - F.col("dosage"))).alias("archaic"), (2 * F.count(F.lit(1))).alias("total"), F.count(F.lit(1)).alias("sites"))
    pct = F.least(F.lit(most), F.greatest(F.lit(0.0), F.col("archaic") / F.col("total") * slope + intercept))
    out = own.withColumn("pct", F.when(F.col("sites") >= least_sites, F.round(pct, 2)))
    tag = F.when(F.col("n_panel") < provisional, " PROVISIONAL-SEED (expand panel before interpreting)").otherwise("")
    method = F.concat(F.lit(f"dosage-over-archaic-tag-panel-{version} ("), F.col("sites").cast("string"), F.lit("/"), F.col("n_panel").cast("string"), F.lit(" sites genotyped, calibrated to 1kGP)"), tag, F.when(F.col("sites") < least_sites, " | INSUFFICIENT genotyped sites").otherwise(""))
    return out.join(F.broadcast(n_sites)).withColumn("method", method).drop("n_panel")


def partition_faults(files: DataFrame, bins: DataFrame) -> DataFrame:
    """Files that a packing into bins lost, made up or holds several times; none where it is a partition. Both: name."""
    n = lambda df, c: df.groupBy("name").agg(F.count(F.lit(1)).alias(c))
    return n(files, "n_files").join(n(bins, "n_bins"), "name", "full").na.fill(0, ["n_files", "n_bins"]).where("n_files <> n_bins")


def smoke(expected: DataFrame, got: DataFrame, absolute: float = 1e-6) -> DataFrame:
    """Expected scores that a run lacks or gives otherwise: sums apart by absolute or more, or matched counts that differ as text. Both: pgs_id, score_sum, n_matched."""
    b = got.select("pgs_id", F.col("score_sum").alias("got_sum"), F.col("n_matched").cast("string").alias("got_n"))
    fine = (F.abs(F.col("score_sum") - F.col("got_sum")) < absolute) & (F.col("n_matched").cast("string") == F.col("got_n"))
    return expected.join(b, "pgs_id", "left").where(~F.coalesce(fine, F.lit(False)))


def largest(files: DataFrame, n: int = 8) -> DataFrame:
    """Files (name, size) with their part: head for the n largest, names breaking ties, tail for the rest. The n are found by a top-n, so no file but them is sorted in one place."""
    head = files.orderBy(F.desc("size"), "name").limit(n).select("name", F.lit(True).alias("is_head"))
    return files.join(F.broadcast(head), "name", "left").select("name", "size", F.when(F.col("is_head"), "head").otherwise("tail").alias("part"))


def chunks(sites: DataFrame, n: int) -> DataFrame:
    """Sites in n chunks of about as many each, in the order of the genome: a range partitioning, whose number is the chunk."""
    from strandline.operators.targets import genome_order

    ordered = sites.withColumn("contig_order", genome_order()).repartitionByRange(n, "contig_order", "chrom", "pos")
    return ordered.withColumn("chunk", F.spark_partition_id()).drop("contig_order")
