"""Catalogue records: selection of scores, ancestry profiles, reported performance, trait lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Metric families in order of preference, their patterns, and the bounds of a valid value.
METRICS = (("AUROC", "(?i)auroc|auc", 0.5, 1.0), ("C-index", "(?i)c-?index|c-?statistic", 0.5, 1.0), ("R2", "(?i)^r.?2|r²", 0.0, 1.0))


def evidence_grade(n: Column, has_eval: Column, multi_eval: Column) -> Column:
    """Grade by size of the discovery study and kind of evaluation: the two best need one, the best a large study or several ancestries."""
    return F.when((n >= 100000) & has_eval & (multi_eval | (n >= 250000)), "A").when((n >= 50000) & has_eval, "B").when(n >= 10000, "C").otherwise("D")


def total_samples(samples: Column) -> Column:
    """Sum of sample_number over a nested array; unknown numbers count 0."""
    return F.aggregate(samples, F.lit(0).cast("bigint"), lambda a, x: a + F.coalesce(x["sample_number"], F.lit(0)))


def major_ancestry(dist: Column) -> Column:
    """Key of the largest share of a map; of equal ones the first that the map has."""
    best = F.array_max(F.map_values(dist))
    return F.get(F.map_keys(F.map_filter(dist, lambda k, x: x == best)), F.lit(0))


def multi_ancestry(dist: Column) -> Column:
    """Two named ancestries or more, whatever their shares, or any that is not European."""
    keys = F.map_keys(dist)
    return (F.size(F.array_remove(keys, "")) >= 2) | F.exists(keys, lambda k: ~k.isin("EUR", "European"))


def selected(scores: DataFrame, top: int, pins: DataFrame | None = None) -> DataFrame:
    """The top scores of each trait by grade, size, variants, id; pinned ones (pins: trait, pgs_id) come first, and are made up where the trait has no such row. Adds trait_rank, n_candidates, pinned."""
    own = scores.withColumn("pinned", F.lit(False))
    if pins is not None:
        marked = pins.withColumn("is_pin", F.lit(True))
        own = scores.join(marked, ["trait", "pgs_id"], "left").withColumn("pinned", F.coalesce("is_pin", F.lit(False))).drop("is_pin")
        lacking = pins.join(scores.select("trait", "pgs_id"), ["trait", "pgs_id"], "left_anti").withColumn("pinned", F.lit(True))
        own = own.unionByName(lacking, allowMissingColumns=True)
    order = Window.partitionBy("trait").orderBy(F.col("pinned").desc(), F.col("grade").asc_nulls_last(), F.col("gwas_n").desc_nulls_last(), F.col("n_variants").desc_nulls_last(), "pgs_id")
    out = own.withColumn("trait_rank", F.row_number().over(order)).withColumn("n_candidates", F.count(F.lit(1)).over(Window.partitionBy("trait")))
    return out.where(F.col("trait_rank") <= top)


def reported_performance(reports: DataFrame) -> DataFrame:
    """By score: the first metric family with a valid value, and of it the median, least, largest and number of reports in European samples, or in all where none is European. reports: pgs_id, metric, estimate, ancestry."""
    family = F.coalesce(*(F.when(F.col("metric").rlike(p), F.struct(F.lit(i).alias("i"), F.lit(name).alias("name"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi"))) for i, (name, p, lo, hi) in enumerate(METRICS)))
    own = reports.withColumn("f", family).where("f is not null and estimate between f.lo and f.hi").withColumn("european", F.coalesce(F.lower("ancestry").contains("european"), F.lit(False)))
    best = own.groupBy("pgs_id").agg(F.min("f.i").alias("i"))
    own = own.join(best, "pgs_id").where("f.i = i")
    e = lambda agg: F.coalesce(agg(F.when(F.col("european"), F.col("estimate"))), agg(F.col("estimate")))
    n = F.count_if("european")
    return own.groupBy("pgs_id", F.col("f.name").alias("metric")).agg(F.round(e(lambda c: F.median(c)), 6).alias("value"), F.when(n > 0, n).otherwise(F.count(F.lit(1))).alias("n_reports"), e(F.min).alias("lo"), e(F.max).alias("hi"))


def trait_ids(found: DataFrame, thin: int = 3) -> DataFrame:
    """By search term: the trait id with most associated scores (the first of equal ones), and whether it is thin. found: term, trait_id, n_scores, ord."""
    out = found.groupBy("term").agg(F.max_by(F.struct("trait_id", "n_scores"), F.struct("n_scores", -F.col("ord"))).alias("b"))
    return out.select("term", F.col("b.trait_id").alias("trait_id"), F.col("b.n_scores").alias("n_scores"), (F.col("b.n_scores") < thin).alias("thin"))


def first_keyword(text: Column, systems) -> Column:
    """The first system of an ordered list of (system, words) of which the text holds a word."""
    return F.coalesce(*(F.when(F.lower(text).rlike("|".join(words)), F.lit(name)) for name, words in systems), F.lit("other"))
