"""Evidence grades, absolute risk, consensus, meta-scores and their checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions import alleles as A
from strandline.functions.math import norm_cdf, norm_ppf

#: Gates and caveats.
LEAST_COVERAGE = 0.75
LEAST_CONCORDANCE = 0.67
COVERAGE = "low coverage of the variants of the score"
UNCALIBRATED = "UNCALIBRATED: no reference percentile"
PORTABILITY = "portability: score trained in Europeans only"
ROBUSTNESS = "robustness LOW: scores of this trait disagree"
GENERAL = "a polygenic score is not a diagnosis"

def effect_of(scores: DataFrame, effects: DataFrame) -> DataFrame:
    """Adds per_sd: of the score's id (the last row given), else of its trait (the first row given). Rows without a per_sd do not count; traits are compared without case and blanks around them."""
    effects = effects.where("per_sd is not null")
    by_id = effects.groupBy("pgs_id").agg(F.max_by("per_sd", "ord").alias("by_id"))
    by_trait = effects.groupBy(F.lower(F.trim("trait")).alias("trait_key")).agg(F.min_by("per_sd", "ord").alias("by_trait"))
    out = scores.join(by_id, "pgs_id", "left").join(by_trait, F.lower(F.trim(scores["trait"])) == by_trait["trait_key"], "left")
    return out.withColumn("per_sd", F.coalesce("by_id", "by_trait")).drop("by_id", "by_trait", "trait_key")


def baseline_of(scores: DataFrame, baselines: DataFrame, mandated: dict[str, str] | None = None) -> DataFrame:
    """Adds baseline_risk and baseline_sex: the first hit of (sex, ancestry), (sex, overall), (overall, ancestry), (overall, overall), where sex is the trait's (mandated: sex by trait in lower case, for those that exist in one sex only), else the sample's, else overall. Of baselines (trait, sex, ancestry, baseline_risk, ord) of one key the last counts, and those without a risk do not."""
    trait = F.lower(F.trim(F.col("trait")))
    sex = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in mandated.items() for x in kv)), trait) if mandated else F.lit(None).cast("string"), F.nullif("sex", F.lit("unknown")), F.lit("overall"))
    keys = F.array(*(F.struct(s.alias("bsex"), a.alias("banc")) for s in (sex, F.lit("overall")) for a in (F.coalesce("ancestry", F.lit("overall")), F.lit("overall"))))
    ways = scores.withColumn("row_key", F.struct("sample", "pgs_id")).select("*", F.posexplode(keys).alias("way", "key"))
    base = baselines.where("baseline_risk is not null").groupBy(F.lower(F.trim("trait")).alias("btrait"), F.col("sex").alias("bs"), F.col("ancestry").alias("ba")).agg(F.max_by("baseline_risk", "ord").alias("baseline_risk"))
    hit = ways.join(base, (trait == base["btrait"]) & (F.col("key.bsex") == base["bs"]) & (F.col("key.banc") == base["ba"])).groupBy("sample", "pgs_id").agg(F.min_by(F.struct("baseline_risk", F.col("bs").alias("baseline_sex")), "way").alias("b"))
    return scores.join(hit, ["sample", "pgs_id"], "left").select(*(scores[c] for c in scores.columns), F.col("b.baseline_risk").alias("baseline_risk"), F.col("b.baseline_sex").alias("baseline_sex"))


def risk_columns(percentile: str = "percentile", per_sd: str = "per_sd", baseline: str = "baseline_risk") -> tuple[Column, Column]:
    """Relative risk with mean one over the population, and absolute risk on the odds scale."""
    z, beta = F.expr(norm_ppf(f"{percentile} / 100e0")), F.log(F.col(per_sd))
    rr = F.exp(beta * z - beta * beta / 2)
    odds = F.col(baseline) / (1 - F.col(baseline)) * rr
    return rr, odds / (1 + odds)


def graded(scores: DataFrame) -> DataFrame:
    """Gates in order; scores: sample, pgs_id, trait, base_grade, training_ancestry, pop, match_rate, percentile (null: uncalibrated), per_sd, baseline_risk, baseline_sex. Adds portability_flag, evidence_grade, absolute_risk, risk_ratio, allowed_statement. Gates and risks go by match_rate and percentile as they are; these leave rounded, to four places and one."""
    low = F.coalesce(F.col("match_rate") < LEAST_COVERAGE, F.lit(False))
    none = F.col("percentile").isNull()
    foreign = F.coalesce(~none & F.col("pop").isNotNull() & (F.upper("pop") != "EUR") & A.european_only("training_ancestry"), F.lit(False))
    steps = F.when(low, 2).otherwise(0) + F.when(foreign, 1).otherwise(0)
    rr, ar = risk_columns()
    known = ~none & F.col("per_sd").isNotNull() & F.col("baseline_risk").isNotNull()
    sex = F.coalesce("baseline_sex", F.lit("overall")) if "baseline_sex" in scores.columns else F.lit("overall")
    percent = lambda c: F.round(100 * c).cast("int").cast("string")
    risk = F.concat(F.lit("absolute risk ~"), percent(F.round(ar, 4)), F.lit("% for "), sex, F.lit(" vs ~"), percent(F.col("baseline_risk")), F.lit("% baseline (odds scale, illustrative)"))
    caveats = F.array_compact(F.array(F.when(low, COVERAGE), F.when(none, UNCALIBRATED), F.when(foreign, PORTABILITY), F.when(known, risk), F.lit(GENERAL)))
    return scores.withColumns({
        "portability_flag": foreign, "evidence_grade": F.when(none, "D").otherwise(A.downgraded(F.coalesce("base_grade", F.lit("C")), steps)),
        "absolute_risk": F.round(F.when(known, ar), 4), "risk_ratio": F.round(F.when(known, rr), 3), "allowed_statement": F.array_join(caveats, " | "),
        "match_rate": F.round("match_rate", 4), "percentile": F.round("percentile", 1),
    })


def tertile(p: Column) -> Column:
    return F.when(p < 100.0 / 3, 0).when(p > 200.0 / 3, 2).otherwise(1)


def consensus(rows: DataFrame) -> DataFrame:
    """By sample and trait: number of scores, and of those with a percentile (to one place) the concordance (1 - spread / 100) and whether their tertiles agree, null with fewer than two. rows: sample, trait, percentile."""
    p = F.round("percentile", 1)
    out = rows.groupBy("sample", "trait").agg(F.count(F.lit(1)).alias("robustness_n_scores"), F.count(p).alias("calibrated"), F.max(p).alias("hi"), F.min(p).alias("lo"), F.count_distinct(F.when(p.isNotNull(), tertile(p))).alias("tertiles"))
    several = F.col("calibrated") >= 2
    spread = F.greatest(F.lit(0.0), 1 - (F.col("hi") - F.col("lo")) / 100)
    return out.select("sample", "trait", "robustness_n_scores", F.when(several, F.bround(spread, 3)).alias("robustness_concordance"), F.when(several, F.col("tertiles") == 1).alias("same_tertile"))


def flagged(rows: DataFrame, agreement: DataFrame) -> DataFrame:
    """rows with the consensus of their trait, and its caveat where scores disagree."""
    low = (F.col("robustness_n_scores") >= 2) & (~F.col("same_tertile") | (F.col("robustness_concordance") < LEAST_CONCORDANCE))
    out = rows.join(agreement, ["sample", "trait"], "left").withColumn("low_robustness", F.coalesce(low, F.lit(False)))
    return out.withColumn("allowed_statement", F.when(F.col("low_robustness"), F.concat("allowed_statement", F.lit(" | "), F.lit(ROBUSTNESS))).otherwise(F.col("allowed_statement")))


def meta_scores(rows: DataFrame) -> DataFrame:
    """By sample and trait with two scores or more: the weighted mean of standard scores and its normal percentile. rows: sample, trait, z, weight."""
    out = rows.where("z is not null").groupBy("sample", "trait").agg(F.sum(F.col("weight") * F.col("z")).alias("wz"), F.sum("weight").alias("w"), F.count(F.lit(1)).alias("n_scores")).where("n_scores >= 2 and w > 0")
    out = out.withColumn("mz", F.col("wz") / F.col("w"))
    return out.select("sample", "trait", "n_scores", F.round("mz", 6).alias("meta_z"), F.round(F.expr(norm_cdf("mz")) * 100, 3).alias("meta_percentile"))


def exact_meta(rows: DataFrame) -> DataFrame:
    """Meta-scores of every individual with all of a trait's scores, and their percentile against the panel's. rows: iid, sampleset, trait, pgs_id, z."""
    members = rows.groupBy("trait").agg(F.count_distinct("pgs_id").alias("n_members")).where("n_members >= 2")
    own = rows.where("z is not null").groupBy("iid", "sampleset", "trait").agg(F.sum(F.round(F.col("z") * 1000000).cast("bigint")).alias("sum_z"), F.count(F.lit(1)).alias("n"))
    full = own.join(members, "trait").where("n = n_members")
    from strandline.operators.calibrate import panel_ranks

    return panel_ranks(full, ["trait"], "sum_z").select("iid", "sampleset", "trait", F.col("n").alias("n_scores"), "sum_z", "n_panel", "percentile")


def violations(rows: DataFrame) -> DataFrame:
    """Contract problems, a row each: sample, pgs_id, problem."""
    p, r = F.col("percentile"), F.col("absolute_risk")
    rules = {
        "grade": ~F.coalesce(F.col("evidence_grade").isin("A", "B", "C", "D"), F.lit(False)), "flag": F.col("portability_flag").isNull(), "statement": F.coalesce(F.trim("allowed_statement"), F.lit("")) == "",
        "percentile": ~F.coalesce(p.between(0, 100), F.lit(True)), "risk": ~F.coalesce(r.between(0, 1), F.lit(True)), "risk without percentile": r.isNotNull() & p.isNull(),
        "coverage not said": F.coalesce(F.col("match_rate") < LEAST_COVERAGE, F.lit(False)) & ~F.coalesce(F.col("allowed_statement").contains("coverage"), F.lit(False)),
    }
    return rows.select("sample", "pgs_id", F.explode(F.array_compact(F.array(*(F.when(c, F.lit(k)) for k, c in rules.items())))).alias("problem"))


def contract(graded_rows: DataFrame, agreement: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Graded rows with what consensus says of their trait and its caveat, in a contract's columns; those that nothing gives are null."""
    out = flagged(graded_rows, agreement)
    have = set(out.columns)
    return out.select(*(F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in columns))


def file_problems(table: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Problems of a contract read back as text (NA for null): a row for each missing column, with a null sample, then violations of the rows."""
    missing = [c for c in columns if c not in table.columns]
    own = table.select(*(F.nullif(c, F.lit("NA")).alias(c) for c in table.columns), *(F.lit(None).cast("string").alias(c) for c in missing))
    number = lambda c: F.col(c).try_cast("double").alias(c)
    flag = F.when(F.lower("portability_flag").isin("true", "false"), F.lower("portability_flag") == "true").alias("portability_flag")
    rows = violations(own.select("sample", "pgs_id", "evidence_grade", "allowed_statement", flag, number("percentile"), number("absolute_risk"), number("match_rate")))
    lacks = table.sparkSession.createDataFrame([(None, None, f"no column {c}") for c in missing], rows.schema)
    return lacks.unionByName(rows)


def category(grade: str = "evidence_grade", percentile: str = "percentile") -> Column:
    p, weak = F.col(percentile), F.col(grade).isin("C", "D")
    return F.when(p.isNull(), "uncalibrated").when(weak & (p >= 90), "weak-high").when(weak, "weak").when(p >= 90, "elevated").when(p <= 10, "protective").otherwise("average")


def rank_phrase(p: Column) -> Column:
    return F.when(p.isNull(), "-").when(p >= 50, F.concat(F.lit("top "), F.format_number(F.greatest(F.lit(1.0), 100 - p), 0), F.lit("%"))).otherwise(F.concat(F.lit("bottom "), F.format_number(F.greatest(F.lit(1.0), p), 0), F.lit("%")))
