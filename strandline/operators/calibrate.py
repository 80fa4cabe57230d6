"""Scores against a reference panel."""

from __future__ import annotations

from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Individuals of a score below which a panel tells nothing.
LEAST_PANEL = 100


def is_reference(c: str = "sampleset"):
    return F.lower(F.trim(F.col(c))) == "reference"


def panel_ranks(scores: DataFrame, keys: list[str], value: str = "score_sum", spread: int | None = None) -> DataFrame:
    """Share (percent) of the panel's individuals with the same keys whose value is strictly below; the number of such individuals. scores: also sampleset. Groups are ranked by counts of distinct values, so a hot value is one row.

    A group's distinct values are dealt by range over spread tasks (as many as an eighth of the shuffle partitions when not given): cuts are quantiles of the group, running counts are taken inside a range, and those of the ranges before are added."""
    spread = spread or max(1, int(scores.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 8)
    ref = F.when(is_reference(), 1).otherwise(0)
    steps = scores.groupBy(*keys, value).agg(F.sum(ref).alias("here"))
    ahead = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    if spread == 1:
        steps = steps.withColumns({"n_below": F.coalesce(F.sum("here").over(ahead(*keys).orderBy(value)), F.lit(0)), "n_panel": F.sum("here").over(Window.partitionBy(*keys))})
    else:
        cuts = steps.groupBy(*(F.col(k).alias(f"of {k}") for k in keys)).agg(F.percentile_approx(value, [k / spread for k in range(1, spread)], F.lit(100 * spread)).alias("cuts"))
        same = [F.col(k).eqNullSafe(F.col(f"of {k}")) for k in keys]
        steps = steps.join(cuts, reduce(and_, same)).select(*keys, value, "here", F.size(F.filter("cuts", lambda c: c <= F.col(value))).alias("range"))
        ranges = steps.groupBy(*keys, "range").agg(F.sum("here").alias("n"))
        ranges = ranges.withColumns({"before": F.coalesce(F.sum("n").over(ahead(*keys).orderBy("range")), F.lit(0)), "n_panel": F.sum("n").over(Window.partitionBy(*keys))}).drop("n")
        inside = F.coalesce(F.sum("here").over(ahead(*keys, "range").orderBy(value)), F.lit(0))
        steps = steps.withColumn("inside", inside).join(ranges, [*keys, "range"]).select(*keys, value, (F.col("before") + F.col("inside")).alias("n_below"), "n_panel")
    steps = steps.select(*keys, value, "n_below", "n_panel")
    return scores.join(steps, [*keys, value]).withColumn("percentile", F.round(F.when(F.col("n_panel") > 0, 100.0 * F.col("n_below") / F.col("n_panel")), 4))


def panel_z(scores: DataFrame, keys: list[str], value: str = "score_sum", places: int = 6) -> DataFrame:
    """Standard scores by the panel's mean and standard deviation in each group."""
    v = F.when(is_reference(), F.col(value).cast("double"))
    m = scores.groupBy(*keys).agg(F.avg(v).alias("mean"), F.stddev_samp(v).alias("sd"))
    z = F.when(F.col("sd") > 0, (F.col(value) - F.col("mean")) / F.col("sd"))
    return scores.join(m, keys).withColumn("z", F.round(z, places)).drop("mean", "sd")


def adjusted(scores: DataFrame, keys: list[str], covariate: str, value: str = "score_sum") -> DataFrame:
    """Scores less what a panel regression on a covariate predicts, over the residuals' deviation (z_mean), and over the deviation that a second regression, of squared residuals, predicts (z_var)."""
    y, x = (F.when(is_reference(), F.col(c).cast("double")) for c in (value, covariate))
    fit = lambda df, y, x, tag: df.groupBy(*keys).agg(F.regr_slope(y, x).alias(f"slope{tag}"), F.regr_intercept(y, x).alias(f"cut{tag}"))
    res = scores.join(fit(scores, y, x, "1"), keys).withColumn("residual", F.col(value) - F.col("cut1") - F.col("slope1") * F.col(covariate))
    own = F.when(is_reference(), F.col("residual"))
    spread = res.groupBy(*keys).agg(F.stddev_samp(own).alias("sd"))
    var = fit(res, F.when(is_reference(), F.col("residual") * F.col("residual")), x, "2")
    out = res.join(spread, keys).join(var, keys)
    fitted = F.col("cut2") + F.col("slope2") * F.col(covariate)
    return out.withColumns({"z_mean": F.round(F.when(F.col("sd") > 0, F.col("residual") / F.col("sd")), 4) + 0.0, "z_var": F.round(F.when(fitted > 0, F.col("residual") / F.sqrt(fitted)), 4) + 0.0}).drop("slope1", "cut1", "slope2", "cut2", "sd", "residual")


def regressed(rows: DataFrame, keys: list[str], y: str, covariates: list[str]) -> DataFrame:
    """By group, the least-squares fit of y on several covariates over the panel's rows without nulls: keys, cut, slopes (an array in the order of covariates). Means and covariances come from one aggregate, and the equations of a group, as many as covariates, are solved a row at a time; where covariates depend on each other the shortest solution counts."""
    kept = rows.where(is_reference() & F.expr(" AND ".join(f"`{c}` IS NOT NULL" for c in [y, *covariates])))
    x = [F.col(c).cast("double") for c in covariates]
    pairs = [(i, j) for i in range(len(x)) for j in range(i, len(x))]
    moments = kept.groupBy(*keys).agg(
        F.avg(F.col(y).cast("double")).alias("mean_y"), F.array(*map(F.avg, x)).alias("mean_x"), F.array(*(F.covar_pop(a, F.col(y).cast("double")) for a in x)).alias("with_y"),
        F.array(*(F.covar_pop(x[i], x[j]) for i, j in pairs)).alias("with_x"),
    )

    def solved(batches):
        for batch in batches:
            cuts, slopes = [], []
            for m, mx, cy, cx in zip(*(batch.column(c).to_pylist() for c in ("mean_y", "mean_x", "with_y", "with_x"))):
                c = np.zeros((len(mx), len(mx)))
                for (i, j), v in zip(pairs, cx):
                    c[i, j] = c[j, i] = v
                scale = np.sqrt(np.maximum(np.diag(c), 0))
                scale[scale == 0] = 1
                b = np.linalg.lstsq(c / scale / scale[:, None], np.array(cy) / scale, rcond=1e-10)[0] / scale
                cuts.append(float(m - b @ np.array(mx)))
                slopes.append(b.tolist())
            yield pa.record_batch([*(batch.column(k) for k in keys), pa.array(cuts, pa.float64()), pa.array(slopes, pa.list_(pa.float64()))], [*keys, "cut", "slopes"])

    kinds = dict(rows.dtypes)
    return moments.mapInArrow(solved, ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), "cut double", "slopes array<double>"]))


def adjusted_by(scores: DataFrame, keys: list[str], covariates: list[str], value: str = "score_sum") -> DataFrame:
    """As adjusted(), on several covariates: z_mean and z_var. Groups without panel rows, and rows without a covariate, get nulls."""
    fitted = lambda tag: F.col(f"cut{tag}") + sum((F.col(f"slopes{tag}")[i] * F.col(c) for i, c in enumerate(covariates)), F.lit(0.0))
    named = lambda fit, tag: fit.withColumnsRenamed({"cut": f"cut{tag}", "slopes": f"slopes{tag}"})
    res = scores.join(named(regressed(scores, keys, value, covariates), "1"), keys, "left").withColumn("residual", F.col(value) - fitted("1")).withColumn("square", F.col("residual") * F.col("residual"))
    spread = res.groupBy(*keys).agg(F.stddev_samp(F.when(is_reference(), F.col("residual"))).alias("sd"))
    out = res.join(spread, keys, "left").join(named(regressed(res, keys, "square", covariates), "2"), keys, "left")
    z = {"z_mean": F.when(F.col("sd") > 0, F.col("residual") / F.col("sd")), "z_var": F.when(fitted("2") > 0, F.col("residual") / F.sqrt(fitted("2")))}
    return out.withColumns({k: F.round(v, 4) + 0.0 for k, v in z.items()}).drop("slopes1", "cut1", "slopes2", "cut2", "sd", "residual", "square")


def uniformity(percentiles: DataFrame, keys: list[str]) -> DataFrame:
    """Whether percentiles fill the ten deciles alike: n, mean, largest deviation of a decile's share from 0.1, verdict."""
    decile = F.least(F.lit(9), F.greatest(F.lit(0), F.floor(F.col("percentile") / 10))).cast("int")
    known = percentiles.where("percentile is not null")
    per = known.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg("percentile").alias("mean"), *(F.count_if(decile == k).alias(f"d{k}") for k in range(10)))
    worst = F.greatest(*(F.abs(F.col(f"d{k}") / F.col("n") - 0.1) for k in range(10)))
    out = per.select(*keys, "n", F.round("mean", 4).alias("mean_pct"), F.round(worst, 6).alias("max_dev"))
    return out.withColumn("uniform", (F.col("n") >= LEAST_PANEL) & (F.col("max_dev") <= 0.06) & F.col("mean_pct").between(45, 55))
