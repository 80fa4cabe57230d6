"""Queries over streams, components, relatedness, forests and pruning."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline.operators import ancestry, kinship, pruning
from strandline.operators import calibrate as C
from strandline.operators import genotypes as G
from strandline.operators import panel as P
from strandline.plans import grading  # noqa: F401  (its views)
from strandline.plans.catalogue import intersect
from strandline.plans.registry import query
from strandline.plans.scoring import _GC, scored
from strandline.plans.views import VIEWS
from strandline.sources import shared
from strandline.streaming import events as E


def _folder(v, name):
    return shared.new_path(v.spark, name)


@query("x01_events_window", "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n, CAST(sum(CAST(round(value * 100) AS bigint)) AS bigint) AS cents FROM {events} GROUP BY 1, 2")
def x01(v):
    return E.drained(E.tumbling(E.stream_of(v.spark, v.sf_dir, "events")), _folder(v, "x01"))


@query("x02_events_session", """SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n FROM (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM {events})) GROUP BY user_id, s""")
def x02(v):
    return E.drained(E.sessions(E.stream_of(v.spark, v.sf_dir, "events")), _folder(v, "x02"))


def _cohort(v):
    """Genotypes of all, written once: each use would join and shuffle all lines again."""
    return v.once("cohort", lambda: v.cohort)


def _panel(v):
    """Genotypes of the reference individuals."""
    return v.once("panel", lambda: _cohort(v).join(v.people.where("sampleset = 'reference'").select("iid"), "iid", "left_semi"))


def _placed(v, genotypes):
    frequent = G.frequencies(genotypes).where("maf >= 0.05").select("vid")
    return pruning.places(v.variant.join(frequent, "vid", "left_semi").select("vid", "chrom", "pos"))


def _components(v, k):
    """Loadings of the pruned panel; its own components, and those of targets whose alleles stand as their own files have them."""
    panel = _panel(v)
    pairs = v.once("pca-pairs", lambda: P.thinned(intersect(v), pruning.pruned(panel, _placed(v, panel))))
    fitted = ancestry.loadings(panel.join(pairs.select(F.col("id_ref").alias("vid")), "vid", "left_semi"), v.people.where("sampleset = 'reference'"), k)
    turned = _cohort(v).withColumn("dosage", F.when(F.col("vid") % 3 == 0, 2 - F.col("dosage")).otherwise(F.col("dosage")))  # as the target's table has its alleles
    targets = turned.join(v.people.where("sampleset = 'target'").select("iid"), "iid", "left_semi")
    return ancestry.panel_components(v.spark, fitted, k).unionByName(ancestry.projected(ancestry.oriented(targets, pairs), fitted, k))


@query("m01_pca_project")
def m01(v):
    return _components(v, 10).select("iid", *(F.round(F.abs(F.col("pc")[k]), 4).alias(f"pc{k + 1}") for k in range(10)))


@query("m02_population_forest")
def m02(v):
    """The forest learns from unrelated people of the panel."""
    known = v.people.where("sampleset = 'reference'").select(F.col("iid").cast("bigint").alias("iid"), "pop")
    related = kinship.kinship(_panel(v)).where(F.col("n") >= LEAST_SHARED)
    return ancestry.populations(_components(v, 5), known.join(kinship.unrelated(known, related), "iid", "left_semi"))


@query("m03_ld_prune")
def m03(v):
    return pruning.pruned(v.g25, _placed(v, v.g25))


#: Variants called in both below which a pair's kinship tells nothing.
LEAST_SHARED = 40
_SHARED = "SELECT a.iid AS a, b.iid AS b, count_if(a.dosage = 1 AND b.dosage = 1) AS shared, count_if(abs(a.dosage - b.dosage) = 2) AS opposite, count_if(a.dosage = 1) AS one, count_if(b.dosage = 1) AS two, count(*) AS n FROM {cohort} a JOIN {cohort} b ON a.vid = b.vid AND a.iid < b.iid GROUP BY 1, 2"


@query("q86_kinship", f"SELECT a, b, round(shared / (2.0 * least(one, two)) - opposite / (1.0 * least(one, two)) + 0.5 - (one + two) / (4.0 * least(one, two)), 6) AS kinship, n FROM ({_SHARED}) WHERE least(one, two) > 0 AND shared / (2.0 * least(one, two)) - opposite / (1.0 * least(one, two)) + 0.5 - (one + two) / (4.0 * least(one, two)) >= 0.0442")
def q86(v):
    return kinship.kinship(v.cohort).select("a", "b", F.round("kinship", 6).alias("kinship"), "n")


VIEWS["sample4"] = "SELECT s.*, (iid * 37) % 101 AS pc2, (iid * iid) % 89 AS pc3, length(pop) * 1000 + iid % 7 AS pc4 FROM {sample} s"
_PCS = ("pc1", "pc2", "pc3", "pc4")


def _orthogonal():
    """SQL of the residuals of two regressions on four covariates, each made independent of those before it: what a joint fit gives."""
    on = lambda c, x: f"{c} - regr_intercept(CASE WHEN ref THEN {c} END, CASE WHEN ref THEN {x} END) OVER w - {x} * regr_slope(CASE WHEN ref THEN {c} END, CASE WHEN ref THEN {x} END) OVER w AS {c}"
    w = "WINDOW w AS (PARTITION BY accession)"
    steps = [f"s0 AS (SELECT iid, accession, sampleset = 'reference' AS ref, CAST(score_sum AS double) AS y, {', '.join(f'CAST({c} AS double) AS {c}' for c in _PCS)} FROM ({_GC.replace('{sample}', '{sample4}').replace('pc1', 'pc1, pc2, pc3, pc4')}))"]
    for k, x in enumerate(_PCS):  # y and later covariates lose x; x stays as it is now, for the second fit
        steps.append(f"s{k + 1} AS (SELECT iid, accession, ref, {', '.join([*_PCS[: k + 1], on('y', x), *(on(c, x) for c in _PCS[k + 1 :])])} FROM s{k} {w})")
    steps.append(f"r0 AS (SELECT *, y * y AS v, y * y AS rest, stddev_samp(CASE WHEN ref THEN y END) OVER w AS sd FROM s4 {w})")
    for k, x in enumerate(_PCS):
        steps.append(f"r{k + 1} AS (SELECT iid, accession, ref, y, sd, v, {', '.join(_PCS)}, {on('rest', x)} FROM r{k} {w})")
    return f"WITH {', '.join(steps)} SELECT iid, accession, round(CASE WHEN sd > 0 THEN y / sd END, 4) + 0e0 AS z_mean, round(CASE WHEN v - rest > 0 THEN y / sqrt(v - rest) END, 4) + 0e0 AS z_var FROM r4"


@query("q26b_four_components", _orthogonal())
def q26b(v):
    scores = scored(v).drop("pop", "sampleset", "pc1").join(v.sample4, "iid")
    return C.adjusted_by(scores, ["accession"], list(_PCS)).select("iid", "accession", "z_mean", "z_var")
