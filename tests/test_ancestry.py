"""Components by loadings, projection, relatedness, pruning, and regression on several components: against numpy and serial references."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.operators import ancestry, calibrate, kinship, pruning
from strandline.operators.graphs import independent


def table(spark, x, called=None, first=0):
    rows = [(first + i, v, int(x[i, v]) if called is None or called[i, v] else None) for i in range(x.shape[0]) for v in range(x.shape[1])]
    return spark.createDataFrame(rows, "iid long, vid long, dosage int").repartition(5)


def population(rng, n, m, split):
    """Dosages of two populations."""
    p = rng.uniform(0.1, 0.9, (2, m))
    return rng.binomial(2, np.where(np.arange(n)[:, None] < split, p[0], p[1]))


def standardised(x, called, panel):
    y = np.where(called, x, np.nan)
    mean, sd = np.nanmean(y[:panel], 0), np.nanstd(y[:panel], 0)
    some = sd > 1e-9
    return np.where(called, (x - mean) / np.where(some, sd, 1), 0)[:, some]


@pytest.mark.parametrize("n, k", [(16, 3), (60, 4)])
def test_components_equal_the_decomposition(spark, n, k):
    rng = np.random.default_rng(3)
    x = population(rng, n + 4, 700, n // 2)
    called = rng.random(x.shape) > 0.05
    g = table(spark, x, called)
    panel = spark.createDataFrame([(i,) for i in range(n)], "iid long")
    fitted = ancestry.loadings(g.where(F.col("iid") < n), panel, k)
    z = standardised(x, called, n)
    u, s, vt = np.linalg.svd(z[:n], full_matrices=False)
    close = 1e-6 if n == 16 else 0.02 * s[0]  # more individuals than columns: the range finder's error
    assert fitted.singular[:k] == pytest.approx(s[:k], rel=1e-6 if n == 16 else 0.02)
    sign = np.sign((fitted.coordinates[:, :1] * (u * s)[:, :1]).sum(0))
    assert fitted.coordinates[:, 0] * sign == pytest.approx((u * s)[:, 0], abs=close)
    got = {r["iid"]: np.array(r["pc"]) for r in ancestry.projected(g, fitted, k, augment=False).collect()}
    for i in (0, n - 1, n, n + 3):
        assert abs(got[i][0]) == pytest.approx(abs(z[i] @ vt[0]), abs=close)
        if n == 16:
            assert np.abs(got[i]) == pytest.approx(np.abs(z[i] @ vt[:k].T), abs=1e-6)
    assert {r["iid"] for r in ancestry.panel_components(spark, fitted, k).collect()} == set(range(n))


def test_augmented_projection_undoes_shrinkage(spark):
    rng = np.random.default_rng(5)
    x = population(rng, 44, 1500, 20)
    x[40:] = population(np.random.default_rng(5), 44, 1500, 44)[40:]  # the first population's frequencies
    panel = spark.createDataFrame([(i,) for i in range(40)], "iid long")
    g = table(spark, x)
    fitted = ancestry.loadings(g.where("iid < 40"), panel, 2)
    own = fitted.coordinates[:20, 0].mean()
    plain, full = ({r["iid"]: r["pc"][0] for r in ancestry.projected(g.where("iid >= 40"), fitted, 2, augment=a).collect()} for a in (False, True))
    assert abs(np.mean(list(full.values())) - own) < 0.6 * abs(np.mean(list(plain.values())) - own)


def test_a_million_samples_meet_loadings_in_a_join(spark, capsys):
    rng = np.random.default_rng(6)
    panel = spark.createDataFrame([(i,) for i in range(10)], "iid long")
    g = table(spark, population(rng, 10, 50, 5))
    ancestry.projected(spark.range(5).select(F.col("id").alias("iid"), F.lit(1).cast("long").alias("vid"), F.lit(1).alias("dosage")), ancestry.loadings(g, panel, 2), 2).explain()
    plan = capsys.readouterr().out
    assert "Join" in plan and "HashAggregate" in plan and "CartesianProduct" not in plan
    none = ancestry.projected(g.where("1 = 0"), ancestry.loadings(g.where("1 = 0"), panel, 2), 2)
    assert none.count() == 0


def test_targets_are_oriented_to_the_panel(spark):
    g = spark.createDataFrame([(1, 10, 2), (1, 11, 2), (1, 12, 1), (1, 13, None)], "iid long, vid long, dosage int")
    pairs = spark.createDataFrame([(10, 100, True), (11, 101, False), (13, 103, False)], "id_target long, id_ref long, same_ref boolean")
    assert sorted((r["vid"], r["dosage"]) for r in ancestry.oriented(g, pairs).collect()) == [(100, 2), (101, 0), (103, None)]


# --- relatedness


def plain_kinship(x):
    out = {}
    for i in range(len(x)):
        for j in range(i + 1, len(x)):
            ok = (x[i] >= 0) & (x[j] >= 0)
            a, b = x[i][ok], x[j][ok]
            one, two = (a == 1).sum(), (b == 1).sum()
            if min(one, two):
                out[i, j] = ((a == 1) & (b == 1)).sum() / (2 * min(one, two)) - (np.abs(a - b) == 2).sum() / min(one, two) + 0.5 - (one + two) / (4 * min(one, two))
    return out


@pytest.mark.parametrize("group, at_once", [(256, 1024), (5, 7)])
def test_planted_relatives_are_found_and_leave(spark, monkeypatch, group, at_once):
    monkeypatch.setattr(kinship, "AT_ONCE", at_once)
    rng = np.random.default_rng(8)
    p = rng.uniform(0.2, 0.8, 900)
    haplotypes = rng.random((24, 2, 900)) < p
    child = lambda a, b: np.stack([np.where(rng.random(900) < 0.5, *a), np.where(rng.random(900) < 0.5, *b)])
    haplotypes[20], haplotypes[21], haplotypes[22] = child(haplotypes[0], haplotypes[1]), child(haplotypes[0], haplotypes[1]), haplotypes[5]
    x = haplotypes.sum(1).astype(int)
    x[rng.random(x.shape) < 0.03] = -1
    g = table(spark, x, x >= 0)
    want = {k: v for k, v in plain_kinship(x).items() if v >= kinship.LEAST_KINSHIP}
    related = kinship.kinship(g, group=group).cache()
    got = {(r["a"], r["b"]): r["kinship"] for r in related.collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-6) for k in want)
    assert {(0, 20), (1, 20), (0, 21), (1, 21), (20, 21), (5, 22)} <= got.keys()
    stay = {r["iid"] for r in kinship.unrelated(g.select("iid"), related).collect()}
    relatives = [sum(i in k for k in got) for i in range(24)]
    serial = set()
    for i in sorted(range(24), key=lambda i: (relatives[i], i)):
        if not any((min(i, j), max(i, j)) in got for j in serial):
            serial.add(i)
    assert stay == serial and not {20, 21, 22} & stay and {0, 1, 5} <= stay


def test_independent_sets_equal_the_ordered_pass(spark):
    rng = np.random.default_rng(9)
    for n, m in ((40, 0), (40, 60), (40, 400), (120, 119)):
        rank = rng.integers(0, 10, n)
        edges = {(int(a), int(b)) for a, b in rng.integers(0, n, (m, 2))} if m != 119 else {(i, i + 1) for i in range(119)}
        stay = set()
        for i in sorted(range(n), key=lambda i: (rank[i], i)):
            if not any((i == a and b in stay) or (i == b and a in stay) for a, b in edges if a != b):
                stay.add(i)
        nodes = spark.createDataFrame([(i, int(rank[i])) for i in range(n)], "v long, r long")
        conflicts = spark.createDataFrame([*edges, (1, 999), (2, 2)], "a long, b long")
        assert {r["v"] for r in independent(nodes, conflicts, "v", "r").collect()} == stay


# --- pruning


@pytest.mark.parametrize("window, step", [(10, 1), (12, 5), (40, 7)])
def test_pruning_equals_a_serial_reference(spark, window, step):
    rng = np.random.default_rng(4)
    x = rng.integers(0, 3, (60, 90))
    for a, b in ((11, 8), (10, 9), (25, 18), (32, 20), (61, 50), (62, 61), (70, 89)):
        x[:, a] = np.where(rng.random(60) < 0.9, x[:, b], x[:, a])
    x[:, 40] = 1
    chrom = ["chr1"] * 50 + ["chr2"] * 40
    ord_ = [*range(50), *range(40)]
    variants = spark.createDataFrame([(v, chrom[v], ord_[v]) for v in range(90)], "vid long, chrom string, ord int")
    got = {r["vid"] for r in pruning.pruned(table(spark, x), variants, window, step, 0.05).collect()}
    with np.errstate(invalid="ignore"):
        r2 = np.corrcoef(x.T) ** 2
    freq = x.mean(0) / 2
    met = lambda a, b: chrom[a] == chrom[b] and ord_[max(a, b)] < ord_[min(a, b)] // step * step + window
    want = set()
    for v in sorted(set(range(90)) - {40}, key=lambda v: (-min(freq[v], 1 - freq[v]), chrom[v], ord_[v])):
        if not any(met(u, v) and r2[u, v] > 0.05 for u in want):
            want.add(v)
    assert got == want and 40 not in got


def test_places_and_regions(spark):
    variants = spark.createDataFrame([(v, f"chr{v % 2}", (v * 7919) % 1000 * 13) for v in range(300)], "vid long, chrom string, pos long")
    got = {r["vid"]: (r["chrom"], r["pos"], r["ord"]) for r in pruning.places(variants, 500).collect()}
    for c in ("chr0", "chr1"):
        own = sorted((p, v, o) for v, (x, p, o) in got.items() if x == c)
        assert [o for _, _, o in own] == list(range(150))
    regions = spark.createDataFrame([("chr0", 0, 2000), ("chr0", 1500, 3000), ("chr1", 5, 5)], "chrom string, start long, end long")
    left = {r["vid"] for r in pruning.outside(variants, regions).collect()}
    assert left == {v for v, (c, p, _) in got.items() if c != "chr0" or p > 3000}


# --- regression on components


def test_four_components(spark):
    rng = np.random.default_rng(11)
    rows = []
    for s in range(3):
        for i in range(200):
            x = rng.normal(size=4) * (1, 50, 0.01, 3) + (0, 1000, 5, 0)
            x[3] = 2 * x[0] if s == 2 else x[3]  # dependent covariates
            rows.append((i, f"s{s}", "reference" if i < 150 else "target", float(5 * x[0] + 0.1 * x[1] + rng.normal() * (1 + abs(x[0]))), *map(float, x)))
    rows += [(900, "none", "target", 1.0, 0.0, 0.0, 0.0, 0.0), (901, "s0", "target", 1.0, None, 0.0, 0.0, 0.0)]
    scores = spark.createDataFrame(rows, "iid long, acc string, sampleset string, score_sum double, a double, b double, c double, d double")
    got = {(r["acc"], r["iid"]): (r["z_mean"], r["z_var"]) for r in calibrate.adjusted_by(scores, ["acc"], ["a", "b", "c", "d"]).collect()}
    assert got["none", 900] == (None, None) and got["s0", 901] == (None, None)
    for s in ("s0", "s1", "s2"):
        own = [r for r in rows if r[1] == s and r[4] is not None]
        x, y, ref = np.array([[1, *r[4:]] for r in own]), np.array([r[3] for r in own]), np.array([r[2] == "reference" for r in own])
        res = y - (x / np.abs(x).max(0)) @ np.linalg.lstsq(x[ref] / np.abs(x).max(0), y[ref], rcond=1e-9)[0]
        var = (x / np.abs(x).max(0)) @ np.linalg.lstsq(x[ref] / np.abs(x).max(0), res[ref] ** 2, rcond=1e-9)[0]
        for r, e, v in zip(own, res, var):
            assert got[s, r[0]][0] == pytest.approx(e / res[ref].std(ddof=1), abs=2e-4)
            assert (got[s, r[0]][1] is None) == (v <= 0) and (v <= 0.01 or got[s, r[0]][1] == pytest.approx(e / np.sqrt(v), rel=1e-3, abs=2e-4))


def test_pruning_in_blocks_equals_one_block(spark):
    """Decisions that hang on variants of other blocks, in several rounds."""
    rng = np.random.default_rng(8)
    x = np.cumsum(rng.integers(-1, 2, (40, 300)), 1) % 3
    variants = spark.createDataFrame([(v, "chr1", v) for v in range(300)], "vid long, chrom string, ord int")
    by = [sorted(r["vid"] for r in pruning.pruned(table(spark, x), variants, 12, 5, 0.05, block=b).collect()) for b in (12, 30, 1000)]
    assert by[0] == by[1] == by[2] and 0 < len(by[0]) < 300


def test_kinship_adds_slices_of_variants(spark, monkeypatch):
    """Few individuals and many variants: several tasks share a pair of groups, and give what one gives."""
    rng = np.random.default_rng(2)
    x = rng.integers(0, 3, (14, 200))
    x[3] = np.where(rng.random(200) < 0.8, x[9], x[3])
    called = rng.random((14, 200)) < 0.9
    by = []
    for size in (10, 10**9):
        monkeypatch.setattr(kinship, "SLICE", size, raising=True)
        by.append(sorted((r["a"], r["b"], round(r["kinship"], 9), r["n"]) for r in kinship.kinship(table(spark, x, called), group=8).collect()))
    assert by[0] == by[1] and (3, 9) in {r[:2] for r in by[0]}
