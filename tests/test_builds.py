"""Panel quality, repaired streams, ranks by ranges, digests, staged builds, nested documents and logs, on known cases."""

import json
import math
from fractions import Fraction

import pandas as pd
import pytest
from pyspark.sql import functions as F

from strandline.operators import calibrate, digests, genotypes, nested, panel_qc
from strandline.sources.stages import Build
from strandline.streaming import repair
from strandline.streaming.timings import Timings


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


# --- the exact test


def plain_p(hom, het, other):
    """By whole numbers: ways to deal the rare and common alleles with h heterozygotes."""
    n, rare = hom + het + other, 2 * min(hom, other) + het
    ways = {h: Fraction(math.factorial(n) * 2**h, math.factorial((rare - h) // 2) * math.factorial(h) * math.factorial(n - h - (rare - h) // 2)) for h in range(rare % 2, rare + 1, 2)}
    return float(sum(w for w in ways.values() if w <= ways[het]) / sum(ways.values()))


@pytest.mark.parametrize("counts", [(0, 0, 0), (10, 0, 0), (5, 10, 5), (0, 21, 79), (1, 20, 79), (57, 14, 50), (3, 0, 40), (0, 1, 9), (12, 40, 48), (50, 0, 50), (200, 33, 17)])
def test_exact_p(counts):
    assert panel_qc.exact_p(*counts) == pytest.approx(plain_p(*counts) if sum(counts) else 1.0, abs=1e-9)


def test_known_p_values(spark):
    counts = spark.createDataFrame([("a", 57, 14, 50), ("b", 5, 10, 5), ("a2", 57, 14, 50), ("c", 79, 21, 0)], "vid string, n0 long, n1 long, n2 long")
    got = {r["vid"]: r["hwe_p"] for r in panel_qc.hardy_weinberg(counts).collect()}
    assert got["a"] == got["a2"] < 1e-15 and got["b"] == 1.0 and got["c"] == pytest.approx(0.593645, abs=1e-5)


def test_people_go_before_variants(spark):
    variants = spark.createDataFrame([(1, "chr1", 10, "A", "G"), (2, "chr1", 20, "A", "G"), (3, "chr1", 30, "A", "GT"), (4, "chr1", 40, "A", "C"), (5, "chr1", 40, "C", "A"), (6, "chrX", 50, "A", "G"), (7, "chr2", 60, "A", "T")], "vid long, chrom string, pos long, a1 string, a2 string")
    g = [(i, v, (i + v) % 3 if not (i >= 9 and v == 1) else None) for i in range(11) for v in (1, 2, 3, 4, 5, 6, 7)]
    g = [(i, v, None if i >= 9 and v == 2 else d) for i, v, d in g]  # the last two people lack two of three variants, each of which lacks two of eleven people
    df = spark.createDataFrame(g, "iid long, vid long, dosage int")
    assert rows(panel_qc.single_base(variants), "vid") == [(1,), (2,), (7,)]
    assert rows(panel_qc.called_people(df.where("vid in (1, 2, 7)")), "iid") == [(i,) for i in range(9)]
    assert rows(panel_qc.panel_quality(df, variants), "vid", "n_people") == [(1, 9), (2, 9), (7, 9)]
    assert rows(panel_qc.panel_quality(df, variants, people_missing=1.0), "vid") == [(7,)]


# --- streams


def test_fates_equal_the_batch(spark):
    data = [(1, 1, 10, "A", ".", "0/0", 3), (1, 1, 10, "A", "G", "0/1", 4), (1, 1, 10, "A", "G", "1/1", 2), (1, 1, 20, "C", ".", "0/0", 5), (2, 1, 10, "A", ".", "0/0", 6), (2, 1, 10, "A", ".", "0/0", 7)]
    names = ["iid", "chrom", "pos", "ref", "alt", "gt", "ord"]
    df = spark.createDataFrame(data, "iid long, chrom long, pos long, ref string, alt string, gt string, ord long")
    want = rows(genotypes.repaired(df), "iid", "ord", "multi", "fate")
    got = []
    for key, own in pd.DataFrame(data, columns=names).groupby(["iid", "chrom", "pos"]):
        got += [(key[0], r.ord, r.multi, r.fate) for r in repair.fates(own).itertuples()]
    assert sorted(got, key=str) == want


def test_state_of_places_goes(spark, tmp_path):
    schema = "iid long, chrom long, pos long, ref string, alt string, gt string, ord long, at timestamp"
    at = lambda chrom, pos: pd.Timestamp(chrom * 300_000_000 + pos, unit="ms").to_pydatetime()
    parts = [[(1, 1, 10 * k + j, "A", a, "0/1", 100 * k + 10 * j + n, at(1, 10 * k + j)) for j in range(5) for n, a in enumerate((".", "G", "G")[: 1 + (j % 3)])] for k in range(4)]
    for k, part in enumerate([*parts, [(0, repair.MARK, 0, "", "", "", 0, at(30, 0))]]):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    q = repair.repaired_stream(stream).writeStream.outputMode("append").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).foreachBatch(lambda df, _: df.write.mode("append").parquet(f"{tmp_path}/out")).start()
    q.awaitTermination()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in (json.loads(x.json) if not isinstance(x, dict) else x for x in q.recentProgress) if p["stateOperators"]]
    assert max(held) <= 10 and held[-1] == 0  # the places of two batches at most, and none in the end
    want = genotypes.repaired(spark.createDataFrame(sum(parts, []), schema))
    assert rows(spark.read.parquet(f"{tmp_path}/out"), "iid", "pos", "ord", "multi", "fate") == rows(want, "iid", "pos", "ord", "multi", "fate")


# --- ranks


def test_ranks_by_ranges_are_the_same(spark):
    data = [(i, f"s{i % 3}", "reference" if i % 5 else "target", (i * 7919) % 400 if i % 2 else 17) for i in range(3000)]
    scores = spark.createDataFrame(data, "iid long, acc string, sampleset string, score_sum long")
    one, many = (rows(calibrate.panel_ranks(scores, ["acc"], spread=k), "iid", "n_below", "n_panel", "percentile") for k in (1, 7))
    assert one == many and len(one) == 3000
    for i, below, n, p in one[:200]:
        own = [x for _, a, s, x in data if a == data[i][1] and s == "reference"]
        assert (below, n) == (sum(x < data[i][3] for x in own), len(own))


# --- digests


def test_digests_do_not_go_by_order(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("a", 2, "null"), ("b", 12, "3"), ("b", 1, "23")], "k string, n long, t string")
    base = rows(digests.multiset_digest(df, ["k"], ["n", "t"]), "k", "n", "digest")
    assert base == rows(digests.multiset_digest(df.orderBy(F.desc("n")).repartition(3), ["k"], ["n", "t"]), "k", "n", "digest")
    assert rows(digests.unlike(df, df.where("n <> 12"), ["k"], ["n", "t"]), "k", "n_one", "n_other") == [("b", 2, 1)]
    assert rows(digests.unlike(df, df.union(df.where("n = 1")), ["k"], ["n", "t"]), "k", "n_one", "n_other") == [("a", 3, 4), ("b", 2, 3)]
    assert rows(digests.unlike(df, df.withColumn("t", F.coalesce("t", F.lit("null"))), ["k"], ["n", "t"]), "k") == [("a",)]
    assert digests.multiset_digest(df.where("1 = 0"), [], ["n"]).first()["n"] == 0


def test_lost_and_doubled_variants_are_told(spark):
    used = spark.createDataFrame([("a", v) for v in range(6)] + [("b", 1)], "accession string, vid long")
    parts = spark.createDataFrame([("a", 0, 0), ("a", 0, 1), ("a", 1, 1), ("a", 1, 2), ("a", 2, 3), ("a", 2, 4), ("a", 2, 99), ("b", 0, 1)], "accession string, split int, vid long")
    merged = spark.createDataFrame([("a", 7), ("b", 2)], "accession string, n_variants long")
    assert rows(digests.verified(parts, merged, used), "fault", "accession", "n") == [("counted otherwise", "b", 1), ("doubled", "a", 1), ("foreign", "a", 1), ("lost", "a", 1)]


# --- staged builds


def test_an_interrupted_build_goes_on(spark, tmp_path):
    folder, calls = f"file://{tmp_path}/build", []
    data = spark.createDataFrame([(i, i % 3) for i in range(20)], "a long, b long")

    def run(source, fail=False, version="1"):
        build = Build(spark, folder)
        one = build.stage("one", lambda: (calls.append("one"), source.where("a > 2"))[1], {"source": source})

        def second():
            calls.append("two")
            if fail:
                raise KeyboardInterrupt
            return one.groupBy("b").count()

        two = build.stage("two", second, after=["one"], version=version)
        other = build.stage("other", lambda: (calls.append("other"), spark.range(3))[1])
        return build, two, other

    with pytest.raises(KeyboardInterrupt):
        run(data, fail=True)
    (tmp_path / "build" / "_aside-lost").mkdir()
    build, two, _ = run(data)
    assert calls == ["one", "two", "two", "other"] and build.kept == ["one"] and two.count() == 3
    assert build.swept() == 1 and build.swept() == 0
    build, _, _ = run(data.orderBy(F.desc("a")))  # the same rows
    assert build.kept == ["one", "two", "other"]
    build, two, _ = run(data.withColumn("b", F.when(F.col("a") == 7, 9).otherwise(F.col("b"))))  # a changed row: what depends on it is made again
    assert build.made == ["one", "two"] and build.kept == ["other"] and two.count() == 4
    build, _, _ = run(data.withColumn("b", F.when(F.col("a") == 7, 9).otherwise(F.col("b"))), version="2")
    assert build.made == ["two"]
    assert len([p for p in (tmp_path / "build").iterdir() if not p.name.startswith(".")]) == 4  # three stages and a manifest


# --- nested documents


def test_leaves_that_differ(spark):
    one = {"a": 1.0, "b": [1, {"c": "x"}], "n": None, "t": True, "empty": {}, "k y": "v", "gone": [[]]}
    other = {"a": 1.0 + 1e-12, "b": [2, {"c": "x", "d": 1}], "n": "null", "t": False, "empty": {}, "k y": "v"}
    docs = lambda d: spark.createDataFrame([(1, json.dumps(d)), (2, json.dumps(one))], "id long, doc string")
    leaves = nested.leaves(docs(one), "id", "doc")
    assert {r["path"]: (r["kind"], r["value"]) for r in leaves.where("key = 1").collect()} == {
        "$.a": ("number", "1"), "$.b[0]": ("number", "1"), "$.b[1].c": ("string", "x"), "$.n": ("null", None), "$.t": ("boolean", "true"), "$.empty": ("object", None), '$."k y"': ("string", "v"), "$.gone[0]": ("array", None),
    }
    got = nested.compared(leaves, nested.leaves(docs(other), "id", "doc"), 1e-9)
    assert rows(got, "key", "path", "difference") == sorted([(1, "$.a", "close"), (1, "$.b[0]", "changed"), (1, "$.b[1].d", "added"), (1, "$.n", "retyped"), (1, "$.t", "changed"), (1, "$.gone[0]", "lost")], key=str)
    assert nested.compared(leaves, leaves).count() == 0
    deep = "[" * 9 + "7" + "]" * 9
    assert rows(nested.leaves(spark.createDataFrame([(1, deep)], "id long, doc string"), "id", "doc"), "path", "value") == [("$" + "[0]" * 9, "7")]
    with pytest.raises(ValueError):
        nested.leaves(spark.createDataFrame([(1, deep)], "id long, doc string"), "id", "doc", most_rounds=4)


def test_differences_are_those_of_all_leaves_without_their_tables(spark, monkeypatch):
    """Values of every kind beside each other, at the top too; equal parts are not written."""
    odd = ["{}", "[]", " { } ", " [ ] ", "null", "7", '"x"', "true", "{bad", None, '{"a": 1}', '[1, {"b": []}]', '{"a": {"b": 1.0, "k y": [{}]}}', '{"a": "1", "[0]": 2}', '{"a": {"b": 1.000000000001}}', "1e2", "[[], null]"]
    pairs = [(100 * i + j, x, y) for i, x in enumerate(odd) for j, y in enumerate(odd)]
    big = json.dumps({"same": [{"n": i} for i in range(500)], "one": 1})
    one, other = [(k, x) for k, x, _ in pairs if k % 7] + [(9000, big), (None, "1")], [(k, y) for k, _, y in pairs if k % 5] + [(9000, big.replace('"one": 1', '"one": 2')), (None, "2")]
    a, b = (spark.createDataFrame(t, "id long, doc string") for t in (one, other))
    want = [tuple(r) for r in nested.compared(nested.leaves(a, "id", "doc"), nested.leaves(b, "id", "doc")).collect()]
    written, kept = [], nested.shared.kept
    monkeypatch.setattr(nested.shared, "kept", lambda df, name: written.append(kept(df, name)) or written[-1])
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in nested.differences(a, b, "id", "doc").collect())
    assert sum(t.where("key = 9000").count() for t in written) == 1


# --- logs


def test_a_log_has_the_rows_of_a_run(spark):
    t = Timings(spark)
    with t.step("grouped"):
        t.observed(spark.range(0, 1000, 1, 4), "grouped").groupBy((F.col("id") % 10).alias("k")).count().write.format("noop").mode("overwrite").save()
    with t.step("nothing"):
        pass
    log = t.log()
    whole = {r["step"]: r for r in log.where("stage is null").collect()}
    assert whole["grouped"]["rows_out"] == 1000 and whole["nothing"]["rows_out"] is None and whole["grouped"]["seconds"] > 0
    stages = log.where("step = 'grouped' and stage is not null").collect()
    assert sum(r["rows_shuffled"] for r in stages) == 40 and sum(r["tasks"] for r in stages) >= 5 and all(r["step"] != "nothing" for r in stages)


# --- regions


def test_only_files_that_are_hit_are_opened(spark, tmp_path):
    from strandline.sources import regions

    points = spark.createDataFrame([(f"chr{1 + i % 3}", (i * 7919) % 30_000, i) for i in range(3000)], "chrom string, pos long, n long")
    regions.write_indexed(points, str(tmp_path / "t"), 12)
    asked = spark.createDataFrame([(1, "chr1", 100, 900), (2, "chr1", 800, 800), (3, "chr3", 29_000, 45_000), (4, "chr2", 5, 4), (5, "chr9", 0, 10**6)], "region long, chrom string, start long, end long").where("start <= end")
    got = regions.fetched(spark, str(tmp_path / "t"), asked, 1000)
    want = sorted((r, n) for r, c, lo, hi in ((1, "chr1", 100, 900), (2, "chr1", 800, 800), (3, "chr3", 29_000, 45_000)) for x, p, n in points.collect() if x == c and lo <= p <= hi)
    assert rows(got, "region", "n") == sorted(want, key=str) and want
    hit = regions.files_hit(spark, str(tmp_path / "t"), asked)
    opened = {f.rsplit("/", 1)[1] for f in got.inputFiles() if "/data/" in f}
    assert opened == set(hit) and 2 <= len(hit) <= 3
    assert regions.fetched(spark, str(tmp_path / "t"), asked.where("region = 5")).count() == 0
