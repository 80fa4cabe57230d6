"""Principal components of a reference panel, their projection on any number of samples, and population prediction.

A panel is a table of genotypes (iid, vid, dosage) of individuals whose number does not grow with samples: tasks and
driver hold vectors of MOST_PANEL entries at most, which is checked. Everything else grows with variants or samples and
stays in tables: a variant's dosages over the panel are one row, loadings are a table by variant, and samples meet them
in a join and an aggregate.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.sources import shared

#: Individuals of a panel at most; columns of the range finder beyond the components; passes over the variants.
MOST_PANEL = 50_000
EXTRA = 20
PASSES = 8
#: Variants that a task multiplies at once.
AT_ONCE = 512


def oriented(genotypes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Target genotypes in the panel's ids and orientation: iid, vid, dosage. pairs: id_target, id_ref, same_ref, as from an intersect; genotypes of other variants do not count."""
    own = genotypes.join(pairs.select(F.col("id_target").alias("vid"), "id_ref", "same_ref"), "vid")
    return own.select("iid", F.col("id_ref").alias("vid"), F.when(F.col("same_ref"), F.col("dosage")).otherwise(2 - F.col("dosage")).alias("dosage"))


def panel_vectors(genotypes: DataFrame, people: DataFrame) -> DataFrame:
    """A row for each variant that varies in the panel: vid, mean, sd, at (places of the called individuals in the order of ids), x (their dosages, standardised)."""
    order = people.select(F.col("iid").cast("bigint").alias("iid")).distinct().orderBy("iid").limit(MOST_PANEL + 1).collect()
    if len(order) > MOST_PANEL:
        raise ValueError(f"a panel of more than {MOST_PANEL} individuals")
    place = genotypes.sparkSession.createDataFrame([(r["iid"], i) for i, r in enumerate(order)], "iid bigint, place int")
    called = genotypes.where("dosage is not null").select(F.col("iid").cast("bigint").alias("iid"), "vid", F.col("dosage").cast("double").alias("d")).join(place, "iid")
    each = called.groupBy("vid").agg(F.avg("d").alias("mean"), F.stddev_pop("d").alias("sd"), F.sort_array(F.collect_list(F.struct("place", "d"))).alias("g"))
    each = each.where("sd > 1e-9")
    return each.select("vid", "mean", "sd", F.transform("g", lambda g: g["place"]).alias("at"), F.transform("g", lambda g: (g["d"] - F.col("mean")) / F.col("sd")).alias("x"))


def _dense(batch, n: int):
    """Slices of a batch of panel vectors as matrices, a row each."""
    for lo in range(0, batch.num_rows, AT_ONCE):
        part = batch.slice(lo, AT_ONCE)
        at, x = part.column("at"), part.column("x")
        m = np.zeros((part.num_rows, n))
        m[np.repeat(np.arange(part.num_rows), np.diff(at.offsets.to_numpy())), at.flatten().to_numpy()] = x.flatten().to_numpy()
        yield part, m


def _times(vectors: DataFrame, n: int, q: np.ndarray) -> np.ndarray:
    """The panel's matrix of products, applied to q (n x l): each task adds up its variants, and driver and tasks hold n x l numbers."""
    held = vectors.sparkSession.sparkContext.broadcast(q)

    def run(batches):
        total = np.zeros_like(held.value)
        for batch in batches:
            for _, m in _dense(batch, n):
                total += m.T @ (m @ held.value)
        yield pa.record_batch([pa.array(range(n), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], ["i", "row"])

    parts = vectors.select("at", "x").mapInArrow(run, "i int, row array<double>")
    sums = parts.groupBy("i").agg(F.array(*(F.sum(F.col("row")[k]) for k in range(q.shape[1]))).alias("row")).orderBy("i").collect()
    held.unpersist()
    return np.array([r["row"] for r in sums]) if sums else np.zeros_like(q)


class Loadings:
    """Loadings of a panel's variants: table (vid, mean, sd, loading), and the panel's own values (n x l), singular values and ids."""

    def __init__(self, table: DataFrame, people: list[int], coordinates: np.ndarray, singular: np.ndarray):
        self.table, self.people, self.coordinates, self.singular = table, people, coordinates, singular


def loadings(genotypes: DataFrame, people: DataFrame, k: int = 10) -> Loadings:
    """The first components of the panel's standardised genotypes (people: iid), by block-wise randomized SVD: passes of the matrix of products over a random start of k + EXTRA columns, then the small matrix that is left. Missing genotypes count as the mean. With fewer individuals than columns it is exact."""
    ids = sorted(r[0] for r in people.select(F.col("iid").cast("bigint")).distinct().collect())
    vectors, n = shared.kept(panel_vectors(genotypes, people), "panel-vectors"), len(ids)
    columns = min(n, k + EXTRA)
    q = np.linalg.qr(np.random.default_rng(20240601).standard_normal((n, columns)))[0] if n else np.zeros((0, 0))
    for _ in range(PASSES if columns < n else 1):
        q = np.linalg.qr(_times(vectors, n, q))[0]
    value, vector = np.linalg.eigh(q.T @ _times(vectors, n, q)) if n else (np.zeros(0), q)
    top = [i for i in np.argsort(value)[::-1] if value[i] > 1e-9 * max(value.max(initial=0), 1e-30)]
    u, s = q @ vector[:, top], np.sqrt(value[top])
    u *= np.where(u[np.abs(u).argmax(0), np.arange(len(top))] < 0, -1, 1) if len(top) else 1  # the largest entry is positive
    held = genotypes.sparkSession.sparkContext.broadcast(u / s)

    def run(batches):
        for batch in batches:
            for part, m in _dense(batch, n):
                yield pa.record_batch([*(part.column(c) for c in ("vid", "mean", "sd")), pa.array((m @ held.value).tolist(), pa.list_(pa.float64()))], ["vid", "mean", "sd", "loading"])

    table = shared.kept(vectors.mapInArrow(run, f"vid {dict(vectors.dtypes)['vid']}, mean double, sd double, loading array<double>"), "loadings")
    shared.forget(vectors)
    return Loadings(table, ids, u * s, s)


def projected(genotypes: DataFrame, fitted: Loadings, k: int = 10, augment: bool = True) -> DataFrame:
    """Components of any samples (iid, vid, dosage; panel ids and orientation): iid, pc (array of k; 0 beyond the rank). A join by variant and an aggregate by sample; missing genotypes count as the mean.

    augment: a sample's coordinates are taken in the decomposition of the panel with the sample added, turned back onto the panel's own by a Procrustes map, which undoes the shrinkage of plain projection. It needs the sample's projections and its length alone."""
    s, own = fitted.singular, fitted.coordinates
    rank = len(s)
    z = genotypes.where("dosage is not null").join(fitted.table, "vid").withColumn("z", (F.col("dosage") - F.col("mean")) / F.col("sd"))
    sums = z.groupBy(F.col("iid").cast("bigint").alias("iid")).agg(F.array(*(F.sum(F.col("z") * F.col("loading")[i]) for i in range(rank))).cast("array<double>").alias("c"), F.sum(F.col("z") * F.col("z")).alias("length"))
    held = genotypes.sparkSession.sparkContext.broadcast((own, s))

    def added(c: np.ndarray, length: float) -> np.ndarray:
        own, s = held.value
        rest = np.sqrt(max(length - c @ c, 0.0))
        m = np.zeros((rank + 1, rank + 1))
        m[:rank, :rank], m[:rank, rank], m[rank, rank] = np.diag(s), c, rest
        _, values, turn = np.linalg.svd(m)
        used = min(k, rank)
        both = np.vstack([np.column_stack([own / s, np.zeros(len(own))]), np.eye(rank + 1)[rank]]) @ turn.T[:, :used] * values[:used]
        mine, sample = both[:-1], both[-1]
        a, b = own[:, :used] - own[:, :used].mean(0), mine - mine.mean(0)
        left, d, right = np.linalg.svd(b.T @ a)
        return (sample - mine.mean(0)) @ (left @ right) * (d.sum() / max((b * b).sum(), 1e-30)) + own[:, :used].mean(0)

    def run(batches):
        for batch in batches:
            out = np.zeros((batch.num_rows, k))
            for i, (c, length) in enumerate(zip(batch.column("c").to_pylist(), batch.column("length").to_pylist())):
                c = np.array(c, float)
                out[i, : min(k, rank)] = added(c, length) if augment else c[:k]
            yield pa.record_batch([batch.column("iid"), pa.array(out.tolist(), pa.list_(pa.float64()))], ["iid", "pc"])

    return sums.mapInArrow(run, "iid bigint, pc array<double>")


def panel_components(spark, fitted: Loadings, k: int = 10) -> DataFrame:
    """The panel's own components: iid, pc."""
    pc = np.zeros((len(fitted.people), k))
    pc[:, : min(k, len(fitted.singular))] = fitted.coordinates[:, :k]
    return spark.createDataFrame(list(zip(fitted.people, pc.tolist())), "iid bigint, pc array<double>")


def populations(pcs: DataFrame, known: DataFrame, used: int = 5, trees: int = 50) -> DataFrame:
    """Population of each individual by a forest on the first components, trained on known (iid, pop): iid, predicted, p."""
    x = pcs.select("iid", array_to_vector(F.slice("pc", 1, used)).alias("features"))
    train = x.join(known, "iid")
    names = StringIndexer(inputCol="pop", outputCol="label").fit(train)
    out = RandomForestClassifier(numTrees=trees, seed=7).fit(names.transform(train)).transform(x)
    return out.select("iid", F.element_at(F.array(*map(F.lit, names.labels)), F.col("prediction").cast("int") + 1).alias("predicted"), F.round(F.array_max(vector_to_array("probability")), 6).alias("p"))
