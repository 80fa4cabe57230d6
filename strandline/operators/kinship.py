"""Relatedness of a panel's individuals, and the largest-priority set of unrelated ones."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.operators.graphs import independent
from strandline.sources import shared

#: Kinship of third-degree relatives at least.
LEAST_KINSHIP = 0.0442
#: Individuals of a group; variants that a task counts at once.
GROUP = 256
AT_ONCE = 1024


#: Variants of a slice at least.
SLICE = 4096


def _pairs_of_groups(batches):
    """From batches sorted by pair of groups, slice and variant: each pair and slice with tables of whole variants, AT_ONCE at a time or little more."""

    def slices():
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("one", "two", "slice")])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
                for at in range(lo, hi, 2 * AT_ONCE):
                    yield tuple(keys[:, at].tolist()), pa.Table.from_batches([batch.slice(at, min(hi, at + 2 * AT_ONCE) - at)])

    def of(own):
        held = None
        for _, table in own:
            table = pa.concat_tables([held, table]) if held is not None else table
            vid = table.column("vid").to_numpy()
            whole = int(np.searchsorted(vid, vid[-1]))  # the last variant may go on
            held = table.slice(whole)
            if whole:
                yield table.slice(0, whole)
        if held is not None and held.num_rows:
            yield held

    for key, own in itertools.groupby(slices(), lambda x: x[0]):
        yield key, of(own)


def _counts(table: pa.Table, key: tuple[int, int], ids: list[dict[int, int]]) -> np.ndarray:
    """For pairs of individuals of two groups: variants where both are heterozygous, where they are opposite homozygotes, where the one is heterozygous and the other called, the same the other way, and where both are called. ids gets new individuals."""
    lists = table.column("g").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    own, (vids, place) = table.column("own").to_numpy(), np.unique(table.column("vid").to_numpy(), return_inverse=True)
    row, flat = np.repeat(np.arange(table.num_rows), np.diff(lists.offsets.to_numpy())), lists.flatten()
    iid, dosage = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("iid", "dosage"))
    is_, call = [], []
    for side in (0, 1):
        here = own[row] == key[side]
        people, i = np.unique(iid[here], return_inverse=True)
        at = np.array([ids[side].setdefault(int(x), len(ids[side])) for x in people], np.int64)
        m = np.full((len(ids[side]), len(vids)), -1, np.int8)
        m[at[i], place[row[here]]] = dosage[here]
        is_.append([(m == v).astype(np.float32) for v in (0, 1, 2)])
        call.append((m >= 0).astype(np.float32))
    (a0, a1, a2), (b0, b1, b2) = is_
    return np.stack([a1 @ b1.T, a0 @ b2.T + a2 @ b0.T, a1 @ call[1].T, call[0] @ b1.T, call[0] @ call[1].T])


#: Counts of a pair.
COUNTS = ("shared", "opposite", "n_one", "n_two", "n")


def _estimate(shared, opposite, one, two):
    less = np.minimum(one, two)
    with np.errstate(divide="ignore", invalid="ignore"):
        return (shared - 2 * opposite) / (2 * less) + 0.5 - (one + two) / (4 * less)


def kinship(genotypes: DataFrame, least: float = LEAST_KINSHIP, group: int = GROUP) -> DataFrame:
    """Pairs of individuals (iid, vid, dosage) related at least so much: a, b (a < b), kinship, n (variants called in both). Between-family robust estimate: shared heterozygous sites less twice the opposite homozygous ones, over twice the heterozygous sites of the one who has fewer, with the correction for unequal ones.

    Individuals are dealt into groups by hash; a task goes through a slice of the variants for one pair of groups and holds the counts of their pairs, group squared. Where there are fewer pairs of groups than shuffle partitions, variants are dealt into several slices, whose counts are added; with one slice only pairs that are related leave a task."""
    people = genotypes.select(F.col("iid").cast("bigint").alias("iid")).distinct()
    n_groups = max(1, -(-people.count() // group))
    side = F.pmod(F.xxhash64("iid"), F.lit(n_groups)).cast("int")
    called = genotypes.where("dosage between 0 and 2").select(F.col("iid").cast("bigint").alias("iid"), F.col("vid").cast("bigint").alias("vid"), F.col("dosage").cast("int").alias("dosage"))
    rows = called.withColumn("own", side).groupBy("own", "vid").agg(F.collect_list(F.struct("iid", "dosage")).alias("g"))
    both = F.transform(F.sequence(F.lit(0), F.lit(n_groups - 1)), lambda o: F.struct(F.least(o, F.col("own")).alias("one"), F.greatest(o, F.col("own")).alias("two")))
    pairs = n_groups * (n_groups + 1) // 2
    n_slices = max(1, min(-(-2 * int(genotypes.sparkSession.conf.get("spark.sql.shuffle.partitions")) // pairs), called.agg(F.approx_count_distinct("vid")).first()[0] // SLICE))
    rows = rows.withColumn("pair", F.explode(both)).select("pair.one", "pair.two", F.pmod(F.xxhash64("vid"), F.lit(n_slices)).alias("slice"), "own", "vid", "g")

    def counted(batches):
        for key, tables in _pairs_of_groups(batches):
            ids: list[dict[int, int]] = [{}, {}]
            sums = np.zeros((5, 0, 0))
            for table in tables:
                now = _counts(table, key, ids)
                total = np.zeros((5, len(ids[0]), len(ids[1])))
                total[:, : sums.shape[1], : sums.shape[2]] = sums
                sums = total + now
            a, b = (np.array(list(x), np.int64) for x in ids)
            met = (a[:, None] != b[None, :]) if key[0] != key[1] else (a[:, None] < b[None, :])
            if n_slices == 1:
                met &= (np.minimum(sums[2], sums[3]) > 0) & (_estimate(*sums[:4]) >= least)
            i, j = np.nonzero(met & (sums[4] > 0))
            turned = a[i] > b[j]
            one, two = np.where(turned, sums[3][i, j], sums[2][i, j]), np.where(turned, sums[2][i, j], sums[3][i, j])
            columns = [np.minimum(a[i], b[j]), np.maximum(a[i], b[j]), sums[0][i, j], sums[1][i, j], one, two, sums[4][i, j]]
            yield pa.record_batch([pa.array(c.astype(np.int64)) for c in columns], ["a", "b", *COUNTS])

    parts = rows.repartition("one", "two", "slice").sortWithinPartitions("one", "two", "slice", "vid").mapInArrow(counted, ", ".join(f"{c} bigint" for c in ("a", "b", *COUNTS)))
    if n_slices > 1:
        parts = parts.groupBy("a", "b").agg(*(F.sum(c).alias(c) for c in COUNTS))
    less = F.least("n_one", "n_two")
    k = (F.col("shared") - 2 * F.col("opposite")) / (2 * less) + 0.5 - (F.col("n_one") + F.col("n_two")) / (4 * less)
    return parts.where(less > 0).select("a", "b", k.alias("kinship"), "n").where(F.col("kinship") >= least)


def unrelated(people: DataFrame, related: DataFrame) -> DataFrame:
    """People (iid) that stay when those with the fewest relatives are taken first, then by id, and each goes that is related to one taken before: iid."""
    related = shared.kept(related.select("a", "b"), "related")  # used several times, and each would go over all genotypes
    ends = related.select(F.col("a").alias("iid")).union(related.select(F.col("b").alias("iid"))).groupBy("iid").agg(F.count(F.lit(1)).alias("n"))
    nodes = people.select(F.col("iid").cast("bigint").alias("iid")).distinct().join(ends, "iid", "left").select("iid", F.coalesce("n", F.lit(0)).alias("n"))
    return independent(nodes, related, "iid", "n")
