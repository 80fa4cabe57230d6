"""Repair of a stream of genotype records, with the state of a place kept only while records of it may come."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FATES = "iid long, chrom long, pos long, ref string, alt string, gt string, ord long, multi boolean, fate string"
#: Chromosome of a mark that only moves the watermark on.
MARK = -1


def _fates(ref, alt, gt, order) -> dict[str, list]:
    """Columns of one place's records in their order, with multi and fate."""
    rows = sorted(zip(order, ref, alt, gt), key=lambda r: r[0])
    varies, seen, fate = any(r[2] != "." for r in rows), set(), []
    for _, *alleles, _ in rows:
        fate.append("dropped_homref" if alleles[1] == "." and varies else "dropped_dup" if tuple(alleles) in seen else "kept")
        seen.add(tuple(alleles))
    return {"ref": [r[1] for r in rows], "alt": [r[2] for r in rows], "gt": [r[3] for r in rows], "ord": [r[0] for r in rows], "multi": [len(rows) > 1] * len(rows), "fate": fate}


def fates(records: pd.DataFrame) -> pd.DataFrame:
    """What operators.genotypes.repaired says of one place's records (ref, alt, gt, ord)."""
    return pd.DataFrame(_fates(*(records[c].tolist() for c in ("ref", "alt", "gt", "ord"))))


def repaired_stream(records: DataFrame, late: str = "0 seconds") -> DataFrame:
    """Fates of a stream's records: iid, chrom, pos, ref, alt, gt, ord, multi, fate. records: those columns of FATES before multi, and at, a time that grows with the order in which places come; a place's records have one such time. A place is decided, and its state goes, when the watermark (late behind the newest time) has passed it, so the state holds the places of that span alone. A record that comes later than that is dropped by the stream. Records of chromosome MARK move the watermark on and leave nothing."""
    own = records.select("iid", "chrom", "pos", "ref", "alt", "gt", "ord", "at").withWatermark("at", late)
    record = F.when(F.col("chrom") != MARK, F.struct("ref", "alt", "ord", "gt"))
    places = own.groupBy("iid", "chrom", "pos", "at").agg(F.array_sort(F.collect_list(record)).alias("rows"))
    varies = F.coalesce(F.exists("rows", lambda r: r["alt"] != "."), F.lit(False))
    again = lambda r, last: last["ref"].eqNullSafe(r["ref"]) & last["alt"].eqNullSafe(r["alt"])
    fate = lambda r, i: F.when((r["alt"] == ".") & F.col("varies"), "dropped_homref").when((i > 0) & again(r, F.get("rows", i - 1)), "dropped_dup").otherwise("kept")
    told = places.withColumns({"varies": varies, "multi": F.size("rows") > 1})
    each = told.select("iid", "chrom", "pos", "multi", F.explode(F.transform("rows", lambda r, i: F.struct(r.alias("r"), fate(r, i).alias("fate")))).alias("x"))
    return each.select("iid", "chrom", "pos", "x.r.ref", "x.r.alt", "x.r.gt", "x.r.ord", "multi", "x.fate")


def place_time(chrom: str = "chrom", pos: str = "pos"):
    """A time in the order of the genome, a millisecond for each base, for streams whose records come in that order."""
    return F.timestamp_millis(F.col(chrom) * 300_000_000 + F.col(pos))


def marks(stream: DataFrame, at) -> DataFrame:
    """A record of no place for each row of a stream, at a time: it tells that nothing before that time will come."""
    text = F.lit("")
    return stream.select(F.lit(0).cast("long").alias("iid"), F.lit(MARK).cast("long").alias("chrom"), F.lit(0).cast("long").alias("pos"), text.alias("ref"), text.alias("alt"), text.alias("gt"), F.lit(0).cast("long").alias("ord"), at.alias("at"))
