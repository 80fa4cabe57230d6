"""Domain views over the driver's tables, as SQL that runs unchanged in Spark and DuckDB.

A view's text names tables and other views in braces. In Spark each name is a DataFrame; for the oracle the views that
a text needs become a chain of common table expressions.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.sources import shared

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
_NUMBER = "CAST(substr(p_brand, 7) AS int)"
_KIND = "(900 + ascii(substr(p_type, 2, 1)))"

VIEWS = {
    "variant": """
        SELECT p_partkey AS vid, concat('chr', CAST(p_partkey % 22 + 1 AS string)) AS chrom, p_partkey * 97 + 1001 AS pos,
               substr('ACGT', CAST(p_size % 4 + 1 AS int), 1) AS a1, substr('ACGT', CAST((p_size + 1 + p_partkey % 3) % 4 + 1 AS int), 1) AS a2
        FROM {part}""",
    "variant2": """
        SELECT vid, chrom, pos, a1, CASE WHEN vid % 4 = 0 OR concat(a1, a2) NOT IN ('AT', 'TA', 'CG', 'GC') THEN a2 WHEN a1 IN ('A', 'T') THEN 'C' ELSE 'A' END AS a2
        FROM {variant}""",
    "score_member": f"""
        SELECT {_NUMBER} AS number, p_partkey AS vid, CAST(round(p_retailprice * 100) AS bigint) - 120000 AS w, p_name AS rsid FROM {{part}}
        UNION ALL
        SELECT {_KIND} AS number, p_partkey AS vid, CAST(p_size AS bigint) * 100 - 2400 AS w, p_name AS rsid FROM {{part}}""",
    "scorefile": """
        SELECT concat('PGS', lpad(CAST(number AS string), 6, '0'), '_hmPOS_GRCh38') AS accession, concat('PGS', lpad(CAST(number AS string), 6, '0')) AS pgs_id,
               concat('trait_', CAST(number % 8 AS string)) AS trait, vid AS row_nr, chrom, pos, w,
               CASE number % 3 WHEN 0 THEN 'additive' WHEN 1 THEN 'dominant' ELSE 'recessive' END AS effect_type,
               CASE vid % 5 WHEN 1 THEN a2 WHEN 2 THEN translate(a1, 'ACGT', 'TGCA') WHEN 3 THEN translate(a2, 'ACGT', 'TGCA') ELSE a1 END AS effect_allele,
               CASE vid % 5 WHEN 0 THEN a2 WHEN 1 THEN a1 WHEN 2 THEN translate(a2, 'ACGT', 'TGCA') WHEN 3 THEN translate(a1, 'ACGT', 'TGCA') END AS other_allele
        FROM {score_member} JOIN {variant2} USING (vid)""",
    "call": """
        SELECT o_custkey AS cust, c_nationkey AS nation, l_partkey AS vid, l_linenumber AS line
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey""",
    "g25": "SELECT CAST(nation AS bigint) AS iid, vid, CAST(max(line) % 3 AS int) AS dosage FROM {call} GROUP BY nation, vid",
    "g12": "SELECT cust % 12 AS iid, vid, CAST(max(line) % 3 AS int) AS dosage FROM {call} GROUP BY cust % 12, vid",
    "g200": "SELECT cust % 200 AS iid, vid, CASE WHEN (cust % 200 + vid) % 11 <> 0 THEN CAST(max(line) % 3 AS int) END AS dosage FROM {call} GROUP BY cust % 200, vid",
    "gc": "SELECT cust AS iid, vid, CAST(max(line) % 3 AS int) AS dosage FROM {call} GROUP BY cust, vid",
    "sample": """
        SELECT c_custkey AS iid, r_name AS pop, CASE WHEN c_custkey % 10 = 0 THEN 'target' ELSE 'reference' END AS sampleset, cast(round(c_acctbal * 100) AS bigint) AS pc1
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    "record": """
        SELECT o_custkey % 25 AS iid, o_custkey % 22 + 1 AS chrom, l_partkey AS pos, substr('ACGT', CAST(l_partkey % 4 + 1 AS int), 1) AS ref,
               CASE WHEN l_linestatus = 'F' THEN '.' ELSE substr('ACGT', CAST((l_partkey + 1 + l_linenumber % 3) % 4 + 1 AS int), 1) END AS alt,
               CASE WHEN l_linestatus = 'F' THEN CASE WHEN l_linenumber % 5 = 0 THEN './.' ELSE '0/0' END
                    ELSE CASE l_linenumber % 4 WHEN 0 THEN '0/1' WHEN 1 THEN '1|1' WHEN 2 THEN '1' ELSE '0|1' END END AS gt,
               CAST(l_quantity AS int) AS depth, l_orderkey * 10 + l_linenumber AS ord
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "allele": "SELECT chrom, pos, ref, min(alt) AS first_alt FROM {record} WHERE alt <> '.' AND iid % 2 = 0 GROUP BY 1, 2, 3",
    "meta": """
        SELECT concat('PGS', lpad(CAST(number AS string), 6, '0')) AS pgs_id, concat('trait_', CAST(number % 8 AS string)) AS trait, number,
               CAST(sum(l_quantity) AS bigint) * 40 AS gwas_n, count(DISTINCT vid) AS n_variants,
               CASE number % 4 WHEN 0 THEN 'European' WHEN 1 THEN 'EUR' WHEN 2 THEN 'multi' ELSE 'EUR (100%)' END AS training_ancestry,
               number % 3 = 0 AS multi_eval, number % 5 > 0 AS has_eval, CASE WHEN number % 4 < 2 THEN 'A' WHEN number % 4 = 2 THEN 'B' ELSE 'C' END AS base_grade
        FROM {score_member} JOIN {lineitem} ON l_partkey = vid GROUP BY number""",
    "effect": """
        SELECT concat('PGS', lpad(CAST(n_nationkey AS string), 6, '0')) AS pgs_id, concat(CASE WHEN n_nationkey % 5 = 2 THEN ' ' ELSE '' END, 'trait_', CAST(n_nationkey % 8 AS string), CASE WHEN n_nationkey % 4 = 1 THEN ' ' ELSE '' END) AS trait,
               CASE WHEN n_nationkey % 7 <> 3 THEN 1.1e0 + n_nationkey * 0.04e0 END AS per_sd, n_nationkey AS ord FROM {nation} WHERE n_nationkey % 3 < 2
        UNION ALL SELECT concat('PGS', lpad(CAST(n_nationkey AS string), 6, '0')) AS pgs_id, concat('TRAIT_', CAST((n_nationkey + 1) % 8 AS string)) AS trait, CASE WHEN n_nationkey % 2 = 1 THEN 1.3e0 + n_nationkey * 0.02e0 END AS per_sd, n_nationkey + 100 AS ord FROM {nation} WHERE n_nationkey % 3 = 1""",
    "baseline": """
        SELECT concat('trait_', CAST(n_nationkey % 6 AS string), CASE WHEN n_nationkey % 4 = 1 THEN ' ' ELSE '' END) AS trait, CASE n_nationkey % 3 WHEN 0 THEN 'female' WHEN 1 THEN 'male' ELSE 'overall' END AS sex,
               CASE WHEN n_nationkey % 5 = 0 THEN 'EUROPE' WHEN n_nationkey % 5 = 1 THEN 'ASIA' ELSE 'overall' END AS ancestry, CASE WHEN n_nationkey % 8 <> 6 THEN 0.02e0 + n_nationkey * 0.015e0 END AS baseline_risk, n_nationkey AS ord
        FROM {nation}""",
    "baseline_known": "SELECT lower(trim(trait)) AS trait, sex, ancestry, max_by(baseline_risk, ord) AS baseline_risk FROM {baseline} WHERE baseline_risk IS NOT NULL GROUP BY 1, 2, 3",
    "idxstat": "SELECT p.chrom AS contig, max(pos) AS length, count(*) * 150 AS mapped, CAST(l_suppkey % 7 AS bigint) AS iid FROM (SELECT vid, CASE WHEN vid % 25 = 22 THEN 'chrX' WHEN vid % 25 = 23 THEN 'chrY' ELSE chrom END AS chrom, pos FROM {variant}) p JOIN {lineitem} ON l_partkey = vid GROUP BY p.chrom, l_suppkey % 7",
    "trace": "SELECT event_type AS step, user_id % 6 AS subset, concat(CAST(round(value, 1) AS string), CASE WHEN event_id % 3 = 0 THEN ' GB' WHEN event_id % 3 = 1 THEN ' MB' ELSE ' KB' END) AS peak FROM {events} WHERE value IS NOT NULL",
}

_NAME = re.compile(r"\{(\w+)\}")


class Views:
    """views.<name> is the DataFrame of a table or view."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._made = spark, sf_dir, {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._made:
            self._made[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet") if name in TABLES else self.sql(VIEWS[name])
        return self._made[name]

    def once(self, name: str, make) -> DataFrame:
        """What make() gives, worked out once however often a query uses it."""
        if f"once {name}" not in self._made:
            self._made[f"once {name}"] = shared.kept(make(), name)
        return self._made[f"once {name}"]

    def sql(self, text: str) -> DataFrame:
        return self.spark.sql(text, **{n: getattr(self, n) for n in set(_NAME.findall(text))})


def numbered(table: DataFrame) -> DataFrame:
    """A table read from Parquet with nth, the place of each row in the table: by files in the order of their names, then inside the file."""
    files = F.array(*map(F.lit, sorted(table.inputFiles())))
    return table.withColumn("nth", F.array_position(files, F.col("_metadata.file_path")) * (1 << 40) + F.col("_metadata.row_index"))


def oracle(text: str) -> str:
    """SQL for DuckDB: a query whose text may have views in braces."""
    order: list[str] = []

    def need(t: str) -> None:
        for n in _NAME.findall(t):
            if n not in TABLES and n not in order:
                need(VIEWS[n])
                order.append(n)

    need(text)
    plain = lambda t: _NAME.sub(r"\1", t).strip()
    ctes = [f"{n} AS ({plain(VIEWS[n])})" for n in order]
    body = plain(text)
    if not ctes:
        return body
    return f"WITH RECURSIVE {', '.join(ctes)}, {body[len('WITH '):]}" if body.upper().startswith("WITH ") else f"WITH {', '.join(ctes)} {body}"
