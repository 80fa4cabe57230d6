"""Queries against their oracle SQL on tables that differ from the given ones in what larger copies bring."""

import os
import time

import duckdb
import pytest

from strandline.plans import catalog
from strandline.plans.views import TABLES

SMALL = "/root/testdata/sf0.01"


@pytest.fixture
def made(tmp_path):
    """Makes a folder of tables: those given as SQL over the small ones, the others as they are."""

    def make(**tables):
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
        for t in TABLES:
            if t in tables:
                con.execute(f"copy ({tables[t]}) to '{tmp_path}/{t}.parquet' (format parquet)")
            else:
                os.symlink(f"{SMALL}/{t}.parquet", f"{tmp_path}/{t}.parquet")
        return str(tmp_path)

    return make


def same(spark, name, folder):
    con = duckdb.connect()
    con.execute("set TimeZone = 'UTC'; set threads = 1")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    want = con.execute(catalog.oracle_sql()[name])
    names = [d[0] for d in want.description]
    text = lambda x: f"{x:.9g}" if isinstance(x, float) else str(x)
    got = sorted(tuple(map(text, r)) for r in catalog.queries()[name](spark, folder).select(*names).collect())
    assert got and got == sorted(tuple(map(text, r)) for r in want.fetchall())


def test_delta_summary_where_rows_share_a_number(spark, made):
    """Above a million variants a row has the number of another row's second copy."""
    same(spark, "q31_delta_summary", made(part="select * from part union all select * replace (p_partkey + 1000000 as p_partkey) from part"))


def test_archaic_calls_where_lines_share_a_number(spark, made):
    """Some lines come again with their number and place and another status; the first in the table counts, whichever status it has."""
    lines = "select * replace ((l_orderkey // 3) * 3 as l_orderkey, (l_partkey // 5) * 5 + 1 as l_partkey) from lineitem"
    turned = lines.replace("as l_partkey)", "as l_partkey, case l_linestatus when 'F' then 'O' else 'F' end as l_linestatus)")
    same(spark, "q85_archaic_calls", made(lineitem=f"{lines} union all {turned}"))


def test_stream_repair_keeps_up_with_many_places(spark, made):
    """Tens of thousands of places, each decided without a call of Python of its own."""
    folder, begun = made(), time.monotonic()
    same(spark, "x04_stream_repair", folder)
    assert time.monotonic() - begun < 60


def most_rows(spark, make):
    """Most rows that an operator of the plan of make() gave."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df, most = make(), 0
        df.collect()
        todo = [df._jdf.queryExecution().executedPlan()]
        while todo:
            p = todo.pop()
            if p.metrics().contains("numOutputRows"):
                most = max(most, p.metrics().apply("numOutputRows").value())
            todo += [p.children().apply(i) for i in range(p.children().size())]
        return most
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_ancestry_of_many_customers_needs_no_pairs(spark, made):
    """Customers and suppliers of a nation are not paired one by one."""
    folder = made(supplier="select * replace (s_suppkey + k * 100000 as s_suppkey) from supplier, (select unnest(range(20)) as k)")
    same(spark, "q47_multi_ancestry_eval", folder)
    pairs = duckdb.sql(f"select count(*) from '{folder}/customer.parquet', '{folder}/supplier.parquet' where c_nationkey = s_nationkey").fetchall()[0][0]
    assert most_rows(spark, lambda: catalog.queries()["q47_multi_ancestry_eval"](spark, folder)) < pairs / 4


def test_targets_inside_spans_are_counted_by_blocks(spark, monkeypatch):
    """Whole blocks, ends inside one block, in neighbours, and on the edges of blocks."""
    import random

    from strandline.operators import genotypes as G

    rnd = random.Random(3)
    records = [(rnd.randrange(40), c, rnd.randrange(1, 400), "0/1" if rnd.random() < 0.8 else "./.") for c in ("1", "2") for _ in range(200)]
    targets = [(c, p) for c in ("1", "2", "3") for p in range(1, 420) if p % 7 < 5] + [("1", 8), ("1", 8)]
    monkeypatch.setattr(G, "BLOCK", 32, raising=False)
    tables = spark.createDataFrame(records, "iid int, chrom string, pos int, gt string"), spark.createDataFrame(targets, "chrom string, pos int")
    want = {}
    for i in {r[0] for r in records}:
        own = [r for r in records if r[0] == i]
        spans = {c: [p for _, x, p, _ in own if x == c] for c in {r[1] for r in own}}
        inside = sum(min(spans[c]) <= p <= max(spans[c]) for c, p in set(targets) if c in spans)
        if inside:
            want[i] = (len({(c, p) for _, c, p, g in own if "." not in g} & set(targets)), inside)
    assert {r["iid"]: (r["n_explicit"], r["n_targets"]) for r in G.explicit_fraction(*tables).collect()} == want
    assert most_rows(spark, lambda: G.explicit_fraction(*tables)) < 6000


def test_forest_goes_over_its_genotypes_once(spark, made, monkeypatch):
    """The cohort is written once and read by all its users; relatives are worked out once."""
    from strandline.sources import shared

    names, kept = [], shared.kept
    monkeypatch.setattr(shared, "kept", lambda df, name: names.append(name) or kept(df, name))
    catalog.queries()["m02_population_forest"](spark, made())
    assert names.count("cohort") == names.count("panel") == names.count("related") == 1
