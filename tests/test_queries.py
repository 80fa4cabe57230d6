"""Each query of the library against its oracle SQL on the smallest tables."""

import duckdb
import pytest

from strandline.plans import catalog
from strandline.plans.views import TABLES

SF = "/root/testdata/sf0.001"
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("set TimeZone = 'UTC'")
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def text(x):
    return "None" if x is None else f"{x:.9g}" if isinstance(x, float) else str(x)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, con, name):
    df = catalog.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(text(r[c]) for c in columns) for r in df.collect())
    if name not in catalog.oracle_sql():
        assert got
        return
    want = con.execute(catalog.oracle_sql()[name])
    names, kinds = [d[0] for d in want.description], [str(d[1]) for d in want.description]
    assert sorted(names) == columns
    assert {c: KINDS.get(t, t) for c, t in df.dtypes} == dict(zip(names, kinds))
    assert got == sorted(tuple(text(r[names.index(c)]) for c in columns) for r in want.fetchall())
