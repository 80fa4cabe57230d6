"""The closure of affected rows goes on to its end."""

from strandline.operators import match


def test_long_chain(spark):
    links = spark.createDataFrame([("a", r, v) for r in range(26) for v in (r, r + 1)] + [("b", 0, 0), ("b", 1, 5)], "accession string, row_nr long, vid long").coalesce(1)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        got = sorted(tuple(r) for r in match.affected(links, spark.createDataFrame([(0,)], "vid long")).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == [("a", r) for r in range(26)] + [("b", 0)]
