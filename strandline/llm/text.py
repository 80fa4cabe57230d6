"""Text expressions that several corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters that separate words, and the words between them.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def whole(text: str | Column) -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def let(value: Column, body) -> Column:
    """body(value), with value computed once a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def n_words(text: str | Column) -> Column:
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")


def words(text: str | Column) -> Column:
    return F.regexp_extract_all(whole(text), F.lit(f"({WORD})"), F.lit(1))


def one_spaced(text: str | Column) -> Column:
    """The text with each run of spaces replaced by one space."""
    return F.regexp_replace(whole(text), SPACES, " ")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like those given that no column of df has, whatever the case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def read(spark, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
