"""Line dedup: explode normalised lines, hash them, count distinct documents per hash, drop, and reassemble by position.

A line's key is the line without ASCII white space at its ends, A-Z lower-cased. Every line whose key has at least
LEAST_CHARS code points becomes one row (document, position, 128-bit hash of the key). These rows are written to the
shared folder once; the texts themselves do not travel with them. Hashes are counted in two steps, first by (hash,
document) and then by hash, each combined before its shuffle, so a line that a third of all documents hold is one row
a task at the second. A hash found in LEAST_DOCS documents or more loses all its lines but those in the document with
the smallest id. The join that tells which rows go has plain exchanges on both sides, so adaptive execution splits a
frequent line. Positions that go are gathered for each document, at most as many as it has lines, and a document's
other lines are joined again in their order; a document that loses nothing keeps its text as it is.

Defined results: a null or empty text is one empty line; rows of one id are the same document, so their lines do not
count twice and stay or go alike; rows without an id count as one document, which comes after all others and therefore
loses whatever another document holds; a document keeps all of its own repeated lines where it is the smallest holder.
An empty table gives an empty result. Other columns play no part, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm.store import written
from strandline.llm.text import let, whole

LEAST_CHARS = 10
LEAST_DOCS = 2
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = " \t\n\x0b\x0c\r"


def key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def keyed_lines(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """docs: id, text. A row for each line that counts: id, x (hash of the text), at (position from 0), h (hash of the key)."""
    lines = docs.select("id", F.xxhash64("text").alias("x"), F.posexplode(_lines(F.col("text"))).alias("at", "line"))
    return lines.select("id", "x", "at", key(F.col("line")).alias("key")).where(F.char_length("key") >= least_chars).select("id", "x", "at", F.unhex(F.md5("key")).alias("h"))


def shared_keys(lines: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """h, first, n_docs of each key found in least_docs documents or more: the smallest id that holds it, and how many do."""
    by_document = lines.groupBy("h", "id").agg(F.lit(1).alias("one"))
    return by_document.groupBy("h").agg(F.min("id").alias("first"), F.count("one").alias("n_docs")).where(F.col("n_docs") >= least_docs)


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """Per row of docs: id, n_lines, n_dropped, kept_text (see the module)."""
    slim = docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text"))
    lines = written(keyed_lines(slim, least_chars), "lines")
    shared = written(shared_keys(lines, least_docs), "shared-lines")
    gone = lines.join(shared, "h").where(~F.col("id").eqNullSafe(F.col("first"))).groupBy("id", "x").agg(F.collect_set("at").alias("gone"))
    gone = written(gone.select(F.col("id").alias("of"), F.col("x").alias("of_x"), "gone"), "dropped-lines")
    rows = slim.withColumn("x", F.xxhash64("text"))
    rows = rows.join(gone, rows["id"].eqNullSafe(gone["of"]) & (rows["x"] == gone["of_x"]), "left")

    def rest(all_lines: Column) -> Column:
        stay = F.array_except(F.transform(all_lines, lambda _, i: i), "gone")
        return F.array_join(F.transform(stay, lambda i: F.get(all_lines, i)), "\n")

    return rows.select(
        F.col("id").alias(id_col),
        F.size(_lines(F.col("text"))).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(let(_lines(F.col("text")), rest)).alias("kept_text"),
    )
