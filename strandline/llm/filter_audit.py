"""Filter interaction audit: what each of five filters removes, in every order that they can be applied in.

Words are exploded and aggregated by (document, word) and then by document, for each document's words and distinct
words. Texts are dealt by document before that, once, so both aggregations find their rows where they are and no row of
a word is ever shuffled. The other flags come from the text alone (upper-case share, special characters), or from the
smallest id among equal texts, found by a 128-bit hash that is combined before its shuffle. All are outer-joined by
document, with the labels. A document's five flags are a mask; one aggregation of 32 conditional counts for each part
(and as many for documents of good quality and for toxic ones) holds all that the orders need: what is left after some
filters is the sum over masks without their bits. The 120 orders are worked out from these counts, on one row a part.

Defined results: a null text is empty; a null part is the empty string; a row without an id comes after all others, so
it repeats any other text; rows that repeat an id and a text are counted one by one, and none of them repeats the other;
of several labels of an id the highest counts, a null one as 0; documents without a label are neither good nor toxic;
labels without a document count nowhere. An empty table has no parts and gives an empty result. Other columns play no
part, whatever their names.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm.store import written
from strandline.llm.text import SPACES, whole

FILTERS = "ABCDE"
LEAST_WORDS = 100
LEAST_DISTINCT_PERCENT = 80
MOST_UPPER_PERCENT = 10
SPECIAL = "#$%&*|"
MASKS = range(1 << len(FILTERS))


def word_counts(docs: DataFrame) -> DataFrame:
    """docs: id, x (hash of the text), text. For each (id, x): n_words, n_distinct of one such text."""
    words = docs.repartition("id", "x").select("id", "x", F.explode(F.concat(F.array(F.lit("")), F.array_remove(F.split("text", SPACES), ""))).alias("word"))
    by_word = words.groupBy("id", "x", "word").agg(F.count(F.lit(1)).alias("n"))
    # The empty word stands for the document: it tells how many rows are this same document.
    totals = by_word.groupBy("id", "x").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_distinct"), F.max(F.when(F.col("word") == "", F.col("n"))).alias("rows"))
    return totals.select("id", "x", F.expr("(n - rows) div rows").alias("n_words"), (F.col("n_distinct") - 1).alias("n_distinct"))


def flagged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """Per row of docs: id, part, the flags A to E, good, toxic."""
    text = whole(text_col)
    slim = docs.select(F.col(id_col).alias("id"), F.coalesce(part_col, F.lit("")).alias("part"), text.alias("text"))
    keyed = slim.withColumn("x", F.xxhash64("text"))
    upper = F.regexp_count("text", F.lit("[A-Z]"))
    plain = written(
        keyed.select(
            "id", "x", "part", F.unhex(F.md5("text")).alias("h"), (100 * upper > MOST_UPPER_PERCENT * F.char_length("text")).alias("C"),
            F.rlike("text", F.lit(f"[{SPECIAL}]")).alias("D"),
        ), "flags",
    )
    counts = written(word_counts(keyed.select("id", "x", "text")).select(F.col("id").alias("of"), F.col("x").alias("of_x"), "n_words", "n_distinct"), "word-counts")
    firsts = written(plain.groupBy("h").agg(F.min("id").alias("first")), "first-texts")
    marks = labels.groupBy(F.col(id_col).alias("labelled")).agg(F.max(F.expr("coalesce(quality = 1, false)")).alias("good"), F.max(F.expr("coalesce(toxic = 1, false)")).alias("toxic"))
    marks = written(marks.where("labelled IS NOT NULL"), "marks")
    rows = plain.join(counts, plain["id"].eqNullSafe(counts["of"]) & (plain["x"] == counts["of_x"]), "left").join(firsts, "h", "left").join(marks, F.col("id") == F.col("labelled"), "left")
    return rows.select(
        "id", "part",
        (F.col("n_words") < LEAST_WORDS).alias("A"),
        (100 * F.col("n_distinct") < LEAST_DISTINCT_PERCENT * F.col("n_words")).alias("B"),
        "C", "D",
        F.coalesce(F.col("first") < F.col("id"), F.col("id").isNull() & F.col("first").isNotNull()).alias("E"),
        F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"),
    )


def mask_counts(rows: DataFrame) -> DataFrame:
    """rows: part, A to E, good, toxic. A row a part: cells, an array of mask, n, good, toxic for each of the 32 masks."""
    mask = sum((F.col(c).cast("int") * (1 << i) for i, c in enumerate(FILTERS)), F.lit(0))
    counts = [F.count_if((F.col("mask") == m) & (F.lit(True) if c == "n" else F.col(c))).alias(f"{c}{m}") for m in MASKS for c in ("n", "good", "toxic")]
    cells = F.array(*(F.struct(F.lit(m).alias("mask"), *(F.col(f"{c}{m}").alias(c) for c in ("n", "good", "toxic"))) for m in MASKS))
    return rows.withColumn("mask", mask).groupBy("part").agg(*counts).select("part", cells.alias("cells"))


def _orders() -> Column:
    """An array of filter_order, step, own (bit of the step's filter), before (bits of the earlier ones)."""
    bit = {c: 1 << i for i, c in enumerate(FILTERS)}
    return F.array(*(
        F.struct(F.lit("".join(p)).alias("filter_order"), F.lit(k + 1).alias("step"), F.lit(bit[p[k]]).alias("own"), F.lit(sum(bit[c] for c in p[:k])).alias("before"))
        for p in permutations(FILTERS) for k in range(len(p))
    ))


def filter_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley (see the module)."""
    parts = mask_counts(flagged(docs, labels, id_col, text_col, part_col))
    rows = parts.select("part", "cells", F.explode(_orders()).alias("o")).select("part", "cells", "o.*")
    has = lambda c, bits: c["mask"].bitwiseAND(bits) != 0
    own, before = F.col("own"), F.col("before")

    def total(holds, value=lambda c: c["n"]) -> Column:
        return F.aggregate(F.filter("cells", holds), F.lit(0).cast("long"), lambda a, c: a + value(c))

    removed_here = lambda c: has(c, own) & ~has(c, before)
    orders_won = lambda c: F.expr(str(len(list(permutations(FILTERS))))).cast("long") / F.bit_count(c["mask"])  # noqa: E731  of all orders, those where a filter comes first among the mask's
    return rows.select(
        "part", "filter_order", "step",
        total(lambda c: ~has(c, before.bitwiseOR(own))).alias("kept"),
        total(removed_here).alias("removed"),
        total(lambda c: has(c, own) & has(c, before)).alias("redundant"),
        total(lambda c: c["mask"] == own).alias("unique_fails"),
        total(removed_here, lambda c: c["good"]).alias("good_lost"),
        total(removed_here, lambda c: c["toxic"]).alias("toxic_lost"),
        total(lambda c: has(c, own), lambda c: c["n"] * orders_won(c).cast("long")).alias("shapley"),
    )
