"""Mixing sources to target weights, with DataFrame functions only.

Sources in code point order, null last, take the weights 5, 2, 1 in turn and share ``share`` times all words. A target
stops at ``epochs`` times its source's words; what is above goes to the others by weight until none is above, which is
the level x with sum(min(cap, x * weight)) = total, found from running sums over the sources in order of cap / weight.

Each document gets a hash-random key, of its source, id and text. The key's leading bits deal a source's documents into
buckets in the order of keys, of equal expected size and about BUCKET_ROWS rows where the table is large, so a source
that holds a third of all rows, or rows without an id, are spread over as many tasks as any others. Words are summed by
(source, bucket), and running sums of these give each bucket's start: a distributed prefix sum. A source takes whole
epochs first; in the last one the cut falls at the exact word of its budget. Buckets that end before the cut are taken
whole and those behind it not at all, so their documents are neither sorted nor moved; in the one bucket of a source that
the cut falls into, rows are sorted by key and summed up, and one document is taken in part, from its beginning.

The table of sources passes through one task: it has a row for each source. A source's buckets meet in one task, a row
for BUCKET_ROWS rows of the table or fewer; this table is written once, and Spark broadcasts it only below its size threshold.

Defined results: a null text has size 0 and takes nothing; a null or empty source is a source of its own; a null id
is hashed as any other; repeated rows are taken one by one, in any order, as they are alike;
where all sizes are 0 all targets are 0. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.store import written
from strandline.llm.text import fresh, n_words, whole, words

WEIGHTS = (5, 2, 1)
LEAST_BUCKET_BITS = 10
BUCKET_ROWS = 100_000


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, epochs: int = 2) -> DataFrame:
    """sizes: source, source_size, a row for each source; adds target (double)."""
    by_name, all_rows = Window.orderBy(F.col("source").asc_nulls_last()), Window.partitionBy(F.lit(1))
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1)
    left = F.lit(share) * F.sum("source_size").over(all_rows) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    level = left / (F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    return (
        sizes.withColumn("weight", weight.cast("double"))
        .withColumn("cap", F.lit(epochs) * F.col("source_size"))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("level", level)
        .withColumn("level", F.coalesce(F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "source", "level"))).over(all_rows)["level"], F.max("ratio").over(all_rows)))
        .select("source", "source_size", F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")).alias("target"))
    )


def mix_plan(docs: DataFrame, size: Column, id_col: str = "doc_id", source_col: str = "source", mark: Column | None = None, seed: int = 20240601, **shares) -> DataFrame:
    """docs with five more columns, named by PLAN (with underscores in front where docs has such a name). mark: a hash of the text."""
    names = plan_names(docs)
    n, whole_size, target, epochs, part = names
    null, src, bucket, key, start, words_in, cut = fresh(docs, "src_null", "src", "bucket", "key", "start", "words_in", "cut")
    bits = max(LEAST_BUCKET_BITS, (docs.count() // BUCKET_ROWS).bit_length())
    keyed = docs.withColumns({
        n: size, null: F.col(source_col).isNull(), src: F.coalesce(source_col, F.lit("")),
        key: F.xxhash64(F.lit(seed), F.col(source_col), F.col(id_col), F.xxhash64(whole("text")) if mark is None else mark),
    }).withColumn(bucket, F.shiftrightunsigned(key, 64 - bits))
    sums = keyed.groupBy(null, src, bucket).agg(F.sum(n).alias(words_in))
    before = Window.partitionBy(null, src).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn(start, F.coalesce(F.sum(words_in).over(before), F.lit(0)))
    sources = targets(sums.groupBy(null, src).agg(F.sum(words_in).alias("source_size")).select(F.when(~F.col(null), F.col(src)).alias("source"), "source_size"), **shares)
    sources = sources.select(F.col("source").isNull().alias(null), F.coalesce("source", F.lit("")).alias(src), F.col("source_size").alias(whole_size), F.col("target").alias(target))
    budget = F.floor(F.col(target) + 0.5)
    full = F.when(F.col(whole_size) > 0, F.floor(budget / F.col(whole_size))).otherwise(F.lit(0)).cast("long")
    buckets = starts.join(sources, [null, src]).withColumn(epochs, full).withColumn(start, budget - F.col(epochs) * F.col(whole_size) - F.col(start))
    buckets = buckets.withColumn(cut, (F.col(start) > 0) & (F.col(start) < F.col(words_in)))  # start: words that the last epoch takes from here on
    placed = keyed.join(written(buckets.select(null, src, bucket, whole_size, target, epochs, start, cut), "mix-buckets"), [null, src, bucket])
    most = lambda left: F.greatest(F.lit(0), F.least(F.col(n), left)).cast("long")
    alike = placed.where(~F.col(cut)).withColumn(part, F.when(F.col(start) > 0, F.col(n)).otherwise(F.lit(0)).cast("long"))
    inside = F.coalesce(F.sum(n).over(Window.partitionBy(null, src, bucket).orderBy(key, id_col, n).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    split = placed.where(F.col(cut)).withColumn(part, most(F.col(start) - inside))
    return alike.select(*docs.columns, *names).union(split.select(*docs.columns, *names))


#: Words of the document, words of its source, its source's target, whole copies taken, words taken of one copy more.
PLAN = ("size", "source_size", "target", "epochs", "part")


def plan_names(docs: DataFrame) -> list[str]:
    return fresh(docs, *PLAN)


def mixed(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **shares) -> DataFrame:
    """Per row of docs: id, size, source_size, target, taken (see the module)."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    slim = written(slim.select("id", "source", n_words("text").alias("n"), F.xxhash64(whole("text")).alias("mark")), "sizes")
    taken = F.col("epochs") * F.col("size") + F.col("part")
    return mix_plan(slim, F.col("n"), "id", "source", F.col("mark"), **shares).select(F.col("id").alias(id_col), "size", "source_size", "target", taken.alias("taken"))


def take(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **shares) -> DataFrame:
    """The mix itself, in docs' columns: a row for each copy taken; a part holds the document's first words."""
    plan = mix_plan(docs, n_words(text_col), id_col, source_col, F.xxhash64(whole(text_col)), **shares)
    _, _, _, epochs, part = plan_names(docs)
    copy = fresh(plan, "copy")[0]
    cut = F.array_join(F.slice(words(text_col), 1, F.col(part).cast("int")), " ")
    cut_short = (F.col(copy) == 0) & (F.col(part) < n_words(text_col))
    return (
        plan.where(F.col(epochs) + F.col(part) > 0)
        .withColumn(copy, F.explode(F.sequence(F.when(F.col(part) > 0, F.lit(0)).otherwise(F.lit(1)).cast("long"), F.col(epochs))))
        .withColumn(text_col, F.when(cut_short, cut).otherwise(F.col(text_col)))
        .select(*docs.columns)
    )
