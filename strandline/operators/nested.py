"""Comparison of nested documents, leaf by leaf."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.sources import shared


_INFER = "spark.sql.variant.inferShreddingSchema"


def _kept(df: DataFrame, name: str) -> DataFrame:
    """shared.kept() of a table with values as they are: a schema inferred for them in each file took six times the writing."""
    conf = df.sparkSession.conf
    before = conf.get(_INFER, None)
    conf.set(_INFER, "false")
    try:
        return shared.kept(df, name)
    finally:
        conf.unset(_INFER) if before is None else conf.set(_INFER, before)


def leaves(documents: DataFrame, key: str, json: str, most_rounds: int = 200) -> DataFrame:
    """Leaves of JSON documents at any depth: key, path, kind (object, array, string, number, boolean, null), value (text; null of objects and arrays, which are leaves only where they are empty).

    Each round opens the values that are objects or arrays by one level, in the JVM, and writes them to the shared folder; a leaf leaves the rounds where it is found. There are as many rounds as the deepest document has levels; one deeper than most_rounds stops the job."""
    level = documents.select(F.col(key).alias("key"), F.lit("$").alias("path"), F.try_parse_json(json).alias("v"))
    kind = lambda v: F.schema_of_variant(v)
    out = None
    for _ in range(most_rounds):
        told = level.withColumn("s", F.when(F.col("v").isNull(), "VOID").otherwise(kind("v")))
        is_object, is_array = F.col("s").startswith("OBJECT"), F.col("s").startswith("ARRAY")
        held = F.when(is_object, F.size(F.variant_get("v", "$", "map<string,variant>"))).when(is_array, F.size(F.variant_get("v", "$", "array<variant>"))).otherwise(0)
        told = _kept(told.withColumn("held", held), "levels")
        found = told.where("held = 0").select(
            "key", "path",
            F.when(is_object, "object").when(is_array, "array").when(F.col("s") == "STRING", "string").when(F.col("s") == "BOOLEAN", "boolean").when(F.col("s") == "VOID", "null").otherwise("number").alias("kind"),
            F.when(~is_object & ~is_array, F.try_variant_get("v", "$", "string")).alias("value"),
        )
        out = found if out is None else out.unionByName(found)
        rest = told.where("held > 0")
        if not rest.limit(1).count():
            return out
        fields = rest.where(is_object).select("key", "path", F.explode(F.variant_get("v", "$", "map<string,variant>")).alias("name", "v")).select("key", F.concat("path", F.lit("."), _quoted(F.col("name"))).alias("path"), "v")
        items = rest.where(is_array).select("key", "path", F.posexplode(F.variant_get("v", "$", "array<variant>")).alias("at", "v")).select("key", F.concat("path", F.lit("["), F.col("at").cast("string"), F.lit("]")).alias("path"), "v")
        level = fields.unionByName(items)
    raise ValueError(f"documents of more than {most_rounds} levels")


def _quoted(name: Column) -> Column:
    return F.when(name.rlike(r"^[A-Za-z_]\w*$"), name).otherwise(F.concat(F.lit('"'), F.regexp_replace(name, '(["\\\\])', r"\\$1"), F.lit('"')))


def compared(one: DataFrame, other: DataFrame, rtol: float = 1e-9) -> DataFrame:
    """Leaves (key, path, kind, value) that differ between two sets of documents: key, path, difference, one, other. added, lost, retyped, close (numbers apart by no more than rtol of the larger), changed."""
    a, b = (t.select("key", "path", F.col("kind").alias(f"kind_{s}"), F.col("value").alias(s), F.lit(True).alias(f"in_{s}")) for t, s in ((one, "one"), (other, "other")))
    return a.join(b, ["key", "path"], "full").withColumn("difference", _what("in_one", "in_other", rtol)).where("difference is not null").select("key", "path", "difference", "one", "other")


def _what(in_one: str, in_other: str, rtol: float) -> Column:
    """How two leaves differ: kind_one, one, kind_other, other, and columns that are null where there is none."""
    x, y = F.col("one").try_cast("double"), F.col("other").try_cast("double")
    close = (F.col("kind_one") == "number") & (F.abs(x - y) <= rtol * F.greatest(F.abs(x), F.abs(y), F.lit(1e-300)))
    return (
        F.when(F.col(in_one).isNull(), "added").when(F.col(in_other).isNull(), "lost").when(F.col("kind_one") != F.col("kind_other"), "retyped")
        .when(~F.col("one").eqNullSafe(F.col("other")), F.when(close & (x != y), "close").when(~F.coalesce(close, F.lit(False)), "changed"))
    )


_SIDE = "struct<t:string,v:variant>"


def differences(one: DataFrame, other: DataFrame, key: str, json: str, rtol: float = 1e-9, most_rounds: int = 200) -> DataFrame:
    """compared() of the leaves of two sets of JSON documents (key, json), without tables of all leaves: key, path, difference, one, other.

    Documents meet by key once. Each round opens what differs by one level on both sides at once and leaves out values whose texts are equal, so what the rounds write grows with the differences. A leaf stands beside the other side's opened value at the same path. Where a key is repeated, each of its documents is held against each of the other set's; a null key meets none. One deeper than most_rounds stops the job."""
    text = lambda v: F.coalesce(F.to_json(v), F.lit("null"))
    v, doc = F.try_parse_json(json), F.col(json)
    kind = F.when(v.isNotNull() & doc.rlike(r"^\s*\{\s*[^\s}]"), "object").when(v.isNotNull() & doc.rlike(r"^\s*\[\s*[^\s\]]"), "array").otherwise("leaf")
    side = lambda t, s: t.select(F.col(key).alias("key"), v.alias(s), kind.alias(f"kind_{s}"))
    level = _opened(side(one, "a").join(side(other, "b"), "key", "full").withColumn("path", F.lit("$")), text)
    out = None
    for _ in range(most_rounds):
        told = _kept(_judged(level, rtol), "differences")
        found = told.where("difference is not null").select("key", "path", "difference", "one", "other")
        out = found if out is None else out.unionByName(found)
        rest = told.where("kind_a is not null or kind_b is not null")
        if not rest.limit(1).count():
            return out
        level = _opened(rest, text)
    raise ValueError(f"documents of more than {most_rounds} levels")


def _judged(level: DataFrame, rtol: float) -> DataFrame:
    """Values at a path (ta, tb: their texts, null where there is none; va, vb): difference where both are leaves; else a and b as values, with what they are. Each step is used by the next alone, so that none is worked out several times."""
    for s in "ab":
        first = F.substring(f"t{s}", 1, 1)
        level = level.withColumn(f"k{s}", F.when(first == "{", "object").when(first == "[", "array").when(first == '"', "string").when(first.isin("t", "f"), "boolean").when(first == "n", "null").when(F.col(f"t{s}").isNotNull(), "number"))
    level = level.withColumns({f"open_{s}": F.coalesce(F.col(f"k{s}").isin("object", "array") & (F.length(f"t{s}") > 2), F.lit(False)) for s in "ab"})
    level = level.withColumn("more", F.col("open_a") | F.col("open_b"))
    value = lambda s: F.when(~F.col("more") & ~F.col(f"k{s}").isin("object", "array"), F.try_variant_get(f"v{s}", "$", "string"))
    told = level.select(
        "key", "path", "more", F.col("ka").alias("kind_one"), value("a").alias("one"), F.col("kb").alias("kind_other"), value("b").alias("other"),
        *(F.when(F.col("more"), F.col(f"v{s}")).alias(s) for s in "ab"), *(F.when(F.col("more"), F.when(F.col(f"open_{s}"), F.col(f"k{s}")).when(F.col(f"k{s}").isNotNull(), "leaf")).alias(f"kind_{s}") for s in "ab"),
    )
    return told.select("key", "path", F.when(~F.col("more"), _what("kind_one", "kind_other", rtol)).alias("difference"), "one", "other", "a", "kind_a", "b", "kind_b")


def _opened(rest: DataFrame, text) -> DataFrame:
    """What stands one level below a and b and differs, side by side; a leaf beside an opened value stays at its path."""
    none = F.lit(None).cast(_SIDE)
    held = lambda v: F.struct(text(v).alias("t"), v.alias("v"))
    both = lambda step, a, b: F.struct(step.alias("step"), a.alias("a"), b.alias("b"))
    for s in "ab":
        rest = rest.withColumn(f"m{s}", F.when(F.col(f"kind_{s}") == "object", F.transform_values(F.try_variant_get(s, "$", "map<string,variant>"), lambda k, v: held(v))))
        rest = rest.withColumn(f"x{s}", F.when(F.col(f"kind_{s}") == "array", F.transform(F.try_variant_get(s, "$", "array<variant>"), held)))
        rest = rest.withColumn(f"leaf{s}", F.when(F.col(f"kind_{s}") == "leaf", held(F.col(s))))
    met = F.coalesce(
        F.map_zip_with("ma", "mb", lambda k, x, y: F.struct(x.alias("a"), y.alias("b"))),
        F.transform_values("ma", lambda k, x: F.struct(x.alias("a"), none.alias("b"))), F.transform_values("mb", lambda k, y: F.struct(none.alias("a"), y.alias("b"))),
    )
    row = F.coalesce(F.arrays_zip("xa", "xb"), F.transform("xa", lambda x: F.struct(x.alias("xa"), none.alias("xb"))), F.transform("xb", lambda y: F.struct(none.alias("xa"), y.alias("xb"))))
    fields = F.transform(F.map_entries(met), lambda e: both(F.concat(F.lit("."), _quoted(e["key"])), e["value"]["a"], e["value"]["b"]))
    items = F.transform(row, lambda z, i: both(F.concat(F.lit("["), i.cast("string"), F.lit("]")), z["xa"], z["xb"]))
    leaf = F.when(F.col("leafa").isNotNull() | F.col("leafb").isNotNull(), F.array(both(F.lit(""), F.col("leafa"), F.col("leafb"))))
    parts = [F.coalesce(p, F.array().cast(f"array<struct<step:string,a:{_SIDE},b:{_SIDE}>>")) for p in (leaf, fields, items)]
    below = rest.select("key", "path", F.explode(F.concat(*parts)).alias("c")).where(~F.col("c.a.t").eqNullSafe(F.col("c.b.t")))
    return below.select("key", F.concat("path", "c.step").alias("path"), *(F.col(f"c.{s}.{x}").alias(f"{x}{s}") for x in "tv" for s in "ab"))
