"""Queries and oracle SQL of the corpus operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline.llm import bpe, divergence, exact_dedup, filter_audit, html_text, line_dedup, lm, mixing, oracle, order_minhash, quality, repair, substring, toxicity
from strandline.llm.ship import ship
from strandline.llm.store import scratch
from strandline.llm.text import read as _read


def read(spark, sf_dir, table):
    ship(spark)
    return _read(spark, sf_dir, table)


def op1_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(read(spark, sf_dir, "documents"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op2_repair_tokens(spark, sf_dir):
    file = scratch(spark, "tokens")
    repair.write(read(spark, sf_dir, "documents"), file, tokenizer_path(), end_id=2)
    return repair.read(spark, file, F.crc32).select(F.col("id").alias("doc_id"), "start", "n_tokens", F.col("ids").alias("ids_crc32"))


def op3_bpe_round_trip(spark, sf_dir):
    out = bpe.round_trip(read(spark, sf_dir, "documents"), tokenizer_path())
    ids = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return out.select("doc_id", "n_tokens", F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_substring_dedup(spark, sf_dir):
    out = substring.substring_dedup(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_order_minhash(spark, sf_dir):
    return order_minhash.near_dedup(read(spark, sf_dir, "documents"))


def op6_lm_scores(spark, sf_dir):
    return lm.lm_scores(read(spark, sf_dir, "documents"))


def op7_html_text(spark, sf_dir):
    return html_text.extract(read(spark, sf_dir, "pages"))


def op8_toxicity(spark, sf_dir):
    out = toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return out.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op9_quality_rules(spark, sf_dir):
    return quality.quality(read(spark, sf_dir, "documents"))


def op10_mix_sources(spark, sf_dir):
    return mixing.mixed(read(spark, sf_dir, "documents"))


def op11_source_divergence(spark, sf_dir):
    return divergence.source_divergence(read(spark, sf_dir, "documents"))


def op12_filter_audit(spark, sf_dir):
    return filter_audit.filter_audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")).withColumn("step", F.col("step").cast("int"))


def op13_line_dedup(spark, sf_dir):
    out = line_dedup.line_dedup(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def queries():
    return {f.__name__: f for f in (op1_exact_dedup, op2_repair_tokens, op3_bpe_round_trip, op4_substring_dedup, op5_order_minhash, op6_lm_scores, op7_html_text, op8_toxicity, op9_quality_rules, op10_mix_sources, op11_source_divergence, op12_filter_audit, op13_line_dedup)}


def oracle_sql():
    return {"op1_exact_dedup": oracle.EXACT, "op4_substring_dedup": oracle.SUBSTRING, "op9_quality_rules": oracle.QUALITY, "op11_source_divergence": oracle.DIVERGENCE, "op12_filter_audit": oracle.AUDIT, "op13_line_dedup": oracle.LINES}
