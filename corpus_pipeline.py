"""A corpus pipeline: quality rules, exact dedup, near-dedup, mixing to source weights, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as Parquet to the shared
folder and reads it again for the next stage. All but the last keep the columns of documents. Quality rules change
texts (lines that fail go) and drop documents; the dedup stages drop documents; mixing repeats documents and cuts one
a source short; the last stage gives each row's ids and their decoding.

Defined results: null and empty texts, and texts of fewer words than the quality rules ask for, go in the first stage;
rows with a null id are kept by all stages that their texts pass, copies of them by text as others; a null source is a
source; of rows that repeat an id and a text one stays, and of those that repeat an id alone one, too; columns besides
those named here are carried, whatever their names, up to the last stage. An empty table gives an empty result.
"""

from __future__ import annotations

from strandline.llm import bpe, exact_dedup, mixing, order_minhash, quality
from strandline.llm.catalog import tokenizer_path
from strandline.llm.ship import ship
from strandline.llm.store import forget, written
from strandline.llm.text import read


def quality_rules(spark, docs, sf_dir):
    return quality.keep_good(docs)


def drop_exact_copies(spark, docs, sf_dir):
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark, docs, sf_dir):
    ship(spark)
    return order_minhash.one_of_each(docs)


def mix_sources(spark, docs, sf_dir):
    return mixing.take(docs)


def encode(spark, docs, sf_dir):
    ship(spark)
    return bpe.round_trip(docs, tokenizer_path())


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", drop_exact_copies),
    ("order minhash near-dedup", drop_near_copies),
    ("mix sources", mix_sources),
    ("bpe", encode),
]

#: The near-dedup and BPE stages have no SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if k:
            forget(before)
    return STAGES[-1][1](spark, docs, sf_dir)
