"""The queries of operators without SQL, whole, against the library and plain Python; the pipeline on odd rows."""

import hashlib
import random
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandline.llm import bpe, catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def plain():
    t = bpe.tokenizer(catalog.tokenizer_path())
    return t, lambda x: t.encode(x, add_special_tokens=False).ids


def test_words_are_encoded_as_the_library_does(plain):
    """Words of letters, signs, marks, digits and other alphabets at random, many of which only look like those that are encoded together."""
    rng = random.Random(3)
    chars = "abcABC éÉßäÖñ.,;:!?'’-0١ⅣⁿªﬁİıΣσςǅ中语áͅK‍﻿‿<|>".replace(" ", "")
    words = {"".join(rng.choice(chars) for _ in range(rng.randint(1, 6))) for _ in range(40000)} | {"Don't", "DOG'S,", "<|endoftext|>", "<|ENDOFTEXT|>", "a.", ".", "..", "x,,"}
    words = sorted(w for w in words if w.split() == [w])
    n, ids = bpe.encoded(catalog.tokenizer_path(), pa.array(words, pa.large_string()))
    at = 0
    for w, k in zip(words, n.tolist()):
        assert ids[at : at + k].tolist() == plain[1](w), repr(w)
        at += k
    assert at == len(ids)


def test_op2_query(spark, texts, plain):
    start = 0
    got = {r["doc_id"]: r for r in catalog.op2_repair_tokens(spark, SF).collect()}
    assert len(got) == len(texts)
    for d in sorted(texts):
        ids = [*plain[1](texts[d]), 2]
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        assert (got[d]["start"], got[d]["n_tokens"], got[d]["ids_crc32"]) == (start, len(ids), zlib.crc32(raw))
        start += len(ids)


def test_op3_query(spark, texts, plain):
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    got = {r["doc_id"]: r for r in catalog.op3_bpe_round_trip(spark, SF).collect()}
    assert len(got) == len(texts)
    for d, text in texts.items():
        ids = plain[1](text)
        assert (got[d]["n_tokens"], got[d]["ids_sha256"], got[d]["decoded_sha256"]) == (len(ids), digest(" ".join(map(str, ids))), digest(plain[0].decode(ids, skip_special_tokens=False)))


def test_op8_query(spark, texts):
    got = catalog.op8_toxicity(spark, SF).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    assert all(r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)


def test_pipeline_odd_rows(spark, tmp_path):
    import corpus_pipeline as p

    rng = random.Random(9)
    prose = lambda k: ". ".join(" ".join(rng.choice("river stone green light walks seven under early paper music".split()) + rng.choice("abcdefgh") for _ in range(12)) for _ in range(k)) + "."
    a, b, long = prose(9), prose(9), prose(2000)
    rows = [(1, a, "en", "s", 9), (2, a.replace(" ", "\t"), "en", "s", 9), (3, a, "de", "t", 9), (3, a, "de", "t", 9), (4, None, None, None, None), (5, "", "en", "s", 0), (6, "too short", "en", "s", 9), (7, b, "en", None, 9), (None, prose(9), "en", "s", None), (8, long, "en", "s", 9), (9, b + " more", "fr", "t", 9)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for name, own in (("odd", rows), ("empty", [])):
        df = spark.createDataFrame(own, schema).withColumns({c: F.lit(7) for c in ("key", "block", "copy", "kept", "n", "id")})
        df.write.parquet(str(tmp_path / name / "documents.parquet"))
        got = p.run(spark, str(tmp_path / name)).collect()
        ids = {r["doc_id"] for r in got}
        assert ids == ({1, 7, None, 8} if own else set())
        t = bpe.tokenizer(catalog.tokenizer_path())
        assert all(r["decoded"] == t.decode(r["ids"], skip_special_tokens=False) and r["n_tokens"] == len(r["ids"]) for r in got)


def test_waves_of_blocks_give_the_same(spark, monkeypatch):
    from strandline.llm import blocks

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    once = {r["doc_id"]: r["ids"] for r in bpe.round_trip(docs, catalog.tokenizer_path()).collect()}
    monkeypatch.setattr(blocks, "WAVE", 2)
    real = blocks.counts
    monkeypatch.setattr(blocks, "counts", lambda *a, **k: real(*a, **{**k, "block_bytes": 100_000}))
    assert {r["doc_id"]: r["ids"] for r in bpe.round_trip(docs, catalog.tokenizer_path()).collect()} == once


def test_op6_odd_rows(spark):
    """Counts and base scores of null, empty, long, repeated and clashing rows, by their definition; the model's score is a probability."""
    import collections
    import math
    import re

    from strandline.llm import lm

    long = " ".join(f"w{i % 97}" for i in range(5000))
    rows = [(1, "one Two  three"), (2, None), (3, ""), (4, " \t\n"), (5, long), (5, long), (None, "one two"), (6, "ÉTÉ été\x85x"), (7, "one"), (8, "unseen words"), (20, "two three")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("block", "bin", "n", "train", "id", "payload")})
    lower = lambda w: re.sub("[A-Z]", lambda m: m[0].lower(), w)
    tokens = lambda t: [lower(w) for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")] + [None]
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0
    count = collections.Counter(w for d, t in rows if not held(d) for w in tokens(t))
    n, v = sum(count.values()), len(count)
    want = collections.Counter((d, held(d), len(tokens(t)), sum(count[w] > 0 for w in tokens(t)), n, round(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(t)), 6)) for d, t in rows)
    got = lm.lm_scores(df).collect()
    assert collections.Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)
    assert lm.lm_scores(df.where("1 = 0")).count() == 0
