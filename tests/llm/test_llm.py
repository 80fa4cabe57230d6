"""The corpus operators on small tables: against brute force, by exact round trips, by held-out accuracy, and on odd rows."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.llm import bpe, catalog, components, exact_dedup, html_text, lm, mixing, order_minhash, quality, repair, store, substring, toxicity
from strandline.llm.hashing import windows, word_hashes

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 997}" for i in range(60000))
ODD = [
    (1, "one two  three", "en", "a", 14), (2, "one\ttwo three", "en", "a", 13), (3, "one two three", "en", "b", 13), (4, None, "en", None, None), (5, "", None, "", 0),
    (6, "   \n\t ", "xx", "b", 5), (7, LONG, "en", "b", len(LONG)), (None, "one two three", "en", "a", 13), (3, "one two three", "en", "b", 13), (8, "<|endoftext|> ΣΣ ́é x\u0085y z", "en", None, 20),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, and columns that clash with names used inside."""
    return spark.createDataFrame(ODD, SCHEMA).withColumns({c: F.lit(7) for c in ("h", "sha", "n", "block", "bin", "size", "key", "kept", "id", "t", "bands", "class_id", "target", "bucket", "part", "epochs", "n_words", "copy", "ids")})


@pytest.fixture(scope="module")
def empty(odd):
    return odd.where("1 = 0")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def words(text):
    return WORD.findall(text or "")


def by_id(df, id_col="doc_id"):
    return {r[id_col]: r for r in df.collect()}


# --- exact dedup


def test_exact_dedup_odd(odd, empty):
    got = sorted(((r["doc_id"] or 0, r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_dedup(odd).collect()))
    same = [(0, 1, 5, False), (1, 1, 5, True), (2, 1, 5, False), (3, 1, 5, False), (3, 1, 5, False)]
    assert got == sorted([*same, (4, 4, 2, True), (5, 4, 2, False), (6, 6, 1, True), (7, 7, 1, True), (8, 8, 1, True)])
    assert sorted(r["doc_id"] for r in exact_dedup.drop_copies(odd).collect()) == [1, 4, 6, 7, 8]
    assert exact_dedup.drop_copies(odd).columns == odd.columns
    assert exact_dedup.exact_dedup(empty).count() == exact_dedup.drop_copies(empty).count() == 0


def test_exact_dedup_repeated_rows(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (None, "y"), (None, "y")], "doc_id long, text string")
    assert sorted((str(r["doc_id"]), r["kept"], r["group_size"]) for r in exact_dedup.exact_dedup(df).collect()) == [("1", True, 2), ("1", True, 2), ("None", True, 2), ("None", True, 2)]
    assert sorted(r["text"] for r in exact_dedup.drop_copies(df).collect()) == ["x", "y"]


# --- quality rules


def repeated(text):
    w = words(text)
    seen = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    return len({j for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)})


def test_quality_odd(odd, empty):
    got = [(r["doc_id"], r["n_words"], r["n_repeat_words"], r["base_failed"], r["kept"]) for r in quality.quality(odd).where("doc_id in (4, 5, 6, 7)").orderBy("doc_id").collect()]
    assert got == [(4, 0, 0, True, False), (5, 0, 0, True, False), (6, 0, 0, True, False), (7, 60000, 60000, True, False)]
    assert quality.keep_good(odd).columns == odd.columns
    assert quality.quality(empty).count() == quality.keep_good(empty).count() == 0


def test_quality_measures(docs):
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for d, r in by_id(quality.quality(docs)).items():
        w, lines = words(text[d]), [x for x in text[d].split("\n") if words(x)]
        assert (r["n_words"], r["word_chars"], r["n_symbols"]) == (len(w), sum(map(len, w)), sum(text[d].count(c) for c in "#*$%&|<>"))
        assert (r["n_dup_lines"], r["n_repeat_words"]) == (len(lines) - len(set(lines)), repeated(text[d]))


def test_quality_lines(spark):
    rng = random.Random(4)
    good = "\n".join(" ".join(rng.choice(("river", "stone", "green", "light", "walks", "seven", "under", "early", "paper", "music")) + rng.choice("abcdefgh") for _ in range(14)) + "." for _ in range(9))
    cases = {1: good, 2: good + "\nHome | About | Contact | Help |\nAll rights reserved.\nNo end", 3: "\n".join(f"a{i} | b{i} | c{i} | d{i} |" for i in range(20)), 4: "\n".join(f"w{i}%%% x{i}$$$ y{i}### z{i}" for i in range(20)), 5: good + "\n" + "no " * 12}
    df = spark.createDataFrame(list(cases.items()), "doc_id long, text string")
    assert {d: r["kept"] for d, r in by_id(quality.quality(df)).items()} == {1: True, 2: True, 3: False, 4: False, 5: True}
    clean = {r["doc_id"]: r["text"] for r in quality.keep_good(df).collect()}
    assert clean == {1: good, 2: good, 5: good}


# --- mixing


def reshared(sizes, weights=(5, 2, 1), share=1.5):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, capped = share * sum(sizes.values()), set()
    while True:
        left = total - sum(2 * sizes[s] for s in capped)
        w = sum(weight[s] for s in names if s not in capped)
        out = {s: 2 * sizes[s] if s in capped else left * weight[s] / w for s in names}
        above = {s for s in names if s not in capped and out[s] > 2 * sizes[s]}
        if not above:
            return out
        capped |= above


def test_mixing_odd(odd, empty):
    got = mixing.mixed(odd).collect()
    sizes = collections.Counter()
    for _, t, _, s, _ in ODD:
        sizes[s] += len(words(t))
    want = reshared(sizes)
    assert len(got) == len(ODD)
    source = {1: "a", 2: "a", 4: None, 5: "", 6: "b", 7: "b", 8: None}
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        if r["doc_id"] in source:
            assert r["target"] == pytest.approx(want[source[r["doc_id"]]]) and r["source_size"] == sizes[source[r["doc_id"]]]
    assert sorted(map(str, got)) == sorted(map(str, mixing.mixed(odd.repartition(5)).collect()))
    assert mixing.mixed(empty).count() == mixing.take(empty).count() == 0
    assert mixing.take(odd).columns == odd.columns


def test_mixing_cuts_at_budget(docs):
    rows = mixing.mixed(docs).collect()
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    taken, sizes, target = collections.Counter(), collections.Counter(), {}
    for r in rows:
        taken[source[r["doc_id"]]] += r["taken"]
        sizes[source[r["doc_id"]]] += r["size"]
        target[source[r["doc_id"]]] = r["target"]
    want = reshared(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s]) and taken[s] == math.floor(target[s] + 0.5)
    mix = collections.Counter()
    for r in mixing.take(docs).collect():
        mix[r["doc_id"]] += len(words(r["text"]))
    assert mix == {r["doc_id"]: r["taken"] for r in rows if r["taken"]}


# --- tokens


def test_hashes_match_words():
    import pyarrow as pa

    texts = ["a b  c", "", " c\nb\x0ba ", "b", "ab c"]
    h, at = word_hashes(pa.array(texts))
    flat = [w for t in texts for w in words(t)]
    assert at.tolist() == [0, 3, 3, 6, 7, 9] and len(h) == len(flat)
    assert len({(w, int(x)) for w, x in zip(flat, h)}) == len(set(flat)) == len(set(h.tolist()))
    lower, _ = word_hashes(pa.array(["ABc", "É"]), lower=True)
    plain, _ = word_hashes(pa.array(["abc", "É"]))
    assert lower.tolist() == plain.tolist()
    w, i = windows(h, at, 2)
    assert i.tolist() == [0, 1, 3, 4, 7] and len(set(w.tolist())) == 5


def test_bpe_round_trip(odd, docs, empty):
    t = bpe.tokenizer(catalog.tokenizer_path())
    for df in (odd, docs):
        want = collections.Counter()
        for r in df.select("doc_id", "text").collect():
            ids = t.encode(r["text"] or "", add_special_tokens=False).ids
            want[(r["doc_id"], tuple(ids), t.decode(ids, skip_special_tokens=False))] += 1
        got = bpe.round_trip(df, catalog.tokenizer_path()).collect()
        assert collections.Counter((r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in got) == want
        assert all(r["n_tokens"] == len(r["ids"]) for r in got)
    assert bpe.round_trip(empty, catalog.tokenizer_path()).count() == 0


def test_repair_file(spark, odd, docs, empty):
    t = bpe.tokenizer(catalog.tokenizer_path())
    for df in (odd, docs):
        file = store.scratch(spark, "file")
        repair.write(df, file, catalog.tokenizer_path(), 2)
        got = sorted(repair.read(spark, file).collect(), key=lambda r: r["start"])
        rows = sorted(df.select("doc_id", "text").collect(), key=lambda r: -1 if r["doc_id"] is None else r["doc_id"])
        at = 0
        for r, x in zip(got, rows, strict=True):
            ids = [*t.encode(x["text"] or "", add_special_tokens=False).ids, 2]
            assert (r["id"], r["start"], r["n_tokens"]) == (x["doc_id"], at, len(ids))
            assert np.frombuffer(r["ids"], "<u4").tolist() == ids
            at += len(ids)
    repair.write(empty, file := store.scratch(spark, "file"), catalog.tokenizer_path(), 2)
    assert repair.read(spark, file).count() == 0


def test_repair_random_access():
    rng = random.Random(5)
    for _ in range(20):
        docs = [[rng.randrange(4) for _ in range(rng.randrange(60))] for _ in range(rng.randrange(1, 9))] + [[1] * 50]
        ids, ends = np.array([x for d in docs for x in d]), np.cumsum([len(d) for d in docs])
        s = repair.Shard(repair.to_payload(np.arange(len(docs)), ids, ends, 4, least=2, rounds=rng.randrange(8)))
        assert [s.document(k).tolist() for k in range(len(docs))] == docs
        assert s.sizes().tolist() == [len(d) for d in docs] and s.n_ids == len(ids)


# --- substring dedup


def removed(rows, k):
    first = {}
    for d, t in sorted(((math.inf if d is None else d, t) for d, t in rows), key=lambda x: x[0]):
        w = words(t)
        for i in range(len(w) - k + 1):
            first.setdefault(tuple(w[i : i + k]), d)
    out = collections.Counter()
    for d, t in rows:
        w, own = words(t), math.inf if d is None else d
        gone = {j for i in range(len(w) - k + 1) if first[tuple(w[i : i + k])] < own for j in range(i, i + k)}
        out[(d, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone))] += 1
    return out


@pytest.mark.parametrize("group", [3, 1000])
def test_substring(spark, odd, empty, group):
    rng = random.Random(group)
    rows = [(rng.randrange(40), " ".join(rng.choice("abc") for _ in range(rng.randrange(30)))) for _ in range(60)] + [(None, "a b c a b c"), (None, "a b c a b c"), (99, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = substring.substring_dedup(df, length=4, group=group).collect()
    assert collections.Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in got) == removed(rows, 4)
    assert all(sum(b - a for a, b in zip(r["span_start"], r["span_end"])) == r["n_removed"] for r in got)
    got = substring.substring_dedup(odd).collect()
    assert collections.Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in got) == removed([x[:2] for x in ODD], 13)
    assert substring.substring_dedup(empty).count() == 0


# --- near-dedup


def shingles(t):
    w = words(t)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def test_edits_match_dynamic_programme():
    rng = random.Random(3)
    for _ in range(200):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(14))] for _ in range(2))
        r = list(range(len(b) + 1))
        for i, x in enumerate(a):
            n = [i + 1]
            for j, y in enumerate(b):
                n.append(min(r[j] + (x != y), r[j + 1] + 1, n[-1] + 1))
            r = n
        most = rng.randrange(14)
        assert order_minhash.edits(np.array(a, np.uint64), np.array(b, np.uint64), most) == min(r[-1], most + 1)


def test_near_classes_match_brute_force(docs):
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    sets, parent = {d: shingles(t) for d, t in rows.items()}, {d: d for d in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(rows), 2):
        both = len(sets[a] & sets[b])
        if words(rows[a]) == words(rows[b]) or (both and both >= 0.8 * len(sets[a] | sets[b])):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = by_id(order_minhash.near_dedup(docs))
    assert {d: r["class_id"] for d, r in got.items()} == {d: find(d) for d in rows}
    assert sorted(r["doc_id"] for r in order_minhash.one_of_each(docs).collect()) == sorted({find(d) for d in rows})


def test_near_odd(spark, odd, empty):
    got = sorted(((r["doc_id"] or 0, r["class_id"], r["class_size"], r["kept"]) for r in order_minhash.near_dedup(odd).collect()), key=str)
    assert got == sorted([(0, None, 1, True), (1, 1, 3, True), (2, 1, 3, False), (3, 1, 3, False), (3, 1, 3, False), (4, 4, 3, True), (5, 4, 3, False), (6, 4, 3, False), (7, 7, 1, True), (8, 8, 1, True)], key=str)
    assert sorted(str(r["doc_id"]) for r in order_minhash.one_of_each(odd).collect()) == ["1", "4", "7", "8", "None"]
    assert order_minhash.near_dedup(empty).count() == order_minhash.one_of_each(empty).count() == 0
    text = " ".join(f"v{i}" for i in range(400)).split()
    moved = text[200:] + text[:200]
    df = spark.createDataFrame([(1, " ".join(text)), (2, " ".join(text[:200] + ["x"] + text[200:])), (3, " ".join(moved))], "doc_id long, text string")
    assert {d: r["class_id"] for d, r in by_id(order_minhash.near_dedup(df)).items()} == {1: 1, 2: 1, 3: 3}


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(100, 140)] + [(7, 9), (9, 8), (5, 5)], "a long, b long")
    got = dict(components.components(links).collect())
    assert got == {**{i: 100 for i in range(100, 141)}, 7: 7, 8: 7, 9: 7}


# --- language model


def test_lm(spark, docs, odd, empty):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    toks = {r["doc_id"]: [*words((r["text"] or "").translate(lower)), None] for r in docs.collect()}
    held = {d: zlib.crc32(str(d).encode()) % 10 == 0 for d in toks}
    count = collections.Counter(w for d in toks if not held[d] for w in toks[d])
    n, v = sum(count.values()), len(count)
    got = by_id(lm.lm_scores(docs))
    for d, r in got.items():
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[d], len(toks[d]), sum(w in count for w in toks[d]), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in toks[d]))
    out = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)
    assert all(r["score"] < 0 for r in got.values())
    assert sorted(r["n_tokens"] for r in lm.lm_scores(odd).collect()) == sorted(len(words(x[1])) + 1 for x in ODD)
    assert lm.lm_scores(empty).count() == 0


def test_lm_weights_sum_to_one_and_estimates_are_exact(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["a b a b c", "a b c", "b c a", "c c"] * 5)], "doc_id long, text string")
    docs = {r["doc_id"]: ["<", "<", *r["text"].split(), ">"] for r in df.collect()}
    train = [t for d, t in docs.items() if zlib.crc32(str(d).encode()) % 10]
    uni = collections.Counter(w for t in train for w in t[2:])
    bi = collections.Counter(p for t in train for p in zip(t[1:], t[2:]))
    tri = collections.Counter(p for t in train for p in zip(t, t[1:], t[2:]))
    got = by_id(lm.lm_scores(df))
    n, d = sum(uni.values()), len(train)
    bits = lambda k, top: min(int(k).bit_length(), top - 1)

    def parts(t, i, less):
        c1, c2 = d if t[i - 1] == "<" else uni[t[i - 1]], d if t[i - 1] == "<" else bi[(t[i - 2], t[i - 1])]
        p = [(c - less) / (k - less) if k > less else 0.0 for c, k in ((uni[t[i]], n), (bi[(t[i - 1], t[i])], c1), (tri[(t[i - 2], t[i - 1], t[i])], c2))]
        return p, bits(max(c2 - less, 0), lm.BUCKETS[0]) * lm.BUCKETS[1] + bits(max(c1 - less, 0), lm.BUCKETS[1])

    seen = collections.defaultdict(list)
    for t in train:
        for i in range(2, len(t)):
            p, b = parts(t, i, 1)
            step = lm._step(np.array(p))
            seen[(b, *step.tolist())].append(p)
    keys = list(seen)
    w = lm.weights(np.array([k[0] for k in keys]), np.array([len(seen[k]) for k in keys], float), np.array([np.mean(seen[k], axis=0) for k in keys]), 1 / (len(uni) + 1))
    assert w.sum(1) == pytest.approx(1)
    for doc, t in docs.items():
        total = 0.0
        for i in range(2, len(t)):
            p, b = parts(t, i, 0)
            total += math.log10(w[b, 0] / (len(uni) + 1) + sum(x * y for x, y in zip(w[b, 1:], p)))
        assert got[doc]["score"] == pytest.approx(total)


# --- toxicity


def plain_kernel(s, t, p=3, d=toxicity.DECAY):
    out = 0.0
    for a in itertools.combinations(range(len(s)), p):
        for b in itertools.combinations(range(len(t)), p):
            if all(s[i] == t[j] for i, j in zip(a, b)):
                out += d ** (a[-1] - a[0] + 1 + b[-1] - b[0] + 1)
    return out


def plain_similarity(s, t):
    return (plain_kernel(s, t) / max(1e-30, plain_kernel(s, s) * plain_kernel(t, t)) ** 0.5) ** toxicity.POWER


def test_kernel_by_definition():
    marks = ["idiot", "moron", "scum", "abcabc", "crétin"]
    words = ["idiiot", "trsah", "cabcab", "xyz", "idio", "oron", "umb", "moon", "idit", "idiotidiotidiot", "crétin", "cr", "", "q" * 9 + "scum", "moron" * 6, "scumabcidiot" * 3]
    got = toxicity.Landmarks(marks).similarities(words)
    for i, w in enumerate(words):
        assert got[i] == pytest.approx([plain_similarity(w, m) for m in marks] if len(w) < 20 else got[i], rel=1e-3, abs=1e-6)
    for w in words:  # the running sums of long words and the listed subsequences of short ones are one kernel
        if len(w) > 2:
            f = toxicity.running(toxicity.classes([w])[0])
            assert (f * f).sum() == pytest.approx(float(toxicity.self_kernel(toxicity.classes([w]))[0]), rel=1e-3)
    assert got[words.index("moron" * 6)][1] > 0.1 and all(got[words.index(w)].max() > 0.05 for w in ("idio", "oron", "idit", "moon"))


def test_toxicity_margins_by_definition():
    texts = ["you idiot. fine day here", "what a moron\nreally", "i d i o t! nice", "good day to you. sun", "rain and wind", "clear sky at noon"] * 12
    labels = np.array([1, 1, 1, 0, 0, 0] * 12)
    model = toxicity.Model(["idiot", "moron"], 0.5)
    model.fit(toxicity.witnesses(texts, model.landmarks), labels)
    asked = ["", "an idxiot here. and sun", "The MORON, the moron. no idiot", "wind\nrain idio", "i d i o t"]
    for text, margin in zip(asked, model.margins(asked)):
        sums = [sum(sum(beta * plain_similarity(w, m) for m, beta in zip(model.landmarks.words, model.beta)) for w in {toxicity.letters(w) for w in s}) for s in toxicity.sentences(text)]
        assert margin == pytest.approx(max(sums, default=0) + model.b, rel=1e-3, abs=1e-5)


def test_toxicity_held_out(spark, odd, empty):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    out = toxicity.toxicity(docs, labels).join(labels, "doc_id").where("held_out").collect()
    hit = sum(r["score"] >= 0.3 and r["toxic"] == 1 for r in out)
    assert hit >= 0.6 * sum(r["toxic"] for r in out) and sum(r["score"] >= 0.3 for r in out) <= 2 * hit
    none = labels.where("1 = 0")
    assert toxicity.toxicity(empty, labels).count() == 0
    fitted = toxicity.toxicity(odd.unionByName(docs.withColumn("doc_id", F.col("doc_id") + 1000), allowMissingColumns=True), labels.withColumn("doc_id", F.col("doc_id") + 1000)).where("doc_id is null or doc_id < 1000").collect()
    assert len(fitted) == odd.count() and all(0 <= r["score"] < 0.3 for r in fitted)
    assert {r["score"] for r in toxicity.toxicity(odd, none).collect()} == {0.0}


def test_toxicity_tolerates_inserted_characters(spark):
    plain = "the quick report about weather and music in town was long number"
    rows = [(i, f"{plain} {i} " + ("you idiot" if i % 4 == 0 else "you stupid man" if i % 4 == 1 else "thank you"), int(i % 4 < 2)) for i in range(400)]
    model = toxicity.Model.of([r[1] for r in rows], np.array([r[2] for r in rows]))
    score = dict(zip("abcdef", model.scores([f"{plain} idiiot", f"{plain} stup-id", f"{plain} i d i o t here", plain, "", f"{plain} idxiot"])))
    assert min(score["a"], score["b"], score["c"]) > 0.3 > max(score["d"], score["e"]) and score["f"] > score["d"]


# --- HTML


def test_html_layout():
    page = """<!DOCTYPE html><title>A &amp; B</title><p>One <b>two</b> three<br>four<p>Five <span style="display:none">no</span>six<ul><li>a<li>b <ol start=3><li>x<li>y</ol><li>c</ul>
<table><tr><th>Name<th>Qty<tr><td>apple<td>12<tr><td colspan=2>both cells here</table><pre>
 a  b
   c</pre><div>x</div>y<script>no()</script><details><summary>S</summary>gone</details><blockquote>q1<p>q2</blockquote><div hidden>z</div>end"""
    title, text, _ = html_text.render(page)
    assert title == "A & B"
    assert text == "One two three\nfour\n\nFive six\n\n- a\n- b\n  3. x\n  4. y\n- c\n\nName   Qty\napple  12\nboth cells here\n\n a  b\n   c\n\nx\ny\nS\n\n> q1\n>\n> q2\n\nend"


def test_html_odd(spark):
    deep = "<div>" * 5000 + "deep" + "</div>" * 10
    cases = [(1, None), (2, ""), (3, "plain < text & more"), (4, deep), (5, "<table><td>a<td>b</table></p></x><li>c"), (6, "<script>x</script><!-- c --><style>y"), (6, "<p>again"), (None, "<b>n</b>")]
    df = spark.createDataFrame([(*c, 1) for c in cases], "page_id long, html string, text int")
    got = sorted((str(r["page_id"]), r["text"]) for r in html_text.extract(df).collect())
    assert got == sorted([("1", ""), ("2", ""), ("3", "plain < text & more"), ("4", "deep"), ("5", "a  b\n\nc"), ("6", ""), ("6", "again"), ("None", "n")])
    assert html_text.extract(df.where("1 = 0")).count() == 0


# --- pipeline


def test_pipeline(spark, docs):
    import corpus_pipeline as p

    assert [n for n, _ in p.STAGES] == ["quality rules", "exact dedup", "order minhash near-dedup", "mix sources", "bpe"] and p.ORACLE_SQL is None
    rows = {r["doc_id"]: r for r in quality.keep_good(docs).collect()}
    keep, seen = [], set()
    for d in sorted(rows):
        t = re.sub(r"[\x20\x09-\x0D]+", " ", rows[d]["text"])
        if t not in seen:
            seen.add(t)
            keep.append(d)
    parent = {d: d for d in keep}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = {d: shingles(rows[d]["text"]) for d in keep}
    for a, b in itertools.combinations(keep, 2):
        both = len(sets[a] & sets[b])
        if words(rows[a]["text"]) == words(rows[b]["text"]) or (both and both >= 0.8 * len(sets[a] | sets[b])):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    left = [rows[d] for d in keep if find(d) == d]
    mix = {r["doc_id"]: r["taken"] for r in mixing.mixed(spark.createDataFrame(left, docs.schema)).collect()}
    got = collections.defaultdict(list)
    t = bpe.tokenizer(catalog.tokenizer_path())
    for r in p.run(spark, SF).collect():
        got[r["doc_id"]].append(r)
    assert set(got) == {d for d, k in mix.items() if k}
    for d, own in got.items():
        w = words(rows[d]["text"])
        copies, part = divmod(mix[d], len(w))
        want = [t.encode(rows[d]["text"], add_special_tokens=False).ids] * copies + ([t.encode(" ".join(w[:part]), add_special_tokens=False).ids] if part else [])
        assert sorted(r["ids"] for r in own) == sorted(want)
        assert all(r["decoded"] == t.decode(r["ids"], skip_special_tokens=False) for r in own)


def test_every_operator_is_registered():
    names = set(catalog.queries())
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in names} == set(range(1, 14)) and len(names) == 13
