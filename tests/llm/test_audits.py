"""Source divergence, filter audit and line dedup against brute force, on odd rows and with hot terms, lines and copies."""

import collections
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from strandline.llm import divergence, filter_audit, line_dedup

SCHEMA = "doc_id long, text string, lang string, source string"
LONG = "\n".join(f"Line number {i % 700} of it, {chr(97 + i % 26) * 3}" for i in range(3000))
ODD = [
    (1, "Alpha beta\n  gamma delta epsilon  \nALPHA beta gamma", "en", "a"), (2, "gamma delta epsilon\n\nalpha BETA gamma\t\nÉté à la plage ici", "en", "b"), (3, "été à la plage ici\nÉté à la plage ici", "en", None),
    (4, None, None, "a"), (5, "", "", "b"), (6, " \n\t\x0b ", "en", ""), (7, LONG, "en", "b"), (8, LONG, "en", "b"), (9, "gamma delta epsilon", None, None), (10, "x#y 100% Tab|le", "de", "a"), (10, "x#y 100% Tab|le", "de", "a"),
    (11, "naïve ΣΣ ſ KK a1b2", "en", "a"), (12, "gamma delta epsilon\ngamma delta epsilon", "fr", "solo"), (None, "Alpha beta gamma\nnobody else has this", "en", "a"), (None, "nobody else has this", "en", "a"), (-5, "GAMMA delta epsilon\x1f", "en", "b"),
]


@pytest.fixture(scope="module")
def odd(spark):
    names = ("h", "x", "at", "id", "key", "line", "first", "gone", "doc", "n", "p", "part", "word", "bin", "payload", "good", "toxic", "mask", "A", "value", "rank", "term", "item", "of", "of_x")
    return spark.createDataFrame(ODD, SCHEMA).withColumns({c: F.lit(7) for c in names})


def generated(seed, n=400):
    """Documents with a hot source, a hot word and line, groups of copies, and rare words."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lines = [" ".join(rng.choice(["the", "The", f"w{'abcdefghij'[rng.randrange(10)]}", f"r{'abcdefghij'[rng.randrange(10)] * rng.randrange(1, 5)}", "of", "A#1"]) for _ in range(rng.randrange(1, 12))) for _ in range(rng.randrange(1, 8))]
        lines.append("A very common LINE of all") if rng.random() < 0.7 else None
        out.append((i, "\n".join(lines), rng.choice(["en", "en", "de"]), rng.choice(["s0", "s0", "s1", "s2", None])))
    return [*out, *((n + i, out[0][1], "en", "s0") for i in range(n // 4))]


# --- source divergence


def plain_divergence(rows, least=3, most=200):
    count, docs, groups = collections.Counter(), collections.defaultdict(set), set()
    for doc_id, text, lang, source in rows:
        lang, source, text = lang or "", source or "", text or ""
        groups.add((lang, source))
        for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text):
            t = "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
            count[lang, source, t] += 1
            docs[lang, t].add((source, doc_id, text if doc_id is None else None))
    kept = collections.defaultdict(list)
    for (lang, t), d in docs.items():
        if len(d) >= least:
            kept[lang].append(t)
    out = []
    for lang in {x for x, _ in groups}:
        terms, own = kept[lang], sorted(s for x, s in groups if x == lang)
        share = lambda n, total: 1 + 1000000000 * (n + 1) // (total + len(terms))
        total = {s: sum(count[lang, s, t] for t in terms) for s in own}
        p = {s: {t: share(count[lang, s, t], total[s]) for t in terms} for s in own}
        q = {t: share(sum(count[lang, s, t] for s in own), sum(total.values())) for t in terms}
        for a in own:
            pairs = sorted(((-sum((p[a][t] - p[b][t]) ** 2 // p[b][t] for t in terms), b.encode(), b) for b in own if b != a))
            out += [(lang, a, "pair", b, -v, k + 1) for k, (v, _, b) in enumerate(pairs)]
            top = sorted((-((p[a][t] - q[t]) ** 2 // q[t]), t.encode(), t) for t in terms if count[lang, a, t] and p[a][t] > q[t])[:most]
            out += [(lang, a, "term", t, -v, k + 1) for k, (v, _, t) in enumerate(top)]
    return sorted(out)


def divergence_rows(df):
    return sorted((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def test_divergence_odd(spark, odd):
    assert divergence_rows(divergence.source_divergence(odd)) == plain_divergence(ODD)
    assert divergence_rows(divergence.source_divergence(odd, least_docs=1, most_terms=4)) == plain_divergence(ODD, 1, 4)
    assert divergence.source_divergence(odd.where("1 = 0")).count() == 0


@pytest.mark.parametrize("least_hot", [4, 10**6])
def test_divergence_with_hot_terms(spark, monkeypatch, least_hot):
    monkeypatch.setattr(divergence, "LEAST_HOT", least_hot)
    monkeypatch.setattr(divergence, "BIN_BYTES", 2000)
    rows = generated(5)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert divergence_rows(divergence.source_divergence(docs)) == plain_divergence(rows)


def test_pairs_made_in_steps_are_the_same(spark, monkeypatch):
    import pyarrow as pa

    rng = random.Random(3)
    rows = sorted({("en" if i % 2 else "de", f"t{rng.randrange(50)}", f"s{rng.randrange(6)}") for i in range(400)})
    batch = pa.record_batch([*map(pa.array, zip(*rows)), pa.array([rng.randrange(1, 10**9) for _ in rows]), pa.array([rng.randrange(1, 50) for _ in rows])], ["lang", "term", "source", "p", "absent"])

    def total(step, cut):
        monkeypatch.setattr(divergence, "PAIRS_AT_ONCE", step)
        out = collections.Counter()
        for b in divergence._pairs([batch.slice(i, cut) for i in range(0, len(rows), cut)]):
            for r in b.to_pylist():
                out[r["lang"], r["source"], r["item"]] += r["value"]
        return out

    want = total(1 << 21, 10**6)
    assert want and want == total(1, 7) == total(40, 1) == total(1000, 90)


# --- filter audit


def plain_audit(rows, labels):
    firsts, mark = {}, collections.defaultdict(lambda: [0, 0])
    last = lambda i: (i is None, i)
    for i, text, *_ in rows:
        firsts[text or ""] = min(firsts.get(text or "", last(i)), last(i), key=lambda k: (k[0], k[1] or 0))
    for i, quality, toxic in labels:
        if i is not None:
            mark[i] = [max(mark[i][0], quality == 1), max(mark[i][1], toxic == 1)]
    fails, out = collections.defaultdict(list), []
    for i, text, lang, _ in rows:
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        f = {
            "A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
            "E": firsts[text] != last(i),
        }
        fails[lang or ""].append((f, *(mark[i] if i is not None else (0, 0))))
    for part, docs in fails.items():
        won = collections.Counter()
        for order in itertools.permutations("ABCDE"):
            here = []
            for k, c in enumerate(order):
                gone = [d for d in docs if d[0][c] and not any(d[0][e] for e in order[:k])]
                won[c] += len(gone)
                here.append((
                    part, "".join(order), k + 1, sum(not any(d[0][e] for e in order[: k + 1]) for d in docs), len(gone), sum(d[0][c] and any(d[0][e] for e in order[:k]) for d in docs),
                    sum([e for e in "ABCDE" if d[0][e]] == [c] for d in docs), sum(d[1] for d in gone), sum(d[2] for d in gone),
                ))
            out += here
        out = [(*x, won[x[1][x[2] - 1]]) if x[0] == part else x for x in out]
    return sorted(out)


COLUMNS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
LABELS = "doc_id long, quality int, toxic int"


def audit_rows(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def test_audit_odd(spark, odd):
    labels = [(1, 1, 0), (1, 0, 1), (3, None, 1), (None, 1, 1), (7, 1, None), (8, 1, 1), (999, 1, 1), (10, 0, 1)]
    marks = spark.createDataFrame(labels, LABELS).withColumns({"lang": F.lit("zz"), "text": F.lit("zz"), "id": F.lit(1), "good": F.lit(1)})
    assert audit_rows(filter_audit.filter_audit(odd, marks)) == plain_audit(ODD, labels)
    assert filter_audit.filter_audit(odd.where("1 = 0"), marks).count() == 0
    assert {r["removed"] + r["kept"] + r["redundant"] for r in filter_audit.filter_audit(odd, marks.where("1 = 0")).where("step = 1 and part = 'en'").collect()} == {10}


def test_audit_of_many_copies(spark):
    rows = generated(6) + [(None, generated(6)[0][1], "en", "s0")] * 3
    labels = [(i, i % 2, (i // 2) % 2) for i in range(0, 500, 3)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert audit_rows(filter_audit.filter_audit(docs, spark.createDataFrame(labels, LABELS))) == plain_audit(rows, labels)


# --- line dedup


def plain_lines(rows, least_chars=10, least_docs=2):
    fold = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    holders = collections.defaultdict(set)
    for i, text, *_ in rows:
        for line in (text or "").split("\n"):
            if len(fold(line)) >= least_chars:
                holders[fold(line)].add(i)
    out = []
    for i, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders[fold(x)]) < least_docs or i == min(holders[fold(x)], key=lambda k: (k is None, k or 0))]
        out.append((str(i), len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def line_rows(df):
    return sorted((str(r["doc_id"]), r["n_lines"], r["n_dropped"], r["kept_text"]) for r in df.collect())


def test_lines_odd(spark, odd):
    assert line_rows(line_dedup.line_dedup(odd)) == plain_lines(ODD)
    assert line_rows(line_dedup.line_dedup(odd, least_chars=1, least_docs=3)) == plain_lines(ODD, 1, 3)
    assert line_dedup.line_dedup(odd.where("1 = 0")).count() == 0


def test_lines_of_many_documents(spark):
    rows = generated(7)
    assert line_rows(line_dedup.line_dedup(spark.createDataFrame(rows, SCHEMA).repartition(6))) == plain_lines(rows)


def test_a_long_document_takes_no_longer_than_its_lines(spark):
    text = "\n".join(f"this is line {i}" for i in range(60_000))
    got = line_dedup.line_dedup(spark.createDataFrame([(1, text, "en", "a"), (2, text + "\nand a last one", "en", "a")], SCHEMA)).orderBy("doc_id").collect()
    assert [r["n_dropped"] for r in got] == [0, 60_000] and got[1]["kept_text"] == "and a last one"
