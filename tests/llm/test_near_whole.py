"""Classes of near-dedup where near pairs share their buckets with many documents of one template."""

import itertools
import random

import numpy as np

from strandline.llm import order_minhash
from strandline.llm.hashing import word_hashes


def test_pairs_within_a_template_are_found(spark):
    import pyarrow as pa

    rng = random.Random(5)
    base = [f"w{k}" for k in range(400)]
    fresh = (f"own{k}" for k in itertools.count())

    def edited(words, n, lo, hi):
        out = list(words)
        for k in rng.sample(range(lo, hi, 10), n):
            out[k] = next(fresh)
        return out

    docs = []
    for _ in range(160):
        docs.append(edited(base, 6, 5, 400))
        if len(docs) % 4 == 1:
            docs.append(edited(docs[-1], 2, 0, 400))
    rng.shuffle(docs)
    texts = [" ".join(d) for d in docs]
    h, at = word_hashes(pa.array(texts))
    words = [h[a:b] for a, b in zip(at[:-1], at[1:])]
    label = list(range(len(docs)))
    sets = [{tuple(d[k : k + 5]) for k in range(len(d) - 4)} for d in docs]
    for a, b in itertools.combinations(range(len(docs)), 2):
        both = len(sets[a] & sets[b])
        if both >= 0.8 * (len(sets[a]) + len(sets[b]) - both) and order_minhash.similar(np.asarray(words[a]), np.asarray(words[b])):
            old, new = sorted((label[a], label[b]), reverse=True)
            label = [new if x == old else x for x in label]
    got = {r["id"]: r["class_id"] for r in order_minhash.near_classes(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()}
    assert 20 <= sum(label.count(x) == 2 for x in set(label))
    assert [got[k] for k in range(len(docs))] == label


def test_parities_never_exceed_what_sets_differ_in():
    import random

    import pyarrow as pa

    from strandline.llm.hashing import windows, word_hashes

    rng = random.Random(5)
    base = [rng.choice("abcdefgh") * rng.randint(1, 4) for _ in range(3000)]
    texts = ["", "a b c", " ".join(base[:9])]
    for _ in range(60):
        n = rng.randint(5, 3000)
        words = base[:n]
        for _ in range(rng.randint(0, n // 8)):
            words[rng.randrange(n)] = f"x{rng.randrange(9)}"
        texts.append(" ".join(words))
    column = pa.array(texts).cast(pa.binary())
    signs, wide = order_minhash.parities(column)
    signs = signs.astype("<u8")
    h, at = word_hashes(column)
    s, i = windows(h, at, order_minhash.SHINGLE)
    sets = [set(s[(i >= a) & (i < b)].tolist()) for a, b in zip(at[:-1], at[1:])]
    for k in range(len(texts)):
        for j in range(k):
            assert sum(int(x).bit_count() for x in signs[k] ^ signs[j]) <= len(sets[k] ^ sets[j])
            assert order_minhash.apart(wide[k], wide[j]) <= len(sets[k] ^ sets[j])
    assert order_minhash.apart(wide[-1], wide[-1]) == 0
