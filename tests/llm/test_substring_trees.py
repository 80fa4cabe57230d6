"""Suffix trees of the substring operator against a plain sort, and what a screen's collisions leave."""

import random

import numpy as np
import pyarrow as pa

from strandline.llm import substring
from strandline.llm.bpe import _unpack


def test_subtrees_are_sorted_suffixes_with_common_prefixes():
    rng = random.Random(5)
    for _ in range(60):
        length = rng.randrange(1, 15)
        words = np.array([rng.randrange(rng.choice([1, 2, 5, 90000])) for _ in range(length + rng.randrange(80))])
        starts = np.array(sorted(rng.sample(range(len(words) - length + 1), rng.randrange(len(words) - length + 2))), np.int64)
        order, common = substring.subtrees(words, starts, length)
        suffixes = [tuple(words[s : s + length]) for s in starts[order]]
        assert suffixes == sorted(suffixes)
        for a, b, n in zip(suffixes, suffixes[1:], common[1:]):
            assert n == next((k for k in range(length) if a[k] != b[k]), length)


def tables(docs):
    return [pa.table({"id": pa.array([d for d, _ in own], pa.int64()), "text": pa.array([t for _, t in own])}) for own in docs]


def told(docs, length, screen):
    """Ids of the documents that lose words, by block; screen makes bits of a block's hashes."""
    none = np.zeros(0, np.uint64)
    parts = [substring._Block(t, 1, length) for t in tables(docs)]
    trees = [substring._Subtree(b, screen(b), none, 1, length) for b in parts]
    messages = [(n, p) for t in trees for _, n, p in t.suffixes()]
    bits = [np.unpackbits(np.frombuffer(_unpack(p), np.uint8), count=n).astype(bool) for n, p in substring._trees(length)(messages)]
    return [sorted(set(t.own[e[np.argsort(t.order)][t.node] | (t.own > t.doc[t.node])].tolist())) for t, e in zip(trees, bits)]


def test_suffixes_let_through_by_chance_are_set_apart():
    docs = [[(3, "a b c d"), (1, "x y z"), (7, "x y z")], [(2, "b c d e"), (9, "q é\tw\n\n q é w")], [(5, "q\x0bé w"), (None, "m n o")]]
    assert told(docs, 3, lambda b: np.ones(len(b.code), bool)) == [[3, 7], [9], []]


def test_screen_tells_what_blocks_share():
    docs = [[(1, "a b c d e"), (4, "u v w")], [(2, "b c d"), (3, "k l m"), (6, "k l m")]]
    parts = [substring._Block(t, 1, 3) for t in tables(docs)]
    messages = [(n, p) for b in parts for _, n, p in b.questions()]
    shared = [b.shared({0: a}) for b, a in zip(parts, substring.met_elsewhere(messages))]
    assert [int(s.sum()) for s in shared] == [1, 2]
