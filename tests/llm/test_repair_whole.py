"""Grammars leave no frequent pair."""

import numpy as np

from strandline.llm import repair


def test_no_frequent_pair_is_left():
    rng = np.random.default_rng(6)
    passage = rng.permutation(np.arange(3, 503))
    docs = [np.concatenate([rng.integers(3, 9000, 5), passage, [2]]) for _ in range(300)]
    ids, ends = np.concatenate(docs).astype(np.int32), np.cumsum([len(d) for d in docs])
    left, right, lengths, symbols, place = repair.compress(ids, ends, 9000)
    assert (repair.expand(symbols, left, right, 9000) == ids).all()
    assert lengths.max() >= 500
    own = np.split(symbols.astype(np.int64), place[1:])
    _, n = np.unique(np.concatenate([d[:-1] << 32 | d[1:] for d in own]), return_counts=True)
    assert n.max() < repair.LEAST_COUNT


def plain_frequent(key, least):
    at = [i for i, k in enumerate(key) if key.count(k) >= least]
    return at, [key[i] for i in at]


def test_frequent_keys_sorted_with_or_without_their_places():
    rng = np.random.default_rng(3)
    for size in (0, 1, 7, 60, 400):
        for bits in (6, 40, 62):
            key = rng.integers(0, 40, size) << (bits - 6)
            on, number, keys, n = repair._frequent(key, bits, 8)
            at, own = plain_frequent(key.tolist(), 8)
            assert (on.tolist(), keys[number].tolist()) == (at, own)
            assert n.tolist() == [own.count(k) for k in keys.tolist()] and len(set(keys.tolist())) == len(keys)


def test_few_replacements_are_copied_to_the_same_grammar(monkeypatch):
    rng = np.random.default_rng(2)
    for _ in range(20):
        docs = [rng.integers(3, rng.choice([4, 6, 30]), rng.integers(0, 90)) for _ in range(40)]
        ids, ends = np.concatenate(docs).astype(np.int32), np.cumsum([len(d) for d in docs])
        got = []
        for few in (0, 1024):
            monkeypatch.setattr(repair, "FEW", few)
            got.append(repair.compress(ids, ends, 30, least=3))
        assert all((a == b).all() for a, b in zip(*got))
        left, right, _, symbols, _ = got[0]
        assert (repair.expand(symbols, left, right, 30) == ids).all()


def test_nonterminals_are_expanded_without_a_sort(monkeypatch):
    def sorts(*a, **k):
        raise AssertionError("symbols are sorted")

    monkeypatch.setattr(np, "unique", sorts)
    assert repair.expand(np.array([11, 3, 10, 11], np.int64), np.array([3, 10]), np.array([4, 5]), 10).tolist() == [3, 4, 5, 3, 3, 4, 3, 4, 5]
    none = np.zeros(0, np.int64)
    assert repair.expand(np.array([3, 4], np.int64), none, none, 10).tolist() == [3, 4] and not len(repair.expand(none, none, none, 10))
