"""Deleted-interpolation language model: training counts of n-grams, mixed by context-frequency buckets.

Blocks of documents ask for the n-grams (1 to 3 tokens) that they hold, once each with their own training count; bins
add up the counts of all blocks and answer with the totals (see blocks). All n-grams of all training documents are
counted. The model is

    p(w | u, v) = l0 / (V + 1) + l1 * c(w) / N + l2 * c(v, w) / c(v) + l3 * c(u, v, w) / c(u, v),

with weights l that depend on the bucket of the context counts c(u, v) and c(v), bucketed by their bit lengths. The
weights are learned by expectation-maximisation on held-out counts: each training token in turn is deleted from the
counts and predicted from what is left. The statistics for that are a histogram of the four estimates, with LEVELS
steps each, in each bucket: its size is bounded by these numbers, not by the corpus; within a cell exact means are
kept. It is the only thing that the driver gathers.

Tokens are the words of the text with A-Z in lower case, then one end; before a document stand two begin marks. An
n-gram is known to its bin by 48 bits of its hash besides those that choose the bin. Bins grow in number with the
corpus and hold some millions of n-grams, so the chance that one of them takes another's count stays near 1e-8 at any
size.

Defined results: null and empty texts are the end token alone; a null id hashes as the empty string; repeated rows
are scored and counted one by one; with no training document all estimates but the uniform one are 0. An empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm import blocks
from strandline.llm.bpe import _pack, _unpack
from strandline.llm.hashing import mix, planes, unplanes, word_hashes
from strandline.llm.store import written
from strandline.llm.text import whole

ORDER = 3
LEVELS = 4  # to a factor of 10
STEPS = 41  # of an estimate; 0 stands for none
BUCKETS = (8, 16)  # bit lengths of c(u, v) and c(v) that are told apart
ADD = 0.1
ROUNDS = 40
HISTOGRAM = "cell bigint, n bigint, p1 double, p2 double, p3 double"
SCORES = "id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"

_END, _BEGIN = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
_SALT = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


class _Grams:
    """A block's tokens and its distinct n-grams."""

    def __init__(self, table: pa.Table, bins: int, order: int):
        words, at = word_hashes(table.column("text"), lower=True)
        n = np.diff(at)
        self.at = at + np.arange(len(at))  # of each document's first token, with the ends
        h = np.full(len(words) + len(n), _END)
        first = np.zeros(len(h), bool)
        first[self.at[:-1]] = True
        h[np.delete(np.arange(len(h)), self.at[1:] - 1)] = words
        self.first = first
        v = np.where(first, _BEGIN, np.roll(h, 1))
        u = np.where(first, _BEGIN, np.roll(v, 1))
        self.train = np.repeat(table.column("train").to_numpy(), n + 1)
        keys = [mix(h * _SALT[0])]
        if order > 1:
            keys.append(mix(h * _SALT[1] + mix(v)))
        if order > 2:
            keys.append(mix(h * _SALT[2] + mix(v + mix(u))))
        self.places, self.own, self.rows = [], [], []
        for key in keys:
            distinct, place = np.unique(key, return_inverse=True)
            bin_ = (distinct % np.uint64(bins)).astype(np.int64)
            by_bin = np.argsort(bin_, kind="stable")
            rank = np.empty(len(distinct), np.int64)
            rank[by_bin] = np.arange(len(distinct))
            self.places.append(rank[place])
            self.own.append(np.bincount(rank[place], weights=self.train, minlength=len(distinct)).astype(np.int64))
            self.rows.append(((distinct >> np.uint64(16))[by_bin], np.searchsorted(bin_[by_bin], np.arange(bins + 1))))

    def messages(self, bins: int):
        for b in range(bins):
            parts = [(keys[at[b] : at[b + 1]], own[at[b] : at[b + 1]]) for (keys, at), own in zip(self.rows, self.own)]
            if any(len(k) for k, _ in parts):
                sizes = np.array([len(k) for k, _ in parts], "<u4").tobytes()
                yield b, len(parts), sizes + _pack(b"".join(planes(np.diff(k, prepend=np.uint64(0)), 6) + planes(c, 4) for k, c in parts))

    def totals(self, answers: dict, bins: int) -> list[np.ndarray]:
        """Training count of the n-gram that ends at each token, for each n."""
        out = [np.zeros(len(own), np.int64) for own in self.own]
        for b, (_, payload) in answers.items():
            raw, i = _unpack(payload), 0
            for (_, at), total in zip(self.rows, out):
                size = int(at[b + 1] - at[b])
                total[at[b] : at[b + 1]] = unplanes(raw[i : i + 6 * size], 6)
                i += 6 * size
            if i != len(raw):
                raise ValueError("an answer does not fit its question")
        return [total[place] for total, place in zip(out, self.places)]


def _add_up(table: pa.Table) -> pa.Table:
    """Answers of a bin; one more row, of block -1, has the number of distinct tokens in n and that of tokens in payload."""
    read = []  # for each message, for each n: keys and counts
    for k, payload in zip(table.column("n").to_pylist(), table.column("payload").to_pylist()):
        sizes, raw, i, parts = np.frombuffer(payload[: 4 * k], "<u4").tolist(), _unpack(payload[4 * k :]), 0, []
        for size in sizes:
            parts.append((np.cumsum(unplanes(raw[i : i + 6 * size], 6)), unplanes(raw[i + 6 * size : i + 10 * size], 4)))
            i += 10 * size
        read.append(parts)
    totals = []
    for parts in zip(*read):
        _, place = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        count = np.bincount(place, weights=np.concatenate([c for _, c in parts])).astype(np.int64)
        totals.append((count, np.split(count[place], np.cumsum([len(k) for k, _ in parts])[:-1])))
    own = [_pack(b"".join(planes(each[m], 6) for _, each in totals)) for m in range(len(read))]
    known = totals[0][0]
    return pa.table([
        pa.array([*table.column("block").to_pylist(), -1], pa.int32()), pa.array([*table.column("bin").to_pylist(), table.column("bin")[0].as_py()], pa.int32()),
        pa.array([*table.column("n").to_pylist(), int((known > 0).sum())], pa.int32()), pa.array([*own, str(int(known.sum())).encode()], pa.binary()),
    ], ["block", "bin", "n", "payload"])


def _estimates(g: _Grams, totals: list[np.ndarray], n_tokens: int, n_docs: int, without: int):
    """Estimates p1, p2, p3 for each token and the bucket of its context; without: how often the token itself is left out."""
    c = [*totals, *[np.zeros(len(g.first), np.int64)] * (3 - len(totals))]
    context = [np.full(len(g.first), n_tokens), np.where(g.first, n_docs, np.roll(c[0], 1)), np.where(g.first, n_docs, np.roll(c[1], 1))]
    if len(totals) < 3:
        context[2] = np.zeros(len(g.first), np.int64)
    p = [np.where(k > without, (x - without) / np.maximum(k - without, 1), 0.0) for x, k in zip(c, context)]
    bits = [np.minimum(np.frexp(np.maximum(k - without, 0).astype(float))[1], top - 1) for k, top in zip((context[2], context[1]), BUCKETS)]
    return p, bits[0] * BUCKETS[1] + bits[1]


def _step(p: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.where(p > 0, np.clip(STEPS - 1 + np.round(LEVELS * np.log10(p)), 1, STEPS - 1), 0).astype(np.int64)


def weights(cells: np.ndarray, n: np.ndarray, p: np.ndarray, uniform: float, rounds: int = ROUNDS) -> np.ndarray:
    """Mixture weights of each bucket by expectation-maximisation. cells: bucket of each row; n: tokens; p: their mean estimates, a column each."""
    all_p = np.column_stack([np.full(len(n), uniform), p])
    b3, b2 = np.divmod(np.arange(BUCKETS[0] * BUCKETS[1]), BUCKETS[1])
    w = np.stack([np.ones(len(b3)), np.ones(len(b3)), b2 > 0, (b3 > 0) & (b2 > 0)], axis=1).astype(float)
    w /= w.sum(1, keepdims=True)
    for _ in range(rounds):
        share = w[cells] * all_p
        share *= (n / np.maximum(share.sum(1), 1e-300))[:, None]
        got = np.stack([np.bincount(cells, weights=share[:, j], minlength=len(w)) for j in range(4)], axis=1)
        seen = got.sum(1) > 0
        w[seen] = got[seen] / got[seen].sum(1, keepdims=True)
    w = np.maximum(w, np.array([1e-6, 0, 0, 0]))  # no token is impossible
    return w / w.sum(1, keepdims=True)


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10, order: int = ORDER) -> DataFrame:
    """Per row of docs: id, held_out, n_tokens, n_known, train_tokens, base_score, score; learned from rows whose crc32(id as text) modulo folds is not 0."""
    n_blocks, bins = blocks.counts(docs, text_col)
    fold = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % folds
    slim = docs.select(F.col(id_col).cast("bigint").alias("id"), whole(text_col).alias("text"), (fold != 0).alias("train"))
    packets = blocks.packed(slim.withColumn("block", blocks.dealt(slim, n_blocks)))

    def ask(table: pa.Table):
        return _Grams(table, bins, order).messages(bins)

    answers = written(packets.groupBy("block").applyInArrow(blocks.asker(ask), blocks.ASKS).groupBy("bin").applyInArrow(_add_up, blocks.ANSWERS), "ngrams")
    sums = answers.where("block = -1").agg(F.sum("n").alias("v"), F.sum(F.col("payload").cast("string").cast("bigint")).alias("n")).first()
    v, n_tokens, n_docs = sums["v"] or 0, sums["n"] or 0, slim.where("train").count()
    grouped = packets.groupBy("block").cogroup(answers.where("block >= 0").groupBy("block"))

    def histogram(block: int, table: pa.Table, answers: dict) -> pa.Table:
        g = _Grams(table, bins, order)
        p, bucket = _estimates(g, g.totals(answers, bins), n_tokens, n_docs, without=1)
        p, bucket = [x[g.train] for x in p], bucket[g.train]
        cell = ((bucket * STEPS + _step(p[0])) * STEPS + _step(p[1])) * STEPS + _step(p[2])
        cell, place, n = np.unique(cell, return_inverse=True, return_counts=True)
        return pa.table([pa.array(cell), pa.array(n), *(pa.array(np.bincount(place, weights=x, minlength=len(cell))) for x in p)], ["cell", "n", "p1", "p2", "p3"])

    cells = written(grouped.applyInArrow(blocks.applier(histogram), HISTOGRAM).groupBy("cell").agg(*(F.sum(c).alias(c) for c in ("n", "p1", "p2", "p3"))), "histogram").toPandas()
    n = cells["n"].to_numpy(float)
    w = weights(cells["cell"].to_numpy(np.int64) // STEPS**3, n, cells[["p1", "p2", "p3"]].to_numpy(float) / np.maximum(n, 1)[:, None], 1 / (v + 1))

    def score(block: int, table: pa.Table, answers: dict) -> pa.Table:
        g = _Grams(table, bins, order)
        totals = g.totals(answers, bins)
        p, bucket = _estimates(g, totals, n_tokens, n_docs, without=0)
        mixed = w[bucket, 0] / (v + 1) + sum(w[bucket, j + 1] * p[j] for j in range(3))
        add = lambda x: np.add.reduceat(x, g.at[:-1])  # noqa: E731  a document has its end token at least
        base = np.log10((totals[0] + ADD) / (n_tokens + ADD * (v + 1)))
        return pa.table([
            table.column("id"), pa.array(~table.column("train").to_numpy()), pa.array(np.diff(g.at)), pa.array(add((totals[0] > 0).astype(np.int64))),
            pa.array(np.full(len(table), n_tokens, np.int64)), pa.array(add(base)), pa.array(add(np.log10(mixed))),
        ], ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return grouped.applyInArrow(blocks.applier(score), SCORES).withColumnRenamed("id", id_col)
