"""Token ids in shards compressed by Re-Pair grammars, with random access to documents.

Documents are dealt into shards by ranges of their id, encoded through the distinct-word table (see bpe), closed with
an end id, and compressed shard by shard: frequent pairs of neighbouring ids are replaced by nonterminals, again and
again, never across the end of a document. A round takes all pairs whose count is at least half of the largest one,
and where occurrences overlap the more frequent pair wins, then the left one. Rounds end when no pair occurs
LEAST_COUNT times. Pairs are counted by one sort of numbers that hold the pair and its place.

A shard's payload (little endian): magic ``RPG1``; number of documents, ids, rules, symbols and the first nonterminal
(each u4); zstd of: left and right symbol of each rule (u4), expansion length of each rule (u4), the symbols (u4), the
place of each document's first symbol (u4), the document ids (i8). A document is decoded from its own symbols alone,
and its length is known from the lengths of their expansions.

A file is a Parquet table with a row for each shard: shard, n_docs, n_ids, payload; shards ascend with the ids they
hold. Defined results: null and empty texts have the end id alone; null ids come first, and are written as the smallest
long; rows that repeat an id stand side by side. An empty table writes an empty file.
"""

from __future__ import annotations

import ctypes
import functools
import struct

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.llm import blocks, bpe
from strandline.llm.hashing import ragged
from strandline.llm.store import forget, written
from strandline.llm.text import whole

MAGIC = b"RPG1"
LEAST_COUNT = 8
PAIRS = 4096  # of a round, at least
FEW = 1024  # replacements of a round
SHARD_BYTES = 3 << 20  # of text
FILE = "shard int, n_docs bigint, n_ids bigint, payload binary"
DECODED = "shard int, place int, id bigint, before bigint, n_tokens bigint, ids binary"
_NULL = np.iinfo(np.int64).min
_NOTE = -1  # in place of a bin: what a block notes for itself


@functools.cache
def keep_freed_memory() -> None:
    """Lets this process hold up to 256 MB that arrays have given back, where its C library can be told so: the arrays of a round are as large as those of the one before, and new pages cost a fifth of its time."""
    if tell := getattr(ctypes.CDLL(None), "mallopt", None):
        tell(-3, 32 << 20)  # size from which an array has a mapping of its own
        tell(-1, 256 << 20)  # free memory from which some goes back


def compress(ids: np.ndarray, ends: np.ndarray, base: int, least: int = LEAST_COUNT, rounds: int | None = None):
    """ids of all documents, and the place after each document's last. Gives left, right, lengths, symbols, and places. After a round only pairs that were frequent or stand beside a new symbol are counted again; when none of them is frequent, all are, until none is."""
    seq = ids.astype(np.int32)
    filled = np.diff(ends, prepend=0) > 0
    last = np.zeros(len(seq), bool)  # of its document
    last[ends[filled] - 1] = True
    known: dict[int, int] = {}  # pair -> nonterminal
    some, done = None, 0  # places that may begin a frequent pair; None: any
    while len(seq) > 1 and (rounds is None or done < rounds):
        often = np.flatnonzero(~last[:-1]) if some is None else some[~last[some]]
        width = (base + len(known)).bit_length()
        key = seq.take(often).astype(np.int64)
        key <<= width
        key |= seq.take(often + 1)
        on, number, pairs, n = _frequent(key, 2 * width, least)
        if not len(n):
            if some is None:
                break
            some = None
            continue
        often = often.take(on)
        done += 1
        taken = n >= max(least, n.max() // 2)
        if taken.sum() < PAIRS:  # or a long tail of rounds would follow
            taken = n >= max(least, np.sort(n)[-min(PAIRS, len(n))])
        at, number = _winners(often, np.where(taken, n, 0).astype(np.int32).take(number), number)
        fresh = np.full(len(pairs), -1, np.int32)
        won = np.flatnonzero(np.bincount(number, minlength=len(pairs)))
        for k, pair in zip(won.tolist(), pairs[won].tolist()):
            fresh[k] = known.setdefault((pair >> width) << 32 | pair & ((1 << width) - 1), base + len(known))
        seq[at] = fresh.take(number)
        last[at] = last.take(at + 1)
        gone = at + 1
        if len(gone) < FEW:  # what lies between is copied in pieces
            pieces = list(zip([0, *(gone + 1).tolist()], [*gone.tolist(), len(seq)]))
            seq, last = (np.concatenate([x[i:j] for i, j in pieces]) for x in (seq, last))
            again = np.unique(np.concatenate([often, at, at[at > 0] - 1]))
            again = again[~np.isin(again, gone)]
            some = again - np.searchsorted(gone, again)
            some = some[some < len(seq) - 1]
            continue
        again = np.zeros(len(seq), bool)
        again[often] = True
        again[at] = again[at - 1] = True
        stay = np.ones(len(seq), bool)
        stay[gone] = False
        place = np.flatnonzero(stay)
        seq, last = seq.take(place), last.take(place)
        some = np.flatnonzero(again.take(place[:-1]))
    rules = np.array(list(known), np.int64)
    left, right = rules >> 32, rules & 0xFFFFFFFF
    lengths = [1] * base
    for a, b in zip(left.tolist(), right.tolist()):
        lengths.append(lengths[a] + lengths[b])
    begin = np.concatenate([[0], np.flatnonzero(last) + 1])
    return left, right, np.array(lengths[base:], np.int64), seq, begin[np.cumsum(filled) - filled]


def _frequent(key: np.ndarray, bits: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of keys of so many bits: the places of those that occur least times or more, and a number for each; the distinct ones by number, and how often each occurs. Keys and their places are sorted as one number where both fit."""
    low = len(key).bit_length()
    if packed := bits + low < 64:
        both = key << low
        both |= np.arange(len(key))
        both.sort()
        key = both >> low
    else:
        both = np.argsort(key, kind="stable")
        key = key[both]
    first = np.flatnonzero(np.concatenate([[True] * (len(key) > 0), key[1:] != key[:-1]]))
    n = np.diff(first, append=len(key))
    often = np.flatnonzero(n >= least)
    first, n = first[often], n[often]
    place = both.take(ragged(first, n))
    if packed:
        place &= (1 << low) - 1
    number = np.full(len(key), -1, np.int32)
    number[place] = np.repeat(np.arange(len(n), dtype=np.int32), n)
    on = np.flatnonzero(number >= 0)
    return on, number.take(on), key[first], n


def _winners(at: np.ndarray, rank: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose pair is replaced, and its number: of overlapping ones the one with the largest rank (0: none), of equal ones the left one and each second from there. at: ascending places where pairs begin."""
    beside = np.diff(at) == 1
    best = rank > 0
    best[1:] &= (rank[1:] >= rank[:-1]) | ~beside
    best[:-1] &= (rank[:-1] >= rank[1:]) | ~beside
    best = np.flatnonzero(best)
    place = at[best]
    begin = np.maximum.accumulate(np.where(np.diff(place, prepend=-2) != 1, place, -1))
    best = best[(place - begin) % 2 == 0]
    return at[best], number[best]


def expand(symbols: np.ndarray, left: np.ndarray, right: np.ndarray, base: int) -> np.ndarray:
    """The ids that the symbols stand for. Each nonterminal that occurs is worked out once."""
    rule = np.flatnonzero(symbols >= base)
    which = symbols[rule] - base
    used = np.flatnonzero(np.bincount(which, minlength=len(left)))
    number = np.zeros(len(left), np.int64)
    number[used] = np.arange(len(used))
    which = number.take(which)
    flat, owner = used + base, np.arange(len(used))
    while (open_ := flat >= base).any():
        at = np.where(open_, 2, 1)
        first = np.cumsum(at) - at
        wide = np.empty(at.sum(), np.int64)
        rules = np.where(open_, flat - base, 0)
        wide[first] = np.where(open_, left[rules], flat)
        wide[first[open_] + 1] = right[rules[open_]]
        flat, owner = wide, np.repeat(owner, at)
    size = np.bincount(owner, minlength=len(used))
    n = np.ones(len(symbols), np.int64)
    n[rule] = size[which]
    # One row of places to read from: nonterminals' ids first, then the symbols as they stand.
    start = len(flat) + np.arange(len(symbols))
    start[rule] = (np.cumsum(size) - size)[which]
    return np.concatenate([flat, symbols.astype(np.int64)]).take(ragged(start, n))


def to_payload(doc_ids: np.ndarray, ids: np.ndarray, ends: np.ndarray, base: int, **how) -> bytes:
    left, right, lengths, symbols, place = compress(ids, ends, base, **how)
    raw = b"".join(a.astype(t).tobytes() for a, t in ((left, "<u4"), (right, "<u4"), (lengths, "<u4"), (symbols, "<u4"), (place, "<u4"), (doc_ids, "<i8")))
    return MAGIC + struct.pack("<5I", len(doc_ids), len(ids), len(left), len(symbols), base) + bpe._pack(raw)


class Shard:
    """A payload, opened."""

    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a shard")
        self.n_docs, self.n_ids, rules, symbols, self.base = struct.unpack("<5I", payload[4:24])
        raw = bpe._unpack(payload[24:])
        cuts = np.cumsum([4 * rules, 4 * rules, 4 * rules, 4 * symbols, 4 * self.n_docs])
        parts = [raw[a:b] for a, b in zip([0, *cuts], [*cuts, len(raw)])]
        self.left, self.right, self.lengths, self.symbols, self.place = (np.frombuffer(p, "<u4").astype(np.int64) for p in parts[:5])
        self.doc_ids = np.frombuffer(parts[5], "<i8")

    def document(self, k: int) -> np.ndarray:
        """Ids of the document at place k, without reading another's symbols."""
        end = self.place[k + 1] if k + 1 < self.n_docs else len(self.symbols)
        return expand(self.symbols[self.place[k] : end], self.left, self.right, self.base)

    def sizes(self) -> np.ndarray:
        """Number of ids of each document."""
        rule = self.symbols >= self.base
        n = np.ones(len(self.symbols), np.int64)
        n[rule] = self.lengths[self.symbols[rule] - self.base]
        return np.diff(np.concatenate([[0], np.cumsum(n)])[np.append(self.place, len(self.symbols))])


def write(docs: DataFrame, file: str, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encodes docs' texts with the tokenizer at path and writes them as a new file."""
    bpe.check_splits(path)
    n_shards, bins = blocks.counts(docs, text_col, SHARD_BYTES, waves=True)
    slim = docs.select(F.col(id_col).cast("bigint").alias("id"), whole(text_col).alias("text"))
    rows = slim.withColumn("block", F.lit(0)) if n_shards == 1 else by_range(slim, n_shards)
    base = max(len(bpe.pieces(path)), end_id + 1)

    def ask(packets: pa.Table) -> pa.Table:
        keep_freed_memory()
        block, table = packets.column("block")[0].as_py(), blocks.block_table(packets)
        own = table.column("id").fill_null(_NULL).to_numpy()
        order = np.argsort(own, kind="stable")
        words = bpe.Words(table.column("text").take(pa.array(order)), bins)
        rows = [(_NOTE, len(own), bpe._pack(own[order].astype("<i8").tobytes())), (_NOTE, 0, words.note()), *words.messages()]
        bin_, n, payload = zip(*rows)
        return pa.table([pa.array(bin_, pa.int32()), pa.array([block] * len(rows), pa.int32()), pa.array(n, pa.int32()), pa.array(payload, pa.binary())], ["bin", "block", "n", "payload"])

    def apply(notes: pa.Table, answers: pa.Table) -> pa.Table:
        keep_freed_memory()
        block = notes.column("block")[0].as_py()
        (own,), (note,) = ([p for m, p in zip(notes.column("n").to_pylist(), notes.column("payload").to_pylist()) if (m > 0) == first] for first in (True, False))
        own, words = np.frombuffer(bpe._unpack(own), "<i8"), bpe.Words.noted(note)
        got = {b: (n, p) for b, n, p in zip(answers.column("bin").to_pylist(), answers.column("n").to_pylist(), answers.column("payload").to_pylist())}
        flat, at = words.text_ids(*words.ids(got))
        ends = at[1:] + np.arange(1, len(at))
        ids = np.full(len(flat) + len(own), end_id, np.int32)
        ids[ragged(at[:-1] + np.arange(len(own)), np.diff(at))] = flat
        return pa.table([
            pa.array([block], pa.int32()), pa.array([len(own)]), pa.array([len(ids)]), pa.array([to_payload(own, ids, ends, base)], pa.binary()),
        ], ["shard", "n_docs", "n_ids", "payload"])

    # A block's texts are read once: its questions, and the numbers of its words, wait for the answers in the shared folder.
    asks = written(blocks.packed(rows).groupBy("block").applyInArrow(ask, blocks.ASKS), "asks")
    answers = asks.where(F.col("bin") != _NOTE).groupBy(blocks.wave(), "bin").applyInArrow(blocks.answered(bpe.answerer(path)), blocks.ANSWERS)
    asks.where(F.col("bin") == _NOTE).groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(apply, FILE).write.mode("overwrite").parquet(file)
    forget(asks)


def by_range(slim: DataFrame, n: int) -> DataFrame:
    """Adds block: ranges of id with about as many rows each; null ids in the first."""
    cuts = sorted(set(slim.approxQuantile("id", [i / n for i in range(1, n)], 0.2 / n)))
    bucket = Bucketizer(splits=[-float("inf"), *cuts, float("inf")], inputCol="as_double", outputCol="as_block", handleInvalid="keep")
    with_id = slim.withColumn("as_double", F.coalesce(F.col("id").cast("double"), F.lit(float("-inf"))))
    return (bucket.transform(with_id) if cuts else with_id.withColumn("as_block", F.lit(0))).withColumn("block", F.col("as_block").cast("int")).drop("as_double", "as_block")


def read(spark: SparkSession, file: str, ids=lambda c: c) -> DataFrame:
    """Per document of a file, decoded: id, start (ids of all documents before it), n_tokens, ids (unsigned 32-bit integers, little endian). ids: a function of the column of ids, applied before rows are shuffled."""
    shards = spark.read.schema(FILE).parquet(file)

    def decode(batches):
        keep_freed_memory()
        for batch in batches:
            for number, payload in zip(batch.column("shard").to_pylist(), batch.column("payload").to_pylist()):
                s = Shard(payload)
                sizes = s.sizes()
                at = np.concatenate([[0], np.cumsum(sizes)])
                raw = expand(s.symbols, s.left, s.right, s.base).astype("<u4").tobytes()
                yield pa.record_batch([
                    pa.array(np.full(s.n_docs, number, np.int32)), pa.array(np.arange(s.n_docs, dtype=np.int32)), pa.array(s.doc_ids, mask=s.doc_ids == _NULL), pa.array(at[:-1]), pa.array(sizes),
                    pa.Array.from_buffers(pa.binary(), s.n_docs, [None, pa.py_buffer((4 * at).astype(np.int32).tobytes()), pa.py_buffer(raw)]),
                ], ["shard", "place", "id", "before", "n_tokens", "ids"])

    many = shards.select("shard", "n_ids", F.floor(F.col("shard") / 1024).alias("part"))
    parts = many.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    inside = F.coalesce(F.sum("n_ids").over(Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = many.withColumn("inside", inside).join(parts, "part").select("shard", (F.col("first") + F.col("inside")).alias("first"))
    decoded = shards.select("shard", "payload").mapInArrow(decode, DECODED).withColumn("ids", ids(F.col("ids")))
    return decoded.join(first, "shard").select("id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids")
