"""Substring dedup over words: prefix-partitioned suffix trees, cut at the window's length.

Suffixes (one from each word on) are split by a prefix of their words. The prefix is one word long; where more than
GROUP suffixes share it, it is one word longer, and so on to the window's length, so every group's tree is built in memory.
``heavy_prefixes`` finds the prefixes to lengthen: with its hashes (below) a block reports a prefix whose share of GROUP it
exceeds, and the reports are summed; this finds all prefixes of more than 2 * GROUP suffixes, and no more than length * words / GROUP
in all, whatever the text. Groups are hashed to bins.

A suffix that shares its first ``length`` words with no other document is a leaf that hangs above that depth and belongs to no
deep node, so it is left out first: blocks send 32-bit hashes of their distinct windows to bins, which tell those that
more than one block sent. A chance collision costs a suffix that the tree then sets apart, never a result; bins are of
constant size, so such suffixes are less than one in a thousand at any size of the corpus. Answers and reports of this
screen are written to the shared folder; its texts and hashes have left the disk when words are shipped.

The rest are sorted word by word, in each block (``subtrees``) and, once for each of a block's deep nodes, with the
words themselves and the smallest document, in the group's bin. Sorted suffixes and the words that neighbours have in common
are the tree; an internal node at the window's depth is a run of neighbours that have ``length`` words in common. Words
are compared byte for byte. A bin answers for each suffix whether its node holds a smaller document. Longer maximal repeats
are rows of such nodes at consecutive positions, and the spans returned are these rows. A passage that all documents share
is as many suffixes in a bin as there are blocks.

Removed is each word in a window of ``length`` words whose sequence also starts in a document with a smaller id;
windows are judged on the input. Defined results: a null text has no words; a null id comes after all others; rows that
repeat an id are one document, and do not remove from each other; a document shorter than the window loses nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm import blocks
from strandline.llm.bpe import _pack, _unpack
from strandline.llm.hashing import mix, planes, unplanes, windows, word_hashes
from strandline.llm.store import written
from strandline.llm.text import whole

WINDOW = 13
GROUP = 2_000_000
SCHEMA = "id bigint, n_words bigint, n_removed bigint, kept_text string, span_start array<int>, span_end array<int>"
_LAST = np.iinfo(np.int64).max


def _sorted(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """By id, then text: packets arrive in any order, and a block is opened several times."""
    table = table.take(pc.sort_indices(table, [("id", "ascending"), ("text", "ascending")]))
    return table, table.column("id").fill_null(_LAST).to_numpy()


def report(h: np.ndarray, at: np.ndarray, length: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a block's prefixes of 1 to length - 1 words that more than least of its suffixes share, and how many do."""
    keys, n = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    stay = np.ones(len(h), bool)
    for p in range(1, length):
        if p > 1 and not stay.any():
            break
        hashed, i = windows(h, at, p)
        own, count = np.unique(hashed[stay[i]], return_counts=True)
        own, count = own[count > least], count[count > least]
        keys.append(own)
        n.append(count)
        left = np.zeros(len(h), bool)
        left[i] = stay[i] & np.isin(hashed, own)
        stay = left
    return np.concatenate(keys), np.concatenate(n)


def heavy_prefixes(notes: DataFrame, group: int = GROUP) -> np.ndarray:
    """Hashes of the prefixes of 1 to length - 1 words that are to be lengthened, from the reports of all blocks."""

    def opened(batches):
        for batch in batches:
            for payload in batch.column("payload").to_pylist():
                keys, n = np.frombuffer(_unpack(payload), "<i8").reshape(2, -1)
                yield pa.record_batch([pa.array(keys), pa.array(n)], ["prefix", "n"])

    found = notes.select("payload").mapInArrow(opened, "prefix bigint, n bigint").groupBy("prefix").agg(F.sum("n").alias("n")).where(F.col("n") > group)
    return np.sort(np.array([r[0] for r in found.collect()], np.int64).astype(np.uint64))


def group_keys(h: np.ndarray, at: np.ndarray, i: np.ndarray, heavy: np.ndarray, length: int) -> np.ndarray:
    """The group of the window at each of the positions i: the hash of its shortest prefix that is not heavy, or of itself."""
    out, open_ = np.zeros(len(h), np.uint64), np.zeros(len(h), bool)
    open_[i] = True
    for p in range(1, length + 1):
        hashed, j = windows(h, at, p)
        on = open_[j]
        hashed, j = hashed[on], j[on]
        out[j] = hashed
        if p < length:
            open_ = np.zeros(len(h), bool)
            open_[j] = np.isin(hashed, heavy)
        if not len(heavy) or not open_.any():
            break
    return out[i]


class _Block:
    """A block's windows by the hashes that are sent to the bins."""

    def __init__(self, table: pa.Table, bins: int, length: int):
        self.table, ids = _sorted(table)
        self.h, self.at = word_hashes(self.table.column("text"))
        hashed, self.i = windows(self.h, self.at, length)
        self.own = ids[np.searchsorted(self.at, self.i, "right") - 1]
        code = (mix(hashed + np.uint64(1)) % np.uint64(bins)) << np.uint64(32) | hashed >> np.uint64(32)
        self.code, first, self.inverse = np.unique(code, return_index=True, return_inverse=True)
        last = np.zeros(len(first), np.int64)
        last[self.inverse] = np.arange(len(code))
        self.inside = self.own[last] != self.own[first]  # documents are in the order of their ids
        self.bins, self.starts = np.unique(self.code >> np.uint64(32), return_index=True)

    def questions(self):
        for b, keys in zip(self.bins.tolist(), np.split(self.code.astype("<u4"), self.starts[1:])):
            yield b, len(keys), _pack(planes(np.diff(keys, prepend=np.uint32(0)), 4))

    def shared(self, answers: dict) -> np.ndarray:
        """Of each distinct hash, whether documents of this or another block share it."""
        bits = [np.unpackbits(np.frombuffer(_unpack(answers[b][1]), np.uint8), count=answers[b][0]) for b in self.bins.tolist()]
        return np.concatenate([*bits, np.zeros(0, np.uint8)]).astype(bool) | self.inside


def met_elsewhere(messages):
    """Of each hash, whether another message has it too."""
    parts = [np.cumsum(unplanes(_unpack(p), 4)) for _, p in messages]
    order = np.argsort(keys := np.concatenate(parts), kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    met = np.zeros(len(keys), bool)
    met[order[1:]] = same
    met[order[:-1]] |= same
    return [(len(k), _pack(np.packbits(m).tobytes())) for k, m in zip(parts, np.split(met, np.cumsum([len(k) for k in parts])[:-1]))]


def subtrees(words: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes that begin at starts in an array of word numbers, and the words (length at most) that each has in common with the one before it."""
    bits = max(1, int(words.max(initial=0)).bit_length())
    columns, step = [], 63 // bits
    for c in range(0, length, step):
        column = np.zeros(len(starts), np.int64)
        for k in range(c, min(c + step, length)):
            column = column << bits | words[starts + k]
        columns.append(column)
    order = np.lexsort(columns[::-1]) if len(starts) else np.zeros(0, np.int64)
    common = np.zeros(len(starts), np.int64)
    on, after = np.arange(1, len(starts)), starts[order]
    for k in range(length):
        on = on[words[after[on] + k] == words[after[on - 1] + k]]
        common[on] += 1
    return order, common


class _Subtree:
    """The deep nodes of a block's shared suffixes, in the order of their bins."""

    def __init__(self, block: _Block, shared: np.ndarray, heavy: np.ndarray, bins: int, length: int):
        on = shared[block.inverse]
        self.i, self.own, self.length = block.i[on], block.own[on], length
        words = pc.ascii_split_whitespace(block.table.column("text").cast(pa.large_string()).combine_chunks()).flatten()
        words = words.filter(pc.greater(pc.binary_length(words), 0)).cast(pa.large_binary()).dictionary_encode()
        self.words, self.numbers = pc.binary_join_element_wise(words.dictionary, *(pa.scalar(x, pa.large_binary()) for x in (b"", b" "))), words.indices.to_numpy()
        order, common = subtrees(self.numbers, self.i, length)
        new = common < length
        first = np.flatnonzero(new)
        self.node = np.zeros(len(order), np.int64)
        self.node[order] = np.cumsum(new) - 1
        self.start = self.i[order][first]
        self.doc = np.minimum.reduceat(self.own[order], first) if len(first) else np.zeros(0, np.int64)
        bin_ = (mix(group_keys(block.h, block.at, self.start, heavy, length) + np.uint64(1)) % np.uint64(bins)).astype(np.int64)
        self.order = np.argsort(bin_, kind="stable")
        self.bins, self.starts = np.unique(bin_[self.order], return_index=True)

    def per_bin(self):
        return zip(self.bins.tolist(), np.split(self.order, self.starts[1:]))

    def suffixes(self):
        for b, nodes in self.per_bin():
            ids = _pack(planes(self.doc[nodes], 8))
            text, _ = self.said(self.numbers[self.start[nodes][:, None] + np.arange(self.length)].ravel())
            yield b, len(nodes), len(ids).to_bytes(8, "little") + ids + _pack(text)

    def said(self, numbers: np.ndarray) -> tuple[pa.Buffer, np.ndarray]:
        """The words of these numbers, a space behind each, and where each begins, one more at the end."""
        words = self.words.take(pa.array(numbers))
        at = np.frombuffer(words.buffers()[1], np.int64)[: len(words) + 1]
        return (words.buffers()[2] or pa.py_buffer(b""))[: int(at[-1])], at


def _word_numbers(texts: list[bytes]) -> np.ndarray:
    """Numbers of the words of all texts, each of which a space ends."""
    parts = []
    for text in texts:
        ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 0x20)
        offsets = np.zeros(len(ends) + 1, np.int64)
        np.add(ends, 1, out=offsets[1:])
        parts.append(pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(text)]))
    coded = pa.chunked_array(parts, pa.large_binary()).dictionary_encode()  # one dictionary for all
    return np.concatenate([np.zeros(0, np.int32), *(c.indices.to_numpy() for c in coded.chunks)])


def _trees(length: int):
    def answer(messages):
        """Of each suffix, whether its deep node holds a document smaller than its own."""
        cut = [8 + int.from_bytes(p[:8], "little") for _, p in messages]
        doc = np.concatenate([unplanes(_unpack(p[8:c]), 8) for c, (_, p) in zip(cut, messages)])
        words = _word_numbers([_unpack(p[c:]) for c, (_, p) in zip(cut, messages)])
        order, common = subtrees(words, np.arange(len(doc)) * length, length)
        new = common < length
        smallest = np.minimum.reduceat(doc[order], np.flatnonzero(new))[np.cumsum(new) - 1]
        earlier = np.zeros(len(doc), bool)
        earlier[order] = smallest < doc[order]
        at = np.cumsum([n for n, _ in messages])[:-1]
        return [(len(e), _pack(np.packbits(e).tobytes())) for e in np.split(earlier, at)]

    return answer


def _screener(bins: int, length: int, least: int):
    def ask(packets: pa.Table) -> pa.Table:
        number = packets.column("block")[0].as_py()
        block = _Block(blocks.block_table(packets), bins, length)
        keys, n = report(block.h, block.at, length, least)
        return _asks(number, [(_note(number), -1 - len(keys), _pack(keys.astype("<u8").tobytes() + n.astype("<i8").tobytes())), *block.questions()])

    return ask


def _asker(heavy, bins: int, length: int):
    def ask(number: int, table: pa.Table, answers: dict) -> pa.Table:
        block = _Block(table, bins, length)
        shared = block.shared(answers)
        return _asks(number, [(_note(number), -1 - len(shared), _pack(np.packbits(shared).tobytes())), *_Subtree(block, shared, heavy, bins, length).suffixes()])

    return ask


def _asks(number: int, out: list) -> pa.Table:
    return pa.table([
        pa.array([x[0] for x in out], pa.int32()), pa.array([number] * len(out), pa.int32()), pa.array([x[1] for x in out], pa.int32()), pa.array([x[2] for x in out], pa.binary()),
    ], ["bin", "block", "n", "payload"])


def _note(block: int) -> int:
    """The bin of a block's note, which no other shares and which goes back as it is: its frequent prefixes, or which of its hashes are shared."""
    return -1 - block


def _noted(answer):
    return lambda messages: messages if messages[0][0] < 0 else answer(messages)


def _applier(heavy, bins: int, length: int):
    def apply(number: int, table: pa.Table, answers: dict) -> pa.Table:
        block = _Block(table, bins, length)
        n, note = answers[_note(number)]
        tree = _Subtree(block, np.unpackbits(np.frombuffer(_unpack(note), np.uint8), count=-1 - n).astype(bool), heavy, bins, length)
        earlier = np.zeros(len(tree.order), bool)
        for b, nodes in tree.per_bin():
            if answers[b][0] != len(nodes):
                raise ValueError("an answer does not fit its question")
            earlier[nodes] = np.unpackbits(np.frombuffer(_unpack(answers[b][1]), np.uint8), count=len(nodes)).astype(bool)
        repeated = tree.i[earlier[tree.node] | (tree.own > tree.doc[tree.node])]
        cover = np.zeros(len(block.h) + 1, np.int64)
        np.add.at(cover, repeated, 1)
        np.add.at(cover, repeated + length, -1)
        gone = np.cumsum(cover[:-1]) > 0
        at = block.at
        removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[at])
        text, place = tree.said(tree.numbers[~gone])
        text, place = text.to_pybytes(), place[np.concatenate([[0], np.cumsum(np.diff(at) - removed)])]
        starts, ends, kept = [], [], []
        for a, z, some, x, y in zip(at[:-1].tolist(), at[1:].tolist(), removed.tolist(), place[:-1].tolist(), place[1:].tolist()):
            edge = np.flatnonzero(np.diff(np.concatenate([[False], gone[a:z], [False]]))) if some else np.zeros(0, np.int64)
            starts.append(edge[::2])
            ends.append(edge[1::2])
            kept.append(text[x : max(x, y - 1)])  # without the last space
        return pa.table([
            block.table.column("id"), pa.array(np.diff(at)), pa.array(removed), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(starts, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32())),
        ], ["id", "n_words", "n_removed", "kept_text", "span_start", "span_end"])

    return apply


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = WINDOW, group: int = GROUP) -> DataFrame:
    """Per row of docs: id, n_words, n_removed, kept_text, and the removed spans [span_start, span_end) in words."""
    n_blocks, bins = blocks.counts(docs, text_col)
    slim = docs.select(F.col(id_col).cast("bigint").alias("id"), whole(text_col).alias("text"))
    packets = blocks.packed(slim.withColumn("block", blocks.dealt(slim, n_blocks)))
    by_block = packets.groupBy("block")
    asks = by_block.applyInArrow(_screener(bins, length, max(1, group // n_blocks)), blocks.ASKS)
    # Written, so that hashes and texts of the screen leave the disk before words are shipped, and the prefixes are reported on the way.
    screened = written(asks.groupBy("bin").applyInArrow(blocks.answered(_noted(met_elsewhere)), blocks.ANSWERS), "screened")
    heavy = heavy_prefixes(screened.where(F.col("bin") < 0), group)
    shared = screened.where(F.col("bin") >= 0)
    suffixes = by_block.cogroup(shared.groupBy("block")).applyInArrow(blocks.applier(_asker(heavy, bins, length)), blocks.ASKS)
    answers = suffixes.groupBy("bin").applyInArrow(blocks.answered(_noted(_trees(length))), blocks.ANSWERS)
    out = by_block.cogroup(answers.groupBy("block")).applyInArrow(blocks.applier(_applier(heavy, bins, length)), SCHEMA)
    return out.withColumnRenamed("id", id_col)
