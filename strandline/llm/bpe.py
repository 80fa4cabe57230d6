"""BPE encoding and decoding through a table of distinct words.

A text's ids are the ids of its words (runs without ASCII white space) one after the other, for tokenizers whose
pre-tokenizer splits at white space and drops it, and whose normalizer and special tokens do not reach across it;
``check_splits`` refuses others. So every distinct word is encoded once (for each blocks.WAVE blocks, 128 GB of text): blocks of documents ask for their distinct
words, a bin encodes each word that it was asked for once and answers with ids, and the block joins the ids back by
the words' positions (see blocks). Decoding joins ids with the tokenizer's table of pieces, whose size is the
vocabulary's, and puts one space between pieces, as a tokenizer without a decoder does.

The tokenizer's file is a parameter and is opened by each task where it runs; nothing is trained.

Defined results: null and empty texts have no ids and decode to the empty text; a text of white space alone likewise;
repeated rows and null ids are rows of their own; other columns are not carried. A special token's string in a text is
that token, as the library has it. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import itertools
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm import blocks
from strandline.llm.hashing import planes, ragged, unplanes, word_hashes
from strandline.llm.text import whole

SCHEMA = "id bigint, n_tokens bigint, ids array<int>, decoded string"


@functools.cache
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(path)
    out.no_padding()
    out.no_truncation()
    return out


@functools.cache
def pieces(path: str) -> np.ndarray:
    """Piece of each id."""
    by_piece = tokenizer(path).get_vocab(with_added_tokens=True)
    out = np.full(max(by_piece.values()) + 1, "", dtype=object)
    for piece, i in by_piece.items():
        out[i] = piece
    return out


def check_splits(path: str) -> None:
    """Raises unless the tokenizer's ids for a text are those of its words in turn, and its decoding is pieces with spaces between."""
    t = tokenizer(path)
    for text in ("a b", " The  cat's\t12 hats,\nété x<|endoftext|>y ́z ΣΣ ", "ﬁn 1½  q"):
        ids = [i for w in text.encode().split() for i in t.encode(w.decode(), add_special_tokens=False).ids]
        whole_ids = t.encode(text, add_special_tokens=False).ids
        if ids != whole_ids or " ".join(pieces(path)[ids]) != t.decode(ids, skip_special_tokens=False):
            raise ValueError("this tokenizer does not split at white space, or has a decoder")


def _pack(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(packed: bytes) -> bytes:
    return pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), codec="zstd", asbytes=True)


class Words:
    """A block's texts as numbers of its distinct words, which come in the order of their bins."""

    def __init__(self, texts: pa.ChunkedArray, bins: int):
        texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
        texts = pa.concat_arrays(texts.chunks) if isinstance(texts, pa.ChunkedArray) else texts
        split = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
        words = split.flatten()
        self.at = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64))])
        said = pc.greater(pc.binary_length(words), 0)
        if not pc.all(said).as_py():  # white space at a text's ends leaves empty ones
            self.at = np.concatenate([[0], np.cumsum(said.to_numpy(zero_copy_only=False))])[self.at]
            words = words.filter(said)
        coded = words.dictionary_encode()
        distinct = coded.dictionary
        bin_ = (word_hashes(distinct)[0] % np.uint64(bins)).astype(np.int64)
        by_bin = np.argsort(bin_, kind="stable")
        rank = np.empty(len(distinct), np.int64)
        rank[by_bin] = np.arange(len(distinct))
        self.number = rank[coded.indices.to_numpy()]  # of each word of the texts
        self.words, self.edges = distinct.take(pa.array(by_bin)).cast(pa.string()), np.searchsorted(bin_[by_bin], np.arange(bins + 1))

    def messages(self):
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(self.edges, pa.int32()), self.words), " ")
        for b, n in enumerate(np.diff(self.edges).tolist()):
            if n:
                yield b, n, _pack(joined[b].as_py().encode())

    @classmethod
    def noted(cls, payload: bytes) -> Words:
        """What note gives, opened: without the words themselves."""
        out, raw = cls.__new__(cls), _unpack(payload)
        n_texts, n_bins, _ = np.frombuffer(raw[:24], "<i8").tolist()
        cuts = np.cumsum([24, 8 * n_texts, 8 * n_bins])
        out.at, out.edges, out.number = np.frombuffer(raw[cuts[0] : cuts[1]], "<i8"), np.frombuffer(raw[cuts[1] : cuts[2]], "<i8"), unplanes(raw[cuts[2] :], 4)
        return out

    def note(self) -> bytes:
        """The places of the texts and the numbers of their words, packed."""
        sizes = np.array([len(self.at), len(self.edges), len(self.number)], "<i8")
        return _pack(b"".join((sizes.tobytes(), self.at.astype("<i8").tobytes(), self.edges.astype("<i8").tobytes(), planes(self.number, 4))))

    def ids(self, answers: dict) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each distinct word, and all their ids."""
        n, ids = [np.zeros(0, "<u4")], [np.zeros(0, "<u4")]
        for b, (x, y) in enumerate(zip(self.edges[:-1].tolist(), self.edges[1:].tolist())):
            if y > x:
                size, raw = answers[b][0], _unpack(answers[b][1])
                if size != y - x:
                    raise ValueError("an answer does not fit its question")
                n.append(unplanes(raw[: 4 * size], 4))
                ids.append(unplanes(raw[4 * size :], 4).astype("<u4"))
        return np.concatenate(n).astype(np.int64), np.concatenate(ids)

    def text_ids(self, n: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the place where each text's begin, one more at the end."""
        count = n[self.number]
        at = np.concatenate([[0], np.cumsum(count)])[self.at]
        return ids[ragged((np.cumsum(n) - n)[self.number], count)], at


@functools.cache
def _ends(path: str) -> np.ndarray | None:
    """For a tokenizer that reads letters without their case, keeps them apart from a sign behind them, and marks the last piece of a run of letters: which ids are marked. None for others."""
    t, piece = tokenizer(path), pieces(path)
    plain = lambda x: t.encode(x, add_special_tokens=False).ids
    suffix = getattr(t.model, "end_of_word_suffix", None)
    ok = bool(suffix) and all((not w.isascii() or plain(w.upper()) == plain(w)) and all(plain(w + x) == plain(w) + plain(x) for x in SIGNS) for w in ("cat", "the", "zqxjkv", "electroencephalography", "straße", "Émilie"))
    return np.array([x.endswith(suffix) for x in piece]) if ok else None


#: Signs that often stand behind a word.
SIGNS = ".,;:!?"
#: Letters that normalisation and lower case leave single letters.
LATIN = "^[A-Za-zÀ-ÖØ-öø-ÿ]+$"


def _run(t, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Number of ids of each text, and all their ids."""
    n, flat = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
    for k in range(0, len(texts), 4096):
        ids = [e.ids for e in t.encode_batch_fast(texts[k : k + 4096], add_special_tokens=False)]
        n.append(np.fromiter(map(len, ids), np.int64, len(ids)))
        flat.append(np.fromiter(itertools.chain.from_iterable(ids), np.uint32, int(n[-1].sum())))
    return np.concatenate(n), np.concatenate(flat)


def encoded(path: str, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Number of ids of each word, and all their ids. Where the tokenizer allows it (see _ends), words of Latin letters that differ in a sign behind them, or in the case of ASCII letters, are encoded once, and many in one call, told apart by the marks of their last pieces: each has one mark at least, so as many marks as words are one each."""
    t, ends = tokenizer(path), _ends(path)
    last = pc.utf8_slice_codeunits(words, -1, None)
    signed = pc.and_(pc.is_in(last, pa.array(list(SIGNS), words.type)), pc.greater(pc.utf8_length(words), 1))
    stem = pc.if_else(signed, pc.utf8_slice_codeunits(words, 0, -1), words)
    plain = pc.and_(pc.match_substring_regex(stem, LATIN), ends is not None)
    coded = pc.if_else(plain, pc.if_else(pc.string_is_ascii(stem), pc.ascii_lower(stem), stem), words).dictionary_encode()
    sign = pc.if_else(pc.and_(plain, signed), pc.index_in(last, pa.array(list(SIGNS), words.type)), len(SIGNS)).to_numpy(zero_copy_only=False).astype(np.int64)
    stems = coded.dictionary
    letters = pc.and_(pc.match_substring_regex(stems, LATIN), ends is not None).to_numpy(zero_copy_only=False)
    at, batch = np.flatnonzero(letters), 256
    edges = np.append(np.arange(0, len(at), batch), len(at))
    joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(edges), stems.filter(pa.array(letters))), pa.scalar(" ", stems.type)).to_pylist()
    order, n_ids, all_ids, other = [], [], [], [np.flatnonzero(~letters)]
    for k in range(0, len(joined), 128):
        for i, e in enumerate(t.encode_batch_fast(joined[k : k + 128], add_special_tokens=False), k):
            got, own = np.array(e.ids, np.uint32), at[i * batch : (i + 1) * batch]
            ended = np.flatnonzero(ends[got]) + 1
            if len(ended) != len(own) or ended[-1] != len(got):
                other.append(own)  # not told apart; one by one, then
            else:
                order.append(own)
                n_ids.append(np.diff(ended, prepend=0))
                all_ids.append(got)
    rest = np.concatenate(other)
    n, flat = _run(t, stems.take(pa.array(rest)).to_pylist())
    order, n, flat = np.concatenate([*order, rest]), np.concatenate([*n_ids, n]), np.concatenate([*all_ids, flat])
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    n_tail, tails = _run(t, list(SIGNS))
    n_tail, of = np.append(n_tail, 0), place[coded.indices.to_numpy()]
    both = n[of] + n_tail[sign]
    out, at = np.empty(int(both.sum()), np.uint32), np.cumsum(both) - both
    out[ragged(at, n[of])] = flat[ragged((np.cumsum(n) - n)[of], n[of])]
    out[ragged(at + n[of], n_tail[sign])] = tails[ragged((np.cumsum(n_tail) - n_tail)[sign], n_tail[sign])]
    return both, out


def asker(bins: int):
    def ask(table: pa.Table):
        return Words(table.column("text"), bins).messages()

    return ask


def answerer(path: str):
    def answer(messages):
        asked = [pc.split_pattern(pa.array([_unpack(p).decode("utf-8", "replace")], pa.large_string()), " ").flatten() for _, p in messages]
        coded = pa.chunked_array(asked).combine_chunks()
        coded = (pa.concat_arrays(coded.chunks) if isinstance(coded, pa.ChunkedArray) else coded).dictionary_encode()
        n, flat = encoded(path, coded.dictionary)
        own, first, out, at = coded.indices.to_numpy(), np.cumsum(n) - n, [], 0
        for words in asked:
            mine = own[at : at + len(words)]
            at += len(words)
            out.append((len(mine), _pack(planes(n[mine], 4) + planes(flat[ragged(first[mine], n[mine])], 4))))
        return out

    return answer


def _applier(path: str, bins: int, decode: bool):
    def apply(block: int, table: pa.Table, answers: dict) -> pa.Table:
        words = Words(table.column("text"), bins)
        n, ids = words.ids(answers)
        flat, at = words.text_ids(n, ids)
        decoded = [None] * len(table)
        if decode:
            piece, ends = pieces(path)[ids].tolist(), np.cumsum(n)
            said = np.array([" ".join(piece[e - k : e]) for e, k in zip(ends.tolist(), n.tolist())], dtype=object)
            some = n[words.number] > 0
            ends = np.concatenate([[0], np.cumsum(some)])[words.at]
            spoken = said[words.number[some]].tolist()
            decoded = [" ".join(spoken[x:y]) for x, y in zip(ends[:-1].tolist(), ends[1:].tolist())]
        return pa.table([
            table.column("id"), pa.array(np.diff(at)), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(flat.astype(np.int32))), pa.array(decoded, pa.string()),
        ], ["id", "n_tokens", "ids", "decoded"])

    return apply


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decode: bool = True) -> DataFrame:
    """Per row of docs: id, n_tokens, ids (array of int), decoded (null without decode)."""
    check_splits(path)
    n_blocks, bins = blocks.counts(docs, text_col, waves=True)
    slim = docs.select(F.col(id_col).cast("bigint").alias("id"), whole(text_col).alias("text"))
    packets = blocks.packed(slim.withColumn("block", blocks.dealt(slim, n_blocks)))
    out = blocks.ask_and_answer(packets, asker(bins), answerer(path), _applier(path, bins, decode), SCHEMA, waves=True)
    return out.withColumnRenamed("id", id_col)
