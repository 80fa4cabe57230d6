"""Blocks of documents that ask bins of keys, and are answered.

Joining every word occurrence of a corpus with a table costs a row for each occurrence, twice. These operators shuffle
packed rows instead. Documents are dealt into blocks of about BLOCK_BYTES; a block asks for each of its distinct keys
once, in one binary message for each bin of keys; a bin gathers the messages of all blocks, works out one answer for
each key, and answers each block in the order of its message; the block's documents meet the answers again in a
co-group. Documents travel compressed, in packets of those of one block in one batch. A very frequent key is one entry of a message for each block, never a row for each occurrence, so neither a
hot word nor a group of copies makes a large task. Blocks and bins both grow in number with the corpus, so what one
task holds stays bounded: a block's text, or a bin's share of the distinct keys. The messages are as many as blocks times bins;
where an answer depends on its key alone (ids of a word) each WAVE blocks have bins of their own, so their number grows as
the corpus does. Where it depends on all blocks (counts, first documents) it grows faster, up to a message for each key.

Everything a task does follows from its input rows, so a lost executor's tasks can run again anywhere.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm.text import whole

#: Bytes of text in a block, and of text for which there is a bin.
BLOCK_BYTES = 8 << 20
BIN_BYTES = 16 << 20
LEAST_BINS = 12
#: Blocks whose questions may meet in the same bins, where an answer depends on its key alone.
WAVE = 16384

PACKETS = "block int, packet binary"
ASKS = "bin int, block int, n int, payload binary"
ANSWERS = "block int, bin int, n int, payload binary"


def counts(docs: DataFrame, text_col: str, block_bytes: int = BLOCK_BYTES, bin_bytes: int = BIN_BYTES, waves: bool = False) -> tuple[int, int]:
    """Numbers of blocks and of bins, from the bytes of all texts; with waves, of bins for WAVE blocks at most, so that a block's messages stay as many however large the corpus is."""
    total = docs.agg(F.sum(F.octet_length(whole(text_col)))).first()[0] or 0
    return max(1, -(-total // block_bytes)), max(LEAST_BINS, -(-(min(total, WAVE * block_bytes) if waves else total) // bin_bytes))


def dealt(docs: DataFrame, n_blocks: int, text_col: str = "text") -> Column:
    """The block of a row: by the hash of its columns, so repeated ids do not gather."""
    return F.pmod(F.xxhash64(*(c for c in docs.columns)), F.lit(n_blocks)).cast("int")


def packed(rows: DataFrame) -> DataFrame:
    """rows (with a column block) as compressed packets, some for each block; block_table() opens a block's."""

    def pack(batches):
        write = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))
        for batch in batches:
            block = batch.column("block").to_numpy(zero_copy_only=False)
            order = np.argsort(block, kind="stable")
            own, starts = np.unique(block[order], return_index=True)
            rest = pa.Table.from_batches([batch]).drop_columns(["block"])
            packets = []
            for places in np.split(order, starts[1:]):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, rest.schema, options=write) as out:
                    out.write_table(rest.take(places).combine_chunks())
                packets.append(sink.getvalue().to_pybytes())
            yield pa.record_batch([pa.array(own.astype(np.int32)), pa.array(packets, pa.binary())], ["block", "packet"])

    return rows.mapInArrow(pack, PACKETS)


def block_table(packets: pa.Table) -> pa.Table:
    """The rows of one block."""
    return pa.concat_tables([pa.ipc.open_stream(p).read_all() for p in packets.column("packet").to_pylist()]).combine_chunks()


def wave() -> Column:
    return F.floor(F.col("block") / WAVE).alias("wave")


def ask_and_answer(packets: DataFrame, ask: Callable, answer: Callable, apply: Callable, schema: str, waves: bool = False) -> DataFrame:
    """packets: of rows. ask(table) yields (bin, n, payload); answer(messages) takes a list of (n, payload) and returns a list of them, one for each; apply(block, table, answers) takes {bin: (n, payload)} and returns a table of the schema. With waves each WAVE blocks have bins of their own."""
    answers = packets.groupBy("block").applyInArrow(asker(ask), ASKS).groupBy(*([wave()] if waves else []), "bin").applyInArrow(answered(answer), ANSWERS)
    return packets.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(applier(apply), schema)


def asker(ask):
    def run(packets: pa.Table) -> pa.Table:
        block = packets.column("block")[0].as_py()
        out = list(ask(block_table(packets)))
        return pa.table([
            pa.array([x[0] for x in out], pa.int32()), pa.array([block] * len(out), pa.int32()), pa.array([x[1] for x in out], pa.int32()), pa.array([x[2] for x in out], pa.binary()),
        ], ["bin", "block", "n", "payload"])

    return run


def answered(answer):
    def run(table: pa.Table) -> pa.Table:
        out = answer(list(zip(table.column("n").to_pylist(), table.column("payload").to_pylist())))
        return pa.table([
            table.column("block"), table.column("bin"), pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.binary()),
        ], ["block", "bin", "n", "payload"])

    return run


def applier(apply):
    def run(packets: pa.Table, answers: pa.Table) -> pa.Table:
        got = {b: (n, p) for b, n, p in zip(answers.column("bin").to_pylist(), answers.column("n").to_pylist(), answers.column("payload").to_pylist())}
        return apply(packets.column("block")[0].as_py(), block_table(packets), got)

    return run
