"""What the substring operator's screen leaves on disk, and blocks whose packets arrive in another order."""

import random
import time

import numpy as np
import pyarrow as pa

from strandline.llm import substring


def shuffled(spark):
    """Sizes of the shuffle files of the session."""
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f.getName(): f.length() for f in (files.apply(i) for i in range(files.length())) if f.getName().endswith(".data")}


def test_screen_leaves_no_texts_on_disk(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(f"{rng.getrandbits(64):x}" for _ in range(200))) for i in range(400)]
    size = sum(len(t) for _, t in rows)
    df, before = spark.createDataFrame(rows, "doc_id long, text string"), shuffled(spark)
    out = substring.substring_dedup(df)
    for _ in range(40):  # files go in the background
        left = sum(n for name, n in shuffled(spark).items() if name not in before)
        if left < size / 20:
            break
        time.sleep(0.25)
    assert left < size / 20
    assert out.where("n_words = 200 and n_removed = 0").count() == len(rows)


def test_order_of_packets_does_not_matter():
    rng = random.Random(4)
    rows = [(rng.choice([1, 2, None]), " ".join(rng.choice("abcdef") for _ in range(12))) for _ in range(30)]
    sent = []
    for _ in range(4):
        rng.shuffle(rows)
        block = substring._Block(pa.table({"id": pa.array([d for d, _ in rows], pa.int64()), "text": pa.array([t for _, t in rows])}), 1, 3)
        tree = substring._Subtree(block, np.ones(len(block.code), bool), np.zeros(0, np.uint64), 5, 3)
        sent.append((list(block.questions()), list(tree.suffixes())))
    assert all(s == sent[0] for s in sent)


def test_words_of_messages_are_numbered_together():
    got = substring._word_numbers([b"a b a ", b"", "b é ".encode()]).tolist()
    assert got == [0, 1, 0, 1, 2]
