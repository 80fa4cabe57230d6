"""Frequent shingles are known from all texts."""

from strandline.llm import order_minhash


def test_heavy_bins_count_all_rows(spark):
    slim = spark.createDataFrame([(i, "one two three four five six seven") for i in range(64)], "id long, text string")
    bins, counts = order_minhash.heavy_bins(slim)
    assert len(bins) == 3 and set(counts.tolist()) == {64}


def test_a_task_gives_a_row_for_each_range_of_bins():
    import pyarrow as pa

    texts = pa.array([" ".join(f"w{i}" for i in range(20000))])
    (batch,) = order_minhash._bin_counts([pa.record_batch([texts], ["text"])])
    assert batch.num_rows <= 256
