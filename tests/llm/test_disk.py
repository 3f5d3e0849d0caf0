"""What rounds of training leave on disk."""

import os
import time

import numpy as np
from pyspark.sql import functions as F

from retail_marts.llm import cnn_toxicity


def _on_disk(spark):
    """(shuffle files, Python broadcasts) that are there now."""
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return sum(n.startswith("shuffle_") for n in names), len(os.listdir(spark.sparkContext._temp_dir))


def test_rounds_of_toxicity_leave_no_shuffles_or_models(spark):
    r = np.random.default_rng(3)
    rows = [(i, " ".join(r.choice([f"w{k}" for k in range(4000)], 150)) + (" foul" if i % 4 == 0 else ""), "en", i % 4 == 0) for i in range(240)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, bad boolean")
    labels = df.select("doc_id", F.col("bad").cast("int").alias("toxic"))
    before = _on_disk(spark)
    model = cnn_toxicity.train(df.select("doc_id", "text", "lang"), labels, F.lit(True), shard=48, rounds=5, epochs=2)
    assert model.known.size * 16 * 8 > 1 << 20  # a model that Spark would broadcast in a closure, too
    for _ in range(50):  # files go a little after their query
        left = _on_disk(spark)
        if left[0] <= before[0] and left[1] <= before[1]:
            break
        time.sleep(0.2)
    assert left[0] <= before[0] and left[1] <= before[1], (before, left)


def test_sums_by_key_add_in_order():
    r = np.random.default_rng(4)
    key, values = r.integers(0, 50, 700).astype(np.int32), r.normal(size=(700, 3)).astype(np.float32)
    u, total = cnn_toxicity._sums_by(key, values)
    assert (u == np.unique(key)).all() and np.allclose(total, [values[key == k].sum(0) for k in u], atol=1e-4)
    assert cnn_toxicity._sums_by(key[:0], values[:0])[1].shape == (0, 3)
