"""Toxicity's shards are packed once and whole; averages of changes don't depend on the order or the cluster."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from retail_marts.llm import cnn_toxicity as C
from retail_marts.llm import text as T
from retail_marts.llm.common import Scratch


def test_shards_hold_every_word_and_label(spark):
    r = np.random.default_rng(12)
    rows = [(i, " ".join(r.choice([f"w{k}" for k in range(300)], int(n))), int(i % 3 == 0), i % 4) for i, n in enumerate(r.integers(0, 90, 120))]
    rows += [(200, None, 1, 2), (201, "", 0, 2), (202, "long " * 300_000, 1, 2)]
    fit = spark.createDataFrame(rows, "doc_id long, text string, toxic int, shard long").withColumn("place", F.xxhash64("doc_id"))
    known = np.unique(C.buckets(T.Words(pa.array([f"w{k}" for k in range(200)]), T.ALNUM))).astype(np.int64)
    model = C.Model(known, None, None, None)
    scratch = Scratch(spark, "test")
    got = C._shards(fit.repartition(5), model, scratch).collect()
    assert sorted(x["shard"] for x in got) == [0, 1, 2, 3]
    order = {x["doc_id"]: x["place"] for x in fit.collect()}
    for x in got:
        own = sorted((d for d in rows if d[3] == x["shard"]), key=lambda d: (order[d[0]], d[0]))
        words, sizes = np.frombuffer(x["words"], np.int32), np.frombuffer(x["sizes"], np.int32)
        w = T.Words(pa.array([d[1] for d in own], pa.string()), T.ALNUM)
        ids = np.frombuffer(x["buckets"], np.int32).reshape(-1, 3)
        assert np.array_equal(ids[words], model.rows(C.buckets(w))) and sizes.tolist() == np.diff(w.starts).tolist()
        assert len(ids) == np.unique(w.hash).size and list(x["toxic"]) == [d[2] for d in own]
    scratch.close()


def test_means_are_those_of_the_shards_that_saw_a_bucket():
    r = np.random.default_rng(13)
    seen = [np.sort(r.choice(C.BLOCK, 300, replace=False)).astype(np.uint16) for _ in range(9)]
    change = [r.normal(0, 10.0 ** r.integers(-6, 2, (300, 1)), (300, 2 * C.DIM)).astype(np.float16) for _ in seen]
    def mean(order):
        return C._mean(pa.table({"block": pa.array([4] * 9, pa.int32()), "rows": pa.array([seen[k].tobytes() for k in order], pa.binary()),
                                 "change": pa.array([change[k].tobytes() for k in order], pa.binary())}))
    out = mean(range(9))
    assert out.equals(mean(r.permutation(9)))
    own = np.frombuffer(out["rows"][0].as_py(), np.uint16)
    assert own.tolist() == sorted(set(np.concatenate(seen).tolist()))
    want = [np.mean([c[s.tolist().index(b)].astype(float) for s, c in zip(seen, change) if b in s], 0) for b in own]
    assert np.allclose(np.frombuffer(out["change"][0].as_py(), np.float32).reshape(-1, 2 * C.DIM), want, atol=1e-6)


def test_model_does_not_depend_on_the_cluster(spark):
    r = np.random.default_rng(14)
    rows = [(i, " ".join(r.choice([f"w{k}" for k in range(400)], 60)) + (" foul" if i % 4 == 0 else ""), "en", int(i % 4 == 0)) for i in range(240)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    a, b = (C.train(x.select("doc_id", "text", "lang"), x.select("doc_id", "toxic"), F.lit(True), shard=60, rounds=2, epochs=2) for x in (df.coalesce(1), df.repartition(6)))
    assert np.array_equal(a.net.emb, b.net.emb) and np.array_equal(a.shift, b.shift) and all(np.array_equal(x, y) for x, y in zip(a.net.filt, b.net.filt))
