"""Near duplicates in buckets of many different texts, and mixing of rows that share ids."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from retail_marts.llm import poisson_mix, probminhash
from retail_marts.llm import text as T


def test_a_template_of_many_texts_pairs_nobody_and_loses_no_link(spark, monkeypatch):
    """Texts that share most words (similarity 0.65 to 0.79), with a few true links among them."""
    r = np.random.default_rng(8)
    shared = [f"t{i}" for i in range(180)]
    rows, linked = [], 0
    for i in range(400):
        own = [f"o{i}_{j}" for j in range(int(r.integers(26, 40)))]
        rows.append((i, " ".join(shared + own)))
        if i % 40 == 0:  # a near copy of this one
            rows.append((1000 + i, " ".join(shared + own[:-1] + ["other"])))
            linked += 1
    asked = []
    similar = probminhash._linked
    monkeypatch.setattr(probminhash, "_linked", lambda src, node, pairs, t, s: asked.append(s.put(pairs.distinct(), "asked").count()) or similar(src, node, pairs, t, s))
    got = probminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    classes = {x.doc_id: x.class_id for x in got}
    assert all(classes[1000 + i] == i for i in range(0, 400, 40)) and len(set(classes.values())) == 400
    assert sum(asked) < 12 * len(rows), asked


def test_rare_shingles_reach_every_pair_at_the_threshold():
    """The bound behind the filter: similarity is at most 1 / (1/X + 1/Y - 1)."""
    r = np.random.default_rng(9)
    for _ in range(300):
        n, k = int(r.integers(2, 30)), int(r.integers(0, 6))
        h = np.sort(r.choice(10_000, n + 2 * k, replace=False)).astype(np.uint64)
        who = r.permutation(n + 2 * k)
        a, b = np.sort(who[:n + k]), np.sort(np.concatenate([who[:n], who[n + k:]]))
        x, y = r.dirichlet(np.ones(a.size)), r.dirichlet(np.ones(b.size))
        both = np.intersect1d(a, b)
        X, Y = x[np.isin(a, both)].sum(), y[np.isin(b, both)].sum()
        assert probminhash.probability_jaccard(h[a], x, h[b], y) <= 1 / (1 / X + 1 / Y - 1) + 1e-12


def test_different_texts_under_one_id_are_kept(spark):
    rows = [(1, "one two three four five six"), (1, "alpha beta gamma delta epsilon zeta"), (2, "one two three four five six"), (2, "red green blue black white grey"),
            (3, "red green blue black white grey"), (3, "red green blue black white grey"), (None, "one two three four five six"), (4, None), (4, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("x")).withColumn("class_id", F.lit(1))
    got = sorted((x.doc_id or -1, x.text or "") for x in corpus_pipeline.near_duplicates(spark, df, "").collect())
    assert got == sorted([(-1, rows[0][1]), (1, rows[0][1]), (1, rows[1][1]), (2, rows[3][1]), (4, ""), (4, "")])


@pytest.mark.parametrize("seed", ["mix-1", "mix-2", "mix-3"])
def test_rows_that_share_an_id_draw_for_themselves(spark, seed):
    rows = [(None, f"text {i}", "a") for i in range(600)] + [(7, f"text {i}", "a") for i in range(600)] + [(8, "same", "a")] * 600
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = poisson_mix.mix(df, {"a": 1.0}, seed=seed)
    n = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert all(500 < n[i] < 700 for i in (None, 7, 8))  # 600 expected, standard deviation 24
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        again = poisson_mix.mix(df.repartition(3), {"a": 1.0}, seed=seed)
        assert [tuple(r) for r in out.collect()] == [tuple(r) for r in again.collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
