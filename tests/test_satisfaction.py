import random

import pytest
from pyspark.sql import functions as F

from retail_marts.operators import satisfaction as P

WORDS = "alpha beta gamma delta epsilon zeta theta iota kappa lambda mu nu xi omicron pi rho".split()


def _signal(spark, n=600, shuffle=False):
    """signal_planted: label follows x1 and the word 'excellent'."""
    rnd = random.Random(11)
    rows = []
    for i in range(n):
        x1, x2 = rnd.random(), rnd.random()
        good_word = rnd.random() < 0.4
        text = " ".join(rnd.choice(WORDS) for _ in range(rnd.randint(5, 30)))
        if good_word:
            text += " excellent"
        label = int(x1 + (0.6 if good_word else 0.0) > 0.8)
        rows.append((i, x1, x2, rnd.choice(["a", "b"]), f"{text} n{i}", label))
    if shuffle:
        labels = [r[-1] for r in rows]
        rnd.shuffle(labels)
        rows = [r[:-1] + (lab,) for r, lab in zip(rows, labels)]
    df = spark.createDataFrame(rows, "id bigint, x1 double, x2 double, cat string, text string, label int")
    df = P.split_flag(df, "text", 0.3)
    # a category seen only in the test part
    return df.withColumn("cat", F.when((F.col("part") == "test") & (F.col("id") % 5 == 0), "z")
                                  .otherwise(F.col("cat")))


def _fit_eval(df, kind):
    train = df.filter("part = 'train'").drop("part")
    test = df.filter("part = 'test'").drop("part")
    m = P.train(train, kind, P.feature_pipeline(["x1", "x2"], ["cat"], "text", num_text_features=1 << 10),
                weighted=(kind != "baseline"))
    return P.evaluate(P.scored(m, test, ["id", "label"]), "label", "score", 0.5).collect()


@pytest.mark.parametrize("kind", ["logreg", "rf", "gbt"])
def test_planted_signal_is_found(spark, kind):
    res = _fit_eval(_signal(spark), kind)
    assert res[0].auc > 0.9, res


def test_shuffled_target_gives_chance(spark):
    res = _fit_eval(_signal(spark, shuffle=True), "logreg")
    assert abs(res[0].auc - 0.5) < 0.12, res


def test_baseline_predicts_majority(spark):
    res = {r["class"]: r for r in _fit_eval(_signal(spark), "baseline")}
    assert res[1].auc is None or res[1].auc == 0.5
    assert res[0].predicted + res[1].predicted == res[0].support + res[1].support


def test_auc_exact_with_ties_against_all_pairs(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.randint(0, 1), float(rnd.randint(0, 9))) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, label int, s double")
    pos = [s for _, y, s in rows if y == 1]
    neg = [s for _, y, s in rows if y == 0]
    brute = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert P.auc(df, "label", "s", rows_per_bucket=3) == pytest.approx(brute, abs=1e-12)
    ev = {r["class"]: r for r in P.evaluate(df, "label", "s", 5.0).collect()}
    tp = sum(1 for _, y, s in rows if y == 1 and s >= 5)
    fp = sum(1 for _, y, s in rows if y == 0 and s >= 5)
    fn = sum(1 for _, y, s in rows if y == 1 and s < 5)
    assert ev[1].correct == tp and ev[1].predicted == tp + fp and ev[1].support == tp + fn
    assert ev[1].f1 == pytest.approx(2 * tp / (2 * tp + fp + fn))
    assert ev[1].base_rate == pytest.approx(len(pos) / len(rows))


def test_split_is_grouped_and_stable(spark):
    df = spark.createDataFrame([(i, f"text {i % 50}") for i in range(500)], "id int, t string")
    a = {r.id: r.part for r in P.split_flag(df, "t", 0.3).collect()}
    b = {r.id: r.part for r in P.split_flag(df.repartition(9), "t", 0.3).collect()}
    assert a == b
    by_text = {}
    for i, p in a.items():
        by_text.setdefault(i % 50, set()).add(p)
    assert all(len(v) == 1 for v in by_text.values())
    share = sum(1 for p in a.values() if p == "test") / len(a)
    assert 0.1 < share < 0.5


def test_training_rows_and_unlabelled(spark):
    cand = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, t string")
    labels = spark.createDataFrame([(1, 5), (1, 2), (2, 1)], "k int, score int")
    lab, unl = P.training_rows(cand, labels, "k", "score", cut=4)
    assert sorted((r.k, r.label) for r in lab.collect()) == [(1, 1), (2, 0)]
    assert [r.k for r in unl.collect()] == [3]


def test_score_batch_writes_with_version(spark, tmp_out):
    df = _signal(spark, 200)
    train = df.filter("part = 'train'").drop("part")
    m = P.train(train, "logreg", P.feature_pipeline(["x1"], ["cat"], "text", num_text_features=1 << 8))
    path = tmp_out + "/scores"
    P.score_batch(m, df.drop("label"), "id", path, version="v7")
    back = spark.read.parquet(path)
    assert back.count() == 200 and back.select("model_version").distinct().collect()[0][0] == "v7"
    assert back.filter((F.col("score") < 0) | (F.col("score") > 1)).count() == 0


def test_a_repeated_run_replaces_its_own_version_alone(spark, tmp_out):
    df = _signal(spark, 200)
    m = P.train(df.filter("part = 'train'").drop("part"), "logreg", P.feature_pipeline(["x1"], ["cat"], "text", num_text_features=1 << 8))
    path = tmp_out + "/scores"
    rows = df.drop("label")
    P.score_batch(m, rows, "id", path, version="v1")
    P.score_batch(m, rows.limit(50), "id", path, version="v2")
    again = P.score_batch(m, rows.limit(70), "id", path, version="v1")
    assert again.count() == 70 and {r.model_version for r in again.collect()} == {"v1"}
    stored = P.read_scores(spark, path, df.schema["id"].dataType, "id")
    assert {r.model_version: r["count"] for r in stored.groupBy("model_version").count().collect()} == {"v1": 70, "v2": 50}
    plan = stored.where("model_version = 'v2'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(model_version" in plan
