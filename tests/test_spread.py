"""Training rows are dealt by how much they hold, not by the documents' files."""

from retail_marts.operators import satisfaction as P


def test_vectors_of_training_rows_are_dealt_by_their_size(spark, monkeypatch):
    rows = [(i, f"good word{i % 7} bad" if i % 2 else f"other word{i % 5}", i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, "rating_id long, comment string, label int").coalesce(1)
    seen = []

    class Kept(P.MajorityBaseline):
        def _fit(self, x):
            seen.append((x.rdd.getNumPartitions(), x.count(), max(x.rdd.glom().map(len).collect())))
            return super()._fit(x)

    monkeypatch.setattr(P, "_classifier", lambda *a: Kept())
    for values, parts in ((1 << 24, 1), (1 << 10, 50)):
        monkeypatch.setattr(P, "PART_VALUES", values, raising=False)
        P.train(df, "rf", P.feature_pipeline([], [], "comment", num_text_features=256), weighted=True)
        assert seen[-1][0] == parts and seen[-1][1] == 200, seen
    assert seen[-1][2] <= 3 * 200 / 50


def test_texts_are_dealt_by_their_length(spark, monkeypatch):
    df = spark.createDataFrame([(i, "x" * 1000) for i in range(100)] + [(100, None)], "rating_id long, comment string").coalesce(1)
    assert P.spread_texts(df, "comment").rdd.getNumPartitions() == 1
    monkeypatch.setattr(P, "PART_VALUES", 5000)
    out = P.spread_texts(df, "comment")
    assert out.rdd.getNumPartitions() == 20 and out.count() == 101
    assert P.spread_texts(df.where("comment IS NULL"), "comment").count() == 1


def test_partitions_are_few_enough_for_the_trees_statistics(spark):
    """Every partition sends statistics of every node of the trees, so a quarter of a GB has two and not four."""
    df = spark.range(400)
    assert P.spread(df, 100 << 25).rdd.getNumPartitions() == 100
    assert 4 * P.PART_VALUES <= 150_000_000  # MB that a task reads of cached rows, whatever the input
