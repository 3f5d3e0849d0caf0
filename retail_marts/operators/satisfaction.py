"""Satisfaction prediction: training rows (P1), feature pipeline (P2),
grouped split (P3), models (P4), evaluation (P5), batch scoring (P6).

The reference names "predictive models of customer satisfaction" but no
target, features, algorithm or metric. Here the target is a 0/1 label (or a
score at or above a cut), the features are the review's own text, length,
language and source, and the models are ``pyspark.ml`` estimators. Every
fitted stage (indexers, IDF, scaler) sees training rows only.
"""

from __future__ import annotations

import datetime as _dt

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import (
    HashingTF, IDF, OneHotEncoder, RegexTokenizer, StandardScaler, StringIndexer, VectorAssembler,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retail_marts.functions.columns import ratio
from retail_marts.operators.ranking import running_total


# P1 ----------------------------------------------------------------------------

def training_rows(candidates: DataFrame, labels: DataFrame, key: str, target: str,
                  cut: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(labelled, unlabelled). ``labelled`` = candidates with a label row,
    ``label`` = ``target >= cut`` (or ``target`` itself, already 0/1);
    ``unlabelled`` = candidates without one (``left_anti``), kept apart for
    scoring. Labels are reduced to one row per key first, so a repeated
    label never doubles a training row."""
    t = F.col(target)
    lab = labels.groupBy(key).agg(F.max(t).alias("_t"))
    y = (F.col("_t") >= cut) if cut is not None else (F.col("_t") >= 1)
    labelled = candidates.join(lab, key, "inner").withColumn("label", y.cast("int")).drop("_t")
    unlabelled = candidates.join(lab, key, "left_anti")
    return labelled, unlabelled


#: Values (4 bytes each) of training rows that one partition holds at most, about.
PART_VALUES = 1 << 25


def spread(df: DataFrame, values: int) -> DataFrame:
    """``df``, which holds about ``values`` values, in so many partitions that none holds many more than
    ``PART_VALUES``: a join that broadcasts the labels keeps the documents' own splits, however large."""
    parts = -(-values // PART_VALUES)
    return df.repartition(max(parts, df.sparkSession.sparkContext.defaultParallelism)) if parts > 1 else df


def spread_texts(df: DataFrame, text: str) -> DataFrame:
    """``spread`` by the characters of ``text``; words of a text take about four bytes for each of them."""
    return spread(df, df.agg(F.sum(F.length(text))).first()[0] or 0)


# P3 ----------------------------------------------------------------------------

def split(df: DataFrame, group: str, test_share: float, salt: str = "") -> tuple[DataFrame, DataFrame]:
    """(train, test) by the SHA-256 of ``group``: rows with an equal group
    value (e.g. the same review text) fall on one side, and the split is the
    same on every run and under any partitioning (no ``randomSplit``)."""
    return tuple(split_flag(df, group, test_share, salt).filter(F.col("part") == p).drop("part")
                 for p in ("train", "test"))


def test_threshold(test_share: float) -> str:
    """Hex prefix below which a hash falls in the test part."""
    return format(min(2 ** 32 - 1, int(test_share * 2 ** 32)), "08x")


def split_flag(df: DataFrame, group: str, test_share: float, salt: str = "") -> DataFrame:
    h = F.substring(F.sha2(F.concat(F.lit(salt), F.col(group).cast("string")), 256), 1, 8)
    return df.withColumn("part", F.when(h < F.lit(test_threshold(test_share)), "test").otherwise("train"))


# P2 ----------------------------------------------------------------------------

def tokenizer(text: str, out: str = "_tok") -> RegexTokenizer:
    """Lower-case words of two or more letters or digits (any script)."""
    return RegexTokenizer(inputCol=text, outputCol=out, pattern=r"[^\p{L}\p{N}]+",
                          minTokenLength=2, toLowercase=True)


def feature_pipeline(numeric: list[str], categorical: list[str], text: str | None,
                     num_text_features: int = 1 << 18, min_doc_freq: int = 2,
                     tokens: str | None = None) -> Pipeline:
    """Numeric columns scaled; categorical columns indexed (unseen values get
    their own index) and one-hot encoded; text tokenised on non-letters,
    hashed and IDF-weighted. Output vector ``features``.

    ``tokens`` names a column tokenised already (``tokenizer``), so several
    models fitted on the same rows tokenise the text once."""
    stages, parts = [], []
    if numeric:
        stages += [VectorAssembler(inputCols=numeric, outputCol="_num_raw", handleInvalid="keep"),
                   StandardScaler(inputCol="_num_raw", outputCol="_num", withMean=False, withStd=True)]
        parts.append("_num")
    if categorical:
        idx = [f"_{c}_idx" for c in categorical]
        oh = [f"_{c}_oh" for c in categorical]
        stages += [StringIndexer(inputCols=categorical, outputCols=idx, handleInvalid="keep"),
                   OneHotEncoder(inputCols=idx, outputCols=oh, handleInvalid="keep")]
        parts += oh
    if text or tokens:
        if not tokens:
            stages.append(tokenizer(text, "_tok"))
        stages += [HashingTF(inputCol=tokens or "_tok", outputCol="_tf", numFeatures=num_text_features),
                   IDF(inputCol="_tf", outputCol="_tfidf", minDocFreq=min_doc_freq)]
        parts.append("_tfidf")
    stages.append(VectorAssembler(inputCols=parts, outputCol="features"))
    return Pipeline(stages=stages)


# P4 ----------------------------------------------------------------------------

class _RateParams(Params):
    rate = Param(Params._dummy(), "rate", "share of positive labels", TypeConverters.toFloat)


class MajorityBaseline(Estimator, _RateParams, DefaultParamsReadable, DefaultParamsWritable):
    """Predicts the majority class with probability = training base rate."""

    @keyword_only
    def __init__(self):
        super().__init__()

    def _fit(self, df: DataFrame) -> "MajorityModel":
        r = df.agg(F.avg(F.col("label").cast("double")).alias("r")).first()["r"]
        m = MajorityModel()
        m._set(rate=float(r or 0.0))
        return m


class MajorityModel(Model, _RateParams, DefaultParamsReadable, DefaultParamsWritable):
    def _transform(self, df: DataFrame) -> DataFrame:
        r = self.getOrDefault(self.rate)
        return (df.withColumn("probability", array_to_vector(F.array(F.lit(1.0 - r), F.lit(r))))
                  .withColumn("prediction", F.lit(1.0 if r >= 0.5 else 0.0)))


def _classifier(kind: str, params: dict, weighted: bool):
    w = {"weightCol": "weight"} if weighted else {}
    if kind == "baseline":
        return MajorityBaseline()
    if kind == "logreg":
        # Sparse TF-IDF columns are not standardised: scaling rare terms up
        # made the model slower and worse on held-out rows.
        return LogisticRegression(**{"maxIter": 50, "regParam": 0.01, "standardization": False,
                                     **w, **params})
    if kind == "rf":
        return RandomForestClassifier(**{"numTrees": 50, "maxDepth": 8, "seed": 11, **w, **params})
    if kind == "gbt":
        return GBTClassifier(**{"maxIter": 20, "maxDepth": 4, "seed": 11, **w, **params})
    raise ValueError(f"unknown model kind {kind!r}")


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Add ``weight`` = n / (2 n_class), from the class counts of ``df``
    (one small aggregate, two numbers)."""
    counts = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    n = sum(counts.values())
    w1 = n / (2.0 * counts.get(1, 1))
    w0 = n / (2.0 * counts.get(0, 1))
    return df.withColumn("weight", F.when(F.col(label) == 1, F.lit(w1)).otherwise(F.lit(w0)))


def train(df: DataFrame, kind: str, features: Pipeline, params: dict | None = None,
          weighted: bool = False) -> PipelineModel:
    """Fit the feature stages and one classifier on the training rows.

    The feature vectors are computed once and written to the checkpoint
    folder before the classifier runs its many passes: the iterations read
    (label, features) rows, not the text again, and a lost executor resumes
    from the checkpoint. Trees keep a value for every feature of every row in memory, so the rows are
    dealt by that (``spread``).
    """
    if kind == "baseline":
        return PipelineModel(stages=[MajorityBaseline().fit(df)])
    data = class_weights(df) if weighted else df
    fitted = features.fit(data)
    cols = ["label", "features"] + (["weight"] if weighted else [])
    x = fitted.transform(data).select(*cols)
    width = x.schema["features"].metadata.get("ml_attr", {}).get("num_attrs", 1)
    x = spread(x, df.count() * width).checkpoint(eager=True)
    clf = _classifier(kind, params or {}, weighted).fit(x)
    return PipelineModel(stages=list(fitted.stages) + [clf])


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Transform and add ``score`` = probability of class 1."""
    return model.transform(df).withColumn("score", vector_to_array(F.col("probability"))[1])


def scored(model: PipelineModel, df: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns and ``score``, checkpointed: evaluation runs several
    small jobs over the scores and should not re-run the features."""
    return predict(model, df).select(*keep, "score").checkpoint(eager=True)


# P5 ----------------------------------------------------------------------------

def auc(df: DataFrame, label: str, score: str, **kw) -> float | None:
    """Exact ROC AUC by ranks (ties get their mean rank), distributed:
    one row per distinct score, then a parallel running count
    (``ranking.running_total``). Sums are exact integers."""
    per = df.groupBy(F.col(score).alias("_s")).agg(F.count(F.lit(1)).alias("_c"),
                                                   F.sum(F.col(label)).cast("bigint").alias("_p"))
    cum, _ = running_total(per, ["_s"], "_c", "_cum", **kw)
    big = "decimal(38,0)"
    r2 = (F.col("_p").cast(big) * (2 * (F.col("_cum") - F.col("_c")).cast(big) + F.col("_c").cast(big) + 1))
    row = cum.agg(F.sum(r2).alias("r2"), F.sum("_c").cast(big).alias("n"),
                  F.sum("_p").cast(big).alias("p")).first()
    if row["n"] is None:
        return None
    n, p, r2v = int(row["n"]), int(row["p"]), int(row["r2"])
    if p == 0 or p == n:
        return None
    return float(r2v - p * (p + 1)) / float(2 * p * (n - p))


def evaluate(df: DataFrame, label: str, score: str, cut: float, **kw) -> DataFrame:
    """One row per class: support, predicted, correct, precision, recall,
    F1 (= 2 correct / (support + predicted)), with accuracy, exact AUC and the
    base rate beside them. Prediction = ``score >= cut``."""
    pred = (F.col(score) >= cut).cast("int")
    y = F.col(label).cast("int")
    cm = df.agg(F.sum(F.when((y == 1) & (pred == 1), 1).otherwise(0)).cast("bigint").alias("tp"),
                F.sum(F.when((y == 0) & (pred == 1), 1).otherwise(0)).cast("bigint").alias("fp"),
                F.sum(F.when((y == 0) & (pred == 0), 1).otherwise(0)).cast("bigint").alias("tn"),
                F.sum(F.when((y == 1) & (pred == 0), 1).otherwise(0)).cast("bigint").alias("fn"),
                F.count(F.lit(1)).alias("n"))
    a = auc(df, label, score, **kw)
    rows = []
    for cls, sup, prd, cor in ((1, "tp + fn", "tp + fp", "tp"), (0, "tn + fp", "tn + fn", "tn")):
        rows.append(cm.select(
            F.lit(cls).alias("class"), F.expr(sup).cast("bigint").alias("support"),
            F.expr(prd).cast("bigint").alias("predicted"), F.expr(cor).cast("bigint").alias("correct"),
            ratio(F.expr(cor), F.expr(prd)).alias("precision"),
            ratio(F.expr(cor), F.expr(sup)).alias("recall"),
            ratio(F.expr(f"2 * {cor}"), F.expr(f"{sup} + {prd}")).alias("f1"),
            ratio(F.expr("tp + tn"), F.col("n")).alias("accuracy"),
            F.lit(a).cast("double").alias("auc"),
            ratio(F.expr("tp + fn"), F.col("n")).alias("base_rate")))
    return rows[0].unionByName(rows[1])


# P6 ----------------------------------------------------------------------------

def score_batch(model: PipelineModel, df: DataFrame, key: str, path: str | None = None,
                version: str | None = None, cut: float = 0.5) -> DataFrame:
    """Score rows in batch: key, probability of class 1, class at ``cut``,
    model version. With ``path``, written there (Parquet) in the version's own
    partition: a repeated run replaces its version and leaves the others alone
    (``read_scores`` reads all of them); the rows written are returned, not scored again."""
    version = version or _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%SZ")
    out = predict(model, df).select(key, "score", (F.col("score") >= cut).cast("int").alias("predicted"),
                                    F.lit(version).alias("model_version"))
    if path:
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("model_version").parquet(path)
        return read_scores(df.sparkSession, path, df.schema[key].dataType, key).where(F.col("model_version") == version)
    return out


def read_scores(spark: SparkSession, path: str, key_type: T.DataType, key: str) -> DataFrame:
    """Every stored version of ``score_batch``; a filter on ``model_version`` prunes the folders read."""
    schema = T.StructType([T.StructField(key, key_type), T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType()), T.StructField("model_version", T.StringType())])
    return spark.read.schema(schema).parquet(path)
