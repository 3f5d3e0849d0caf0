"""Corpus pipeline: quality, near-duplicates, benchmark leaks, personal data, mixing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and reread as the next one's
docs. All but the last return the columns of ``docs``.

Defined cases: rows with a null id and texts without words pass the near-duplicate stage as they are; rows
that share an id are judged by their texts, of rows with equal id and text one stays; null and wordless texts don't
pass the quality stage; every stage gives an empty table for an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_marts.llm import bm25_decontam, feistel_pii, poisson_mix, probminhash, pu_quality
from retail_marts.llm.common import Scratch, free_name, table

#: No stage but the mixing can be written in SQL; tests run the stages on odd and empty tables, a brute-force comparison is open.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts (score of 0.5 or more)."""
    model = pu_quality.train(docs, table(spark, sf_dir, "labels"), pu_quality.learn_rows(F.col("doc_id")))
    s = free_name(docs, "quality_score")
    return pu_quality.score(docs, model, s).where(F.col(s) >= 0.5).drop(s)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, that of the smallest id (then key of the text)."""
    best = (probminhash.near_duplicates(docs).where("doc_id IS NOT NULL AND group IS NOT NULL").groupBy("group")
            .agg(F.min(F.struct("doc_id", "key")).alias("b")))
    i, k, own = free_name(docs, "kept_id"), free_name(docs, "kept_key"), free_name(docs, "own_key")
    kept = best.select(F.col("b.doc_id").alias(i), F.col("b.key").alias(k))
    keyed = docs.withColumn(own, F.md5(F.col("text").cast("string").cast("binary")))
    one = keyed.join(kept, (F.col("doc_id") == F.col(i)) & F.col(own).eqNullSafe(F.col(k)), "left_semi")
    alone = ~F.coalesce(F.col("text").rlike("[^\\x20\\x09-\\x0D]"), F.lit(False))  # no words: in no class
    return one.dropDuplicates(["doc_id", own]).select(docs.columns).unionByName(docs.where(F.col("doc_id").isNull() | alone))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return bm25_decontam.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by pseudonyms; n_chars follows the text's new length."""
    old = free_name(docs, "old_length")
    df = feistel_pii.pseudonymise(docs.withColumn(old, F.length("text")), feistel_pii.session_key(spark))
    if "n_chars" in docs.columns:
        df = df.withColumn("n_chars", (F.col("n_chars") + F.coalesce(F.length("text") - F.col(old), F.lit(0))).cast(docs.schema["n_chars"].dataType))
    return df.drop(old)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to their source's target weight, in random order; one more column, copy."""
    return poisson_mix.mix(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("personal_data", personal_data),
    ("mixing", mixing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is a table in the shared folder."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        done = scratch.put(stage(spark, docs, sf_dir), name)
        scratch.drop(docs)
        docs = done
    return docs
