"""Mixing sources to target weights by Poisson replication.

Every source gets a repetition rate: its target share of the output's characters
over its share of the input's. A document is repeated n times, n drawn by
inverting the distribution function of a Poisson variable of that mean at
u = hash(seed, row) / 2^52, so the draw is the same in every run and partitioning,
and independent between rows: a row is its id, its text and its number among rows
equal in both (numbered over all tasks, in the order of the other columns). Rates above 16 are drawn as a sum of
equal draws of at most 16 each, which is Poisson too. The copies are then put in
one global random order, whatever the number of partitions: dealt out by range
and sorted by a hash of (seed, row, copy).

Without given weights, targets follow the sources' characters to the power
``alpha`` (0.5: between natural and equal shares).

Defined cases: a null source is a source of its own; a null id counts as an empty
one and a null text as an empty one, yet every row draws for itself; sources that the given weights
don't name get no copies; sources without any character get rate 1; an empty table gives an
empty result; other columns stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_marts.llm.common import Scratch, free_name, table
from retail_marts.operators.ranking import global_row_number

STEP, TERMS = 16, 100   # largest mean of one draw; P(n > 100) is below 1e-40 there


def unit(seed: str, row: Column, j: Column) -> Column:
    """Uniform in [0, 1): 52 bits of SHA-256 of seed, row and draw number."""
    s = F.concat_ws(":", F.lit(seed), row, j.cast("string"))
    return F.conv(F.substring(F.sha2(s, 256), 1, 13), 16, 10).cast("long") / F.lit(float(2**52))


def rates(docs: DataFrame, weights: dict[str | None, float] | None = None, alpha: float = 0.5, budget: float = 1.0) -> DataFrame:
    """source, rate: expected copies of each document of the source; the output has about
    ``budget`` times the input's characters."""
    size = (docs.groupBy(F.col("source").cast("string").alias("source"))
            .agg(F.sum(F.length(F.coalesce(F.col("text"), F.lit("")))).cast("double").alias("chars")))
    if weights is None:
        size = size.withColumn("w", F.when(F.col("chars") > 0, F.pow("chars", F.lit(alpha))).otherwise(0.0))
    else:
        w = F.lit(0.0)
        for s, x in weights.items():
            w = F.when(F.col("source").eqNullSafe(F.lit(s).cast("string")), F.lit(float(x))).otherwise(w)
        size = size.withColumn("w", w)
    total = size.agg(F.sum("chars").alias("all_chars"), F.sum(F.when(F.col("chars") > 0, F.col("w"))).alias("all_w"))
    return (size.crossJoin(F.broadcast(total))  # one row beside a row per source
            .select("source", F.when(F.col("chars") == 0, 1.0).when(F.col("w") == 0, 0.0).otherwise(
                F.lit(budget) * F.col("w") / F.col("all_w") * F.col("all_chars") / F.col("chars")).alias("rate")))


def with_cdf(rate: DataFrame) -> DataFrame:
    """draws, cdf: how many draws make up the rate, and the distribution function of one."""
    one = F.col("rate") / F.greatest(F.col("draws"), F.lit(1))
    start = F.struct(F.exp(-one).alias("p"), F.array(F.exp(-one)).alias("c"))
    cdf = F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, lambda s, k: F.struct(
        (s["p"] * one / k).alias("p"), F.concat(s["c"], F.array(F.element_at(s["c"], -1) + s["p"] * one / k)).alias("c")),
        lambda s: s["c"])
    return rate.withColumn("draws", F.ceil(F.col("rate") / STEP).cast("int")).withColumn("cdf", cdf)


def numbered(docs: DataFrame, name: str, scratch: Scratch) -> DataFrame:
    """``docs`` and ``name``, a string that tells every row apart: id, MD5 of the text and the number
    among rows equal in both. Only such rows are numbered, by one ranking over all tasks."""
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")))
    keyed = docs.withColumn(name, key)
    again = scratch.put(keyed.groupBy(name).agg(F.count("*").alias("rows")).where("rows > 1").select(name), "repeated")
    if again.isEmpty():
        return keyed.withColumn(name, F.concat(name, F.lit(":0")))
    n = free_name(keyed, "rank")
    ranked, _ = global_row_number(keyed.join(again, name, "left_semi"), [name, *[c for c in docs.columns if c not in ("doc_id", "text")]], n)
    ranked = scratch.put(ranked, "ranked")
    first = ranked.groupBy(F.col(name).alias(name + "_")).agg(F.min(n).alias(n + "_"))
    same = (ranked.join(first, F.col(name) == F.col(name + "_"))
            .withColumn(name, F.concat_ws(":", name, (F.col(n) - F.col(n + "_")).cast("string"))).select(*docs.columns, name))
    return keyed.join(again, name, "left_anti").withColumn(name, F.concat(name, F.lit(":0"))).select(*docs.columns, name).unionByName(same)


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, alpha: float = 0.5, budget: float = 1.0,
        seed: str = "mix-1") -> DataFrame:
    """The columns of ``docs`` and ``copy`` (0, 1, ...), in a random order over the whole output."""
    scratch = Scratch(docs.sparkSession, "mix")
    copy = free_name(docs, "copy")
    names = {x: free_name(docs, x) for x in ("mix_source", "mix_rate", "draws", "cdf", "times", "place", "mix_row")}
    # a row per source, as a table: its size is known, so Spark sends it out only if it is small
    rate = scratch.put(with_cdf(rates(docs, weights, alpha, budget)), "rates").select(
        F.col("source").alias(names["mix_source"]), F.col("rate").alias(names["mix_rate"]),
        F.col("draws").alias(names["draws"]), F.col("cdf").alias(names["cdf"]))
    row = names["mix_row"]
    df = numbered(docs, row, scratch)
    df = df.join(rate, F.col("source").cast("string").eqNullSafe(rate[names["mix_source"]]))
    count = F.aggregate(
        F.when(F.col(names["draws"]) > 0, F.sequence(F.lit(1), F.col(names["draws"]))).otherwise(F.array().cast("array<int>")), F.lit(0),
        lambda a, j: a + F.aggregate(
            F.transform(F.array(unit(seed, F.col(row), j)), lambda u: F.size(F.filter(names["cdf"], lambda c: c <= u))),
            F.lit(0), lambda b, x: b + x))
    df = df.withColumn(names["times"], count).where(F.col(names["times"]) > 0)
    df = df.withColumn(copy, F.explode(F.sequence(F.lit(0), F.col(names["times"]) - 1)))
    place = F.xxhash64(F.lit(seed), row, copy)
    return (df.withColumn(names["place"], place).repartitionByRange(names["place"], row, copy).sortWithinPartitions(names["place"], row, copy)
            .drop(*names.values()))


def op4_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as often as its source's rate has drawn: the columns of documents, and copy."""
    return mix(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars"))


OP4_SQL = f"""
WITH size AS (SELECT source, sum(length(coalesce(text, '')))::DOUBLE AS chars FROM documents GROUP BY source),
total AS (SELECT sum(chars) AS all_chars, sum(CASE WHEN chars > 0 THEN pow(chars, 0.5) END) AS all_w FROM size),
rate AS (SELECT source, CASE WHEN chars = 0 THEN 1.0 ELSE 1.0 * pow(chars, 0.5) / all_w * all_chars / chars END AS rate FROM size, total),
draw AS (SELECT source, rate, ceil(rate / {STEP})::INT AS draws, rate / greatest(ceil(rate / {STEP}), 1) AS m FROM rate),
pmf AS (SELECT source, k, CASE WHEN k = 0 THEN exp(-m) ELSE exp(-m + k * ln(m) - lgamma(k + 1)) END AS p
        FROM draw, range(0, {TERMS + 1}) t(k)),
cdf AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM pmf),
d AS (SELECT *, coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, '')) || ':' ||
               (row_number() OVER (PARTITION BY doc_id, coalesce(text, '') ORDER BY lang, source, n_chars) - 1) AS row FROM documents),
u AS (SELECT d.row, d.source, j,
        ('0x' || substr(sha256('mix-1:' || d.row || ':' || j), 1, 13))::BIGINT / pow(2.0, 52) AS u
      FROM d JOIN draw r ON d.source IS NOT DISTINCT FROM r.source, range(1, r.draws + 1) t(j)),
times AS (SELECT u.row, count(*) FILTER (WHERE c.c <= u.u) AS n FROM u JOIN cdf c ON u.source IS NOT DISTINCT FROM c.source GROUP BY u.row)
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, k::INT AS copy
FROM d JOIN times t USING (row), range(0, t.n) r(k)
"""
