"""Exact top-k search by inner product with vector-approximation files.

1. Equal vectors become one entry with the k + 1 smallest ids that hold it; no
   other id of the vector can be in any result (ties go to the smaller id, and a
   query leaves out one id, its own).
2. The approximation file: every component's cell number, one byte, cells of equal
   width between the component's least and greatest value (``bits`` bits).
3. Scan: queries in blocks of at most ``QUERY_BYTES`` go out to the tasks that
   read the approximations. A cell bounds its component, so two matrix products
   give each entry's lower and upper bound of the score. A task keeps what its
   own k-th lower bound can't rule out.
4. Over all tasks: entries whose upper bound reaches the query's k-th lower bound
   stay, ordered by upper bound.
5. Exact vectors are read in that order, in rounds of 2k, 4k, ... entries a
   query, until the k-th exact score is above the next upper bound.

Work is split by the file's partitions and by query blocks; nothing but a query
block is sent to all tasks, and its size is fixed.

Defined cases: vectors that are null or hold a null, NaN or infinite component, and rows with a
null id, take no part; shorter vectors count as padded with zeros; a row repeated with
id and vector counts once; an id with several vectors is a candidate with each,
and as a query stands for its smallest vector; other columns are ignored; an
empty table gives an empty result. Scores must fit a long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retail_marts.llm.common import Scratch, table

QUERY_BYTES = 2 << 20
BITS = 6


def scaled(vec: Column) -> Column:
    """floor(256 * x) of every component, or null if the vector takes no part."""
    v = vec.cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(v.isNotNull() & ~bad, F.transform(v, lambda x: F.floor(x * 256).cast("long")))


def _matrix(col: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list column as int64, short ones padded with zeros."""
    flat, offs = col.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.asarray(col.offsets) - col.offsets[0].as_py()
    size = np.diff(offs)
    if (size == dims).all():
        return flat.reshape(len(col), dims)
    out = np.zeros((len(col), dims), np.int64)
    out[np.repeat(np.arange(len(col)), size), np.arange(flat.size) - np.repeat(offs[:-1], size)] = flat
    return out


class Cells:
    """Cell boundaries per component, from its least and greatest value."""

    def __init__(self, low: np.ndarray, high: np.ndarray, bits: int = BITS):
        self.low, self.high = low.astype(np.int64), high.astype(np.int64)
        self.width = np.maximum(-(-(self.high - self.low + 1) // (1 << bits)), 1)  # whole numbers a cell

    def encode(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.low) // self.width).astype(np.uint8)

    def bounds(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low = self.low + cells.astype(np.int64) * self.width
        return low.astype(float), np.minimum(low + self.width - 1, self.high).astype(float)


def score_bounds(low: np.ndarray, high: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bound of every (entry, query) score."""
    pos, neg = np.maximum(q, 0).T, np.minimum(q, 0).T
    return low @ pos + high @ neg, high @ pos + low @ neg


def _scan(cells: Cells, q_id: np.ndarray, q: np.ndarray, k: int):
    """Task that yields the entries its partition can't rule out for each query of the block."""
    slack = float(np.abs(q).sum(1).max() * max(np.abs(cells.low).max(), np.abs(cells.high).max())) * 2.0**-48 if q.size else 0.0
    slack = slack if slack > 2.0**-8 else 0.0  # sums below 2^53 are exact

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.full((k, q_id.size), -np.inf)   # the k greatest lower bounds so far
        kept: list[tuple[np.ndarray, ...]] = []
        for whole in batches:
            for at in range(0, whole.num_rows, max(1, 1_000_000 // max(q_id.size, 1))):
                b = whole.slice(at, max(1, 1_000_000 // max(q_id.size, 1)))
                code = np.stack([np.frombuffer(x, np.uint8) for x in b.column("cells").to_pylist()])
                entry = np.asarray(b.column("entry"))
                first = np.asarray(b.column("first"))
                alone = np.asarray(b.column("alone"))
                lower, upper = score_bounds(*cells.bounds(code), q)
                own = alone[:, None] & (first[:, None] == q_id[None, :])  # nothing but the query itself
                lower[own], upper[own] = -np.inf, -np.inf
                best = -np.sort(-np.concatenate([best, lower]), axis=0)[:k] if len(lower) <= 4 * k else \
                    -np.sort(-np.concatenate([best, -np.partition(-lower, k - 1, axis=0)[:k]]), axis=0)[:k]
                i, j = np.nonzero((upper >= best[-1] - slack) & ~own)
                kept.append((j, entry[i], lower[i, j] - slack, upper[i, j] + slack))
                if sum(len(x[0]) for x in kept) > 500_000:
                    kept = [_still(kept, best[-1] - slack)]
        if kept:
            j, e, lo, hi = _still(kept, best[-1] - slack)
            for at in range(0, j.size, 100_000):
                s = slice(at, at + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(q_id[j[s]]), pa.array(e[s]), pa.array(lo[s]), pa.array(hi[s])],
                                                 names=["query_id", "entry", "lower", "upper"])

    return run


def _still(kept: list[tuple[np.ndarray, ...]], floor: np.ndarray) -> tuple[np.ndarray, ...]:
    j, e, lo, hi = (np.concatenate(x) for x in zip(*kept))
    ok = hi >= floor[j]
    return j[ok], e[ok], lo[ok], hi[ok]


def top_k(vectors: DataFrame, queries: Column, k: int = 5, bits: int = BITS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for every row that meets ``queries`` (a condition on ``vec_id``) its k best others."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "vafile")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), scaled(F.col(vec_col)).alias("v")).where("vec_id IS NOT NULL AND v IS NOT NULL").distinct()
    # one entry per vector; only its k + 1 smallest ids can be in a result
    place = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    exact = (rows.withColumn("place", place).where(F.col("place") <= k + 1).groupBy("v")
             .agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
             .select(F.xxhash64(F.col("v"), F.get("ids", F.lit(0))).alias("entry"), "ids", "v"))
    exact = scratch.put(exact, "exact")
    span = (exact.select(F.posexplode("v").alias("i", "x")).groupBy("i").agg(F.min("x").alias("a"), F.max("x").alias("b"), F.count("*").alias("n"))
            .orderBy("i").collect())  # one row per component
    queried = scratch.put(rows.where(queries).groupBy("vec_id").agg(F.min("v").alias("v")).select(F.col("vec_id").alias("query_id"), "v"), "queries")
    total, many, wide = exact.count(), queried.count(), len(span)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not many or not total:
        return empty
    short = [r["n"] < total for r in span]  # a padded component is zero
    cells = Cells(np.array([min(r["a"], 0) if s else r["a"] for r, s in zip(span, short)]),
                  np.array([max(r["b"], 0) if s else r["b"] for r, s in zip(span, short)]), bits)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            code = cells.encode(_matrix(b.column("v"), wide))
            yield pa.RecordBatch.from_arrays([b.column("entry"), b.column("first"), b.column("alone"), pa.array([c.tobytes() for c in code], pa.binary())],
                                             names=["entry", "first", "alone", "cells"])

    approx = scratch.put(exact.select("entry", F.get("ids", F.lit(0)).alias("first"), (F.size("ids") == 1).alias("alone"), "v")
                         .mapInArrow(encode, "entry long, first long, alone boolean, cells binary"), "approx")
    blocks = -(-many * (wide + 1) * 8 // QUERY_BYTES)
    found = None
    for n in range(blocks):
        block = queried.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == n).orderBy("query_id").toArrow()
        if block.num_rows:
            q = _matrix(block.column("v").combine_chunks(), wide).astype(float)
            part = approx.mapInArrow(_scan(cells, block.column("query_id").to_numpy(), q, k), "query_id long, entry long, lower double, upper double")
            found = part if found is None else found.union(part)
    cand = scratch.put(found, "bounds")
    per = Window.partitionBy("query_id")
    kth = cand.withColumn("n", F.row_number().over(per.orderBy(F.desc("lower")))).where(F.col("n") == k).select("query_id", F.col("lower").alias("floor"))
    cand = scratch.put(cand.join(kth, "query_id", "left").where(F.col("floor").isNull() | (F.col("upper") >= F.col("floor")))
                       .withColumn("n", F.row_number().over(per.orderBy(F.desc("upper"), "entry"))).select("query_id", "entry", "upper", "n"), "order")
    done, lo, hi, live = None, 0, 2 * k, queried.select("query_id")
    while True:
        now = cand.where((F.col("n") > lo) & (F.col("n") <= hi)).join(live, "query_id", "left_semi")
        dot = F.aggregate(F.zip_with("v", "qv", lambda a, b: F.coalesce(a, F.lit(0)) * F.coalesce(b, F.lit(0))), F.lit(0).cast("long"), lambda s, x: s + x)
        read = scratch.put(now.join(exact, "entry").join(queried.withColumnRenamed("v", "qv"), "query_id")
                           .select("query_id", dot.alias("score"), F.explode("ids").alias("vec_id")).where("vec_id <> query_id"), "read")
        done = read if done is None else done.union(read)
        best = done.withColumn("n", F.row_number().over(per.orderBy(F.desc("score"), "vec_id"))).where(F.col("n") <= k)
        best = scratch.put(best, "best")
        last = best.groupBy("query_id").agg(F.count("*").alias("c"), F.min("score").alias("kth"))
        done = best.drop("n")
        live = scratch.put(cand.where(F.col("n") == hi + 1).join(live, "query_id", "left_semi").join(last, "query_id", "left")
                           .where((F.coalesce(F.col("c"), F.lit(0)) < k) | (F.col("upper") >= F.col("kth"))).select("query_id"), "live")
        if live.isEmpty():
            break
        lo, hi = hi, hi + 2 * (hi - lo)
    return best.select("query_id", F.col("n").cast("int").alias("rank"), "vec_id", "score")


def op1_va_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every vec_id divisible by 50, its 5 best other vectors."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


OP1_SQL = """
WITH v AS (SELECT DISTINCT vec_id, [floor(256 * x::DOUBLE)::BIGINT for x in embedding] AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len([x for x in embedding if x IS NULL OR NOT isfinite(x::DOUBLE)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""
