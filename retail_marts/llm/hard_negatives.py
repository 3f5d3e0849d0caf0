"""Hard negatives by anchor-clustered shared lists (maximum inner product, exact).

For an anchor, its positives are the best other rows of its label by inner
product; for each positive, its negatives are the best rows of other labels whose
score lies in a window set by the positive's score.

1. Rows of equal label and vector become one entry with its smallest ids; only
   these can be in a result. Anchors of one entry share one search (a *member*).
2. Members are grouped by direction (spherical k-means, fitted on a bounded
   sample; any centres give exact results). A group keeps its widest angle t.
3. One list a group: every entry has the angular upper bound
   ``|v| cos(max(0, angle(v, centre) - t))``, which times a member's length bounds
   each member's score. A list is sorted by it once, over all tasks, and cut into
   blocks of fixed size.
4. All members of a group walk its list, in rounds of growing depth, blocks of
   members against blocks of entries; between rounds a member's best rows give
   its floor, and it stops when the next bound is below it. A first walk finds
   positives, a second one negatives for each positive's score.
5. Anchors take their entry's result and leave themselves out.

A block of members and one of entries are all that meets in a task, whatever the
size of a group, a label or a copied vector. Each walk is certain when it ends: at
its floor or with the list.

Defined cases: rows with a null id or label, or a vector that is null or holds a
null, NaN or infinite component, take no part; shorter vectors count as padded
with zeros; rows repeated with id, label and vector count once; an id with several
vectors takes part with each, and its anchors leave all rows of that id out, so they may
have fewer positives; other columns are ignored; an empty table gives an empty
result. Scores must be below 2^50.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retail_marts.llm.common import Scratch, table
from retail_marts.llm.va_file import scaled
from retail_marts.llm.whitening import rows_of
from retail_marts.operators.ranking import global_row_number

CLUSTERS = 8
SAMPLE = 4096     # members the centres are fitted on
BLOCK = 4096      # entries of a list block
MEMBERS = 1024    # members that meet a block at a time


def centres(x: np.ndarray, k: int, steps: int = 10) -> np.ndarray:
    """Unit centres of the rows' directions."""
    x = x[np.linalg.norm(x, axis=1) > 0]
    if not len(x):
        return np.zeros((1, x.shape[1]))
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    c = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)]
    for _ in range(steps):
        near = (x @ c.T).argmax(axis=1)
        total = np.stack([x[near == i].sum(axis=0) for i in range(len(c))])
        size = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(size > 0, total / np.where(size > 0, size, 1), c)
    return c


def _angles(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths, and angles to every centre (0 for a vector of zeros)."""
    size = np.linalg.norm(x, axis=1)
    cos = np.divide(x @ c.T, size[:, None], out=np.ones((len(x), len(c))), where=size[:, None] > 0)
    return size, np.arccos(np.clip(cos, -1.0, 1.0))


def _matrix(col: pd.Series, dims: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(col), kind).reshape(len(col), dims).astype(np.float64)


def _best(score: np.ndarray, ok: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's k best columns that are ``ok``, earlier columns first among equals."""
    n = score.shape[1]
    key = np.where(ok, score * n + (n - 1 - np.arange(n)), -2**62)
    if n > k:
        at = np.argpartition(-key, k - 1, axis=1)[:, :k]
    else:
        at = np.broadcast_to(np.arange(n), key.shape)
    rows = np.repeat(np.arange(len(at)), at.shape[1])
    cols = at.ravel()
    found = ok[rows, cols]
    return rows[found], cols[found]


def _meet(dims: int, kind: str, k: int, windows: bool):
    """Best entries of one list block for one block of members."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"first": [], "h": [], "w": [], "e_first": [], "e_h": [], "score": []}, dtype="int64")
        if not len(left) or not len(right):
            return empty
        left = left[left["size"] * right["bound"].max() >= left["floor"]]  # certain already before this block
        if not len(left):
            return empty
        right = right.sort_values(["first", "h"])
        score = np.rint(_matrix(left["v"], dims, kind) @ _matrix(right["v"], dims, kind).T).astype(np.int64)
        ids = {c: left[c].to_numpy() for c in ("first", "h")}
        e = {c: right[c].to_numpy() for c in ("first", "h")}
        if windows:
            other = left["label"].to_numpy()[:, None] != right["label"].to_numpy()[None, :]
            size = np.array([len(w) for w in left["ps"]])
            found = []
            for j in range(size.max(initial=0)):
                m = np.flatnonzero(size > j)
                w = np.array([left["ps"].iat[i][j] for i in m], np.int64)
                s = score[m]
                r, c = _best(s, other[m] & (2 * s >= w[:, None]) & (100 * s <= 95 * w[:, None]), k)
                found.append((m[r], c, w[r]))
        else:
            r, c = _best(score, np.ones(score.shape, bool), k)
            found = [(r, c, np.zeros(r.size, np.int64))]
        r, c, w = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
        return pd.DataFrame({"first": ids["first"][r], "h": ids["h"][r], "w": w, "e_first": e["first"][c], "e_h": e["h"][c], "score": score[r, c]})
    return run


_FOUND = "first long, h long, w long, e_first long, e_h long, score long"


def _walk(lists: DataFrame, entries: DataFrame, members: DataFrame, total: int, need: int, windows: bool, dims: int, kind: str, scratch: Scratch) -> DataFrame:
    """(first, h, w, e_first, e_h, score): for every member (and window w) its ``need`` best rows' entries."""
    rows = entries.select(F.col("first").alias("e_first"), F.col("h").alias("e_h"), F.size("ids").alias("rows"))
    cell = F.lit(0) if windows else F.col("label")
    live, best, lo, hi = members.withColumn("floor", F.lit(float("-inf"))), None, 0, BLOCK
    while True:
        live = scratch.put(live, "live")
        # blocks of members, by the number of live ones in each cell
        cells = live.groupBy("cluster", cell.alias("cell")).agg(F.ceil(F.count("*") / MEMBERS).alias("parts"))
        cells = scratch.put(cells, "cells")
        part = live.withColumn("cell", cell).join(cells, ["cluster", "cell"]).withColumn("part", F.pmod(F.xxhash64("first", "h"), F.col("parts")))
        segment = (lists.where((F.col("place") >= lo) & (F.col("place") < hi)).join(entries.select("first", "h", "label", "v"), ["first", "h"])
                   .withColumn("cell", cell).join(cells, ["cluster", "cell"]).withColumn("block", F.floor(F.col("place") / BLOCK)))
        blocks = scratch.put(segment.select("cluster", "cell", "block").distinct(), "blocks")
        keys = ["cluster", "cell", "block", "part"]
        left = part.join(blocks, ["cluster", "cell"]).select(*keys, "first", "h", "label", "size", "floor", "v", *(["ps"] if windows else []))
        right = segment.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(*keys, "first", "h", "label", "bound", "v")
        found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_meet(dims, kind, need, windows), _FOUND)
        both = found if best is None else found.unionByName(best)
        n = F.row_number().over(Window.partitionBy("first", "h", "w").orderBy(F.desc("score"), "e_first", "e_h"))
        now = scratch.put(both.withColumn("n", n).where(F.col("n") <= need).drop("n"), "best")
        scratch.drop(cells, blocks, *([best] if best is not None else []))
        best = now
        if hi >= total:
            scratch.drop(live)
            return best
        # the score of the last row that is needed, where there are that many
        upto = F.sum("rows").over(Window.partitionBy("first", "h", "w").orderBy(F.desc("score"), "e_first", "e_h"))
        kth = best.join(rows, ["e_first", "e_h"]).withColumn("upto", upto).where(F.col("upto") >= need).groupBy("first", "h", "w").agg(F.max("score").alias("kth"))
        bound = lists.where(F.col("place") == hi).select("cluster", "bound")  # one row a cluster
        if windows:
            # a window is open while a better or a lacking row may follow: above its floor and its lower end
            each = live.select("first", "h", F.explode("ps").alias("w")).join(kth, ["first", "h", "w"], "left")
            floor = each.groupBy("first", "h").agg(F.min(F.greatest(F.col("w") / 2, F.coalesce(F.col("kth").cast("double"), F.lit(float("-inf"))))).alias("floor"))
        else:
            floor = kth.select("first", "h", F.col("kth").cast("double").alias("floor"))
        still = (live.drop("floor").join(floor, ["first", "h"], "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
                 .join(bound, "cluster").where(F.col("size") * F.col("bound") >= F.col("floor")).drop("bound"))
        old, live = live, scratch.put(still.select(*live.columns), "still")
        scratch.drop(old)
        if live.isEmpty():
            scratch.drop(live)
            return best
        lo, hi = hi, 4 * hi


def mine(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 3, clusters: int = CLUSTERS,
         id_col: str = "vec_id", label_col: str = "label", vec_col: str = "embedding") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score; ``anchors`` is a condition on vec_id.
    A negative's score is at least half and at most 95 % of the positive's."""
    spark = rows.sparkSession
    scratch = Scratch(spark, "negatives")
    empty = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    keep = max(positives + 1, negatives)
    src = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), scaled(F.col(vec_col)).alias("x"))
    src = src.where("vec_id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL").distinct()
    # one entry per label and vector, with the smallest ids
    n = F.row_number().over(Window.partitionBy("label", "x").orderBy("vec_id"))
    grouped = src.withColumn("n", n).where(F.col("n") <= keep).groupBy("label", "x").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    raw = scratch.put(grouped.select(F.get("ids", F.lit(0)).alias("first"), F.xxhash64("label", "x").alias("h"), "label", "ids", "x"), "raw")
    shape = raw.agg(F.max(F.size("x")).alias("dims"), F.max(F.array_max(F.transform("x", F.abs))).alias("top"), F.count("*").alias("n")).first()
    total, dims = shape["n"], shape["dims"] or 0
    if not total or not dims:
        scratch.close()
        return empty
    kind = next(k for k in ("int8", "int16", "int32", "int64") if (shape["top"] or 0) <= np.iinfo(k).max)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = rows_of(b.column("x"), dims).astype(kind)
            yield pa.RecordBatch.from_arrays([b.column(c) for c in ("first", "h", "label", "ids")] + [pa.array([r.tobytes() for r in x], pa.binary())],
                                             names=["first", "h", "label", "ids", "v"])

    entries = scratch.put(raw.mapInArrow(pack, "first long, h long, label long, ids array<long>, v binary"), "entries")
    # an anchor belongs to the entry of its label and vector
    asked = scratch.put(src.where(anchors).join(raw.select("label", "x", "first", "h"), ["label", "x"]).select("vec_id", "first", "h"), "asked")
    scratch.drop(raw)
    wanted = scratch.put(entries.join(asked.select("first", "h").distinct(), ["first", "h"], "left_semi"), "wanted")
    sample = wanted.orderBy(F.xxhash64("first", "h"), "first", "h").limit(SAMPLE).select("v").toArrow()
    if not sample.num_rows:
        scratch.close()
        return empty
    c = centres(np.frombuffer(b"".join(sample.column("v").to_pylist()), kind).reshape(-1, dims).astype(float), clusters)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, angle = _angles(_matrix(b.column("v").to_pandas(), dims, kind), c)
            near = angle.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([b.column("first"), b.column("h"), b.column("label"), b.column("v"), pa.array(near.astype(np.int32)), pa.array(size),
                                              pa.array(angle[np.arange(len(near)), near])], names=["first", "h", "label", "v", "cluster", "size", "angle"])

    members = scratch.put(wanted.mapInArrow(place, "first long, h long, label long, v binary, cluster int, size double, angle double"), "members")
    widest = {r["cluster"]: r["t"] for r in members.groupBy("cluster").agg(F.max("angle").alias("t")).collect()}  # a row a cluster

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, angle = _angles(_matrix(b.column("v").to_pandas(), dims, kind), c)
            for k, t in widest.items():
                up = size * np.cos(np.maximum(angle[:, k] - t - 1e-7, 0.0)) + size * 1e-9  # above what rounding may hide
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(up), k, np.int32)), pa.array(-up), b.column("first"), b.column("h")],
                                                 names=["cluster", "below", "first", "h"])

    listed = entries.select("v", "first", "h").mapInArrow(bounds, "cluster int, below double, first long, h long")
    ranked, _ = global_row_number(listed, ["cluster", "below", "first", "h"], "place")
    order = {k: i for i, k in enumerate(sorted(widest))}  # every list holds each entry once
    before = F.create_map(*[F.lit(x) for k, i in order.items() for x in (k, i * total)])
    lists = scratch.put(ranked.select("cluster", (F.col("place") - 1 - F.element_at(before, F.col("cluster"))).alias("place"), (-F.col("below")).alias("bound"), "first", "h"), "lists")

    walkers = members.drop("angle")
    near = _walk(lists, entries, walkers, total, positives + 1, False, dims, kind, scratch)
    who = Window.partitionBy("first", "h").orderBy(F.desc("score"), "pid")
    known = entries.select(F.col("first").alias("e_first"), F.col("h").alias("e_h"), "ids")
    # the best rows of an entry's own label, one more than the positives: an anchor may be among them
    pos = scratch.put(near.join(known, ["e_first", "e_h"]).select("first", "h", "score", F.explode("ids").alias("pid"))
                      .withColumn("n", F.row_number().over(who)).where(F.col("n") <= positives + 1).drop("n"), "pos")
    scratch.drop(near)
    ask = pos.where("score >= 0").groupBy("first", "h").agg(F.collect_set("score").alias("ps"))
    far = _walk(lists, entries, walkers.join(ask, ["first", "h"]), total, negatives, True, dims, kind, scratch)
    per = Window.partitionBy("first", "h", "w").orderBy(F.desc("score"), "nid")
    neg = (far.join(known, ["e_first", "e_h"]).select("first", "h", "w", "score", F.explode("ids").alias("nid"))
           .withColumn("n", F.row_number().over(per)).where(F.col("n") <= negatives + 1)
           .groupBy("first", "h", "w").agg(F.array_sort(F.collect_list(F.struct("n", "nid", "score"))).alias("negs")))
    packed = (pos.join(neg, (pos["first"] == neg["first"]) & (pos["h"] == neg["h"]) & (pos["score"] == neg["w"]), "left")
              .groupBy(pos["first"], pos["h"]).agg(F.array_sort(F.collect_list(F.struct((-pos["score"]).alias("s"), pos["pid"].alias("pid"), neg["negs"]))).alias("all")))
    packed = scratch.put(packed, "packed")
    scratch.close(packed, asked)
    taken = F.slice(F.filter("all", lambda p: p["pid"] != F.col("vec_id")), 1, positives)
    out = asked.join(packed, ["first", "h"]).select(F.col("vec_id").alias("anchor_id"), F.explode(taken).alias("p"))
    # a row of the anchor's own id under another label is left out as well
    mined = F.slice(F.filter("p.negs", lambda x: x["nid"] != F.col("anchor_id")), 1, negatives)
    out = out.select("anchor_id", F.col("p.pid").alias("positive_id"), (-F.col("p.s")).alias("positive_score"), F.posexplode(mined).alias("i", "x"))
    return out.select("anchor_id", "positive_id", (F.col("i") + 1).cast("int").alias("rank"), F.col("x.nid").alias("negative_id"),
                      "positive_score", F.col("x.score").alias("negative_score"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every vec_id divisible by 50 and each of its 5 positives, its 3 hardest negatives; labels
    of ids divisible by 7 are moved on by one."""
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


OP13_SQL = """
WITH v AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE)::BIGINT for x in embedding] AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len([x for x in embedding if x IS NULL OR NOT isfinite(x::DOUBLE)]) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_inner_product(a.v::DOUBLE[], b.v::DOUBLE[])::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id)::INT AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""
