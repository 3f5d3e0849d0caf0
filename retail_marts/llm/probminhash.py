"""Near-duplicate classes by ProbMinHash signatures, banding and exact verification.

A document is its weighted set of five-word shingles (words: lower-cased runs
between white space; weight: how often the shingle occurs, as a share of the
document). Two documents are linked when their *probability Jaccard* similarity
is at least 0.8; for shingles that occur once each it equals the plain Jaccard
similarity. Classes are the connected components of the links.

1. Exact copies become one node: rows of equal text, named by their smallest id.
2. ProbMinHash: each shingle sends out a Poisson process of arrivals whose rate
   is its weight, each arrival to a random register; a register keeps the
   shingle that arrived first. A process ends as soon as its next arrival is
   later than every register of the document (early termination).
3. Banding: 30 bands of 5 of the 150 registers; a pair at 0.8 shares no band
   with a chance of 7e-6.
4. A bucket isn't expanded into pairs: its members are compared with its centre,
   the one that meets most others over all buckets: first every member with its
   best centre, then with a centre of each other class that its buckets lead to, which joins
   a group of any size with about one pair a member. Pairs are verified on whole texts.
5. Where a bucket then still holds several classes, an exact filter looks for
   links between them: documents meet only in their rarest shingles, up to the
   weight that a pair at the threshold must reach (`_rare_pairs`). A group that shares a
   long template but no more than that pairs nobody; no link is lost.
6. Components by alternating large-star and small-star steps on tables.

Nodes are texts, numbered by a 64-bit hash of their MD5 (two different texts share a number with a
chance of 2^-64). Defined cases: null or wordless texts are alone in their class; a text of one to
four words is one shingle; rows with a null id link others but have no class
themselves (null class); rows that share an id are judged by their own texts; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retail_marts.llm import text as T
from retail_marts.llm.common import Scratch, table

BANDS, ROWS = 30, 5
REGISTERS = BANDS * ROWS
MARKS = 16  # 64-bit maps of the shingles that a document holds, for a bound on what a pair can share
PRIOR = 16  # rarer shingles that a listed one carries, so that a pair is made once and not at every shared shingle
_G = np.uint64(0x9E3779B97F4A7C15)


def weighted_shingles(words: T.Words, n: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each document: (hash, document, share of the document's shingles)."""
    h, d = T.shingles(words.hash, words.starts, n)
    if not h.size:
        return h, d, np.zeros(0)
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    new = np.ones(h.size, bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, h.size))
    h, d = h[at], d[at]
    return h, d, count / np.bincount(d, weights=count)[d]


def signatures(h: np.ndarray, d: np.ndarray, w: np.ndarray, docs: int, m: int = REGISTERS) -> np.ndarray:
    """ProbMinHash registers, one row of ``m`` shingle hashes per document. A document's row
    depends on its own shingles alone, whatever else is in the call."""
    first = np.full(docs * m, np.inf)
    sig = np.zeros(docs * m, np.uint64)
    base, reg0, t = h, d * m, np.zeros(h.size)
    done = 0
    while base.size:
        block = int(min(64, max(1, 30_000 // base.size)))  # arrivals drawn at a time; the result is the same
        z = T.mix(base[:, None] + _G * np.arange(done + 1, done + block + 1, dtype=np.uint64)[None, :])
        gap = -np.log(((z >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53) / w[:, None]
        gap[:, 0] += t
        when = np.cumsum(gap, axis=1)
        reg = reg0[:, None] + (((z & np.uint64(2047)) * np.uint64(m)) >> np.uint64(11)).astype(np.int64)
        early = when < first[reg]
        k, s = reg[early], when[early]
        who = np.broadcast_to(base[:, None], reg.shape)[early]
        np.minimum.at(first, k, s)
        won = first[k] == s
        sig[k[won]] = who[won]
        last = first.reshape(docs, m).max(axis=1)
        go = when[:, -1] < last[reg0 // m]
        base, reg0, w, t = base[go], reg0[go], w[go], when[go, -1]
        done += block
    return sig.reshape(docs, m)


def probability_jaccard(h1, w1, h2, w2) -> float:
    """Exact probability Jaccard similarity of two weighted sets (hashes sorted, weights positive)."""
    if not len(h1) or not len(h2):
        return 0.0
    both, i, j = np.intersect1d(h1, h2, assume_unique=True, return_indices=True)
    if not both.size:
        return 0.0
    x, y = w1[i], w2[j]
    # sum over d' of max(x'/x, y'/y): the x part for d' with a ratio x'/y' at least d's, else the y part
    only1, only2 = w1.sum() - x.sum(), w2.sum() - y.sum()
    ratio = x / y
    order = np.argsort(ratio, kind="stable")
    xs, ys = x[order], y[order]
    above = only1 + np.cumsum(xs[::-1])[::-1]
    below = only2 + np.concatenate([[0.0], np.cumsum(ys)[:-1]])
    return float(np.sum(1.0 / (above / xs + below / ys)))


_SIGNED = "node long, bands array<long>"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    done: set[int] = set()  # a text that the task has signed already isn't signed again
    for whole in batches:
        fresh = [n not in done and not done.add(n) for n in whole.column("node").to_pylist()]
        for b in T.chunks(whole.filter(pa.array(fresh, pa.bool_()))):
            words = T.Words(b.column("text"))
            h, d, w = weighted_shingles(words)
            sig = signatures(h, d, w, b.num_rows)
            has = np.zeros(b.num_rows, bool)
            has[d] = True
            keys = np.zeros((b.num_rows, BANDS), np.uint64)
            for r in range(ROWS):
                keys = T.mix(keys * _G + sig[:, r::ROWS][:, :BANDS] + np.uint64(r + 1))
            keys = T.mix(keys + np.arange(1, BANDS + 1, dtype=np.uint64) * _G).view(np.int64)
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(np.where(has, BANDS, 0))]).astype(np.int32)),
                pa.array(keys[has].ravel(), pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column("node"), lists], names=["node", "bands"])


def _similarity(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for b in T.chunks(whole, "text_a"):
            both = []
            for name in ("text_a", "text_b"):
                h, d, w = weighted_shingles(T.Words(b.column(name)))
                cut = np.searchsorted(d, np.arange(b.num_rows + 1))
                both.append([(h[i:j], w[i:j]) for i, j in zip(cut[:-1], cut[1:])])
            sim = [probability_jaccard(*x, *y) for x, y in zip(*both)]
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(sim, pa.float64())],
                                             names=["a", "b", "sim"])


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, label): label is the smallest node of the node's connected component.
    Only nodes that have an edge are listed."""
    now = scratch.put(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                      .where("u <> v").distinct(), "edges")
    state = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u"))
                                            .otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        step = scratch.put(small.where("u <> v").distinct(), "edges")
        scratch.drop(now)
        now = step
        found = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if found == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
        state = found


def near_duplicates(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """One row per input row: doc_id, class_id (smallest id of its class), copies (rows of the same
    text), key (MD5 of the text), group (a number of the class that no other class has, also where
    different texts share an id; null for texts without words)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "neardup")
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("key", F.md5(F.col("text").cast("binary")))
    node = F.xxhash64("key")
    # copies of one text: one node
    rows = scratch.put(src.select("doc_id", "key", F.coalesce(F.col("text").rlike("[^\\x20\\x09-\\x0D]"), F.lit(False)).alias("worded")), "rows")
    texts = scratch.put(rows.where("worded").groupBy("key").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))
                        .select("key", node.alias("node"), "first", "copies"), "texts")
    signed = src.where("text IS NOT NULL").select(node.alias("node"), "text").mapInArrow(_sign, _SIGNED)
    posted = scratch.put(signed.select("node", F.explode("bands").alias("band")), "posted")  # copies in other tasks post again
    # a bucket's centre is the member that meets most others; every other member is compared with it
    sizes = (posted.groupBy("band").agg(F.count("*").alias("n"), F.min("node").alias("x"), F.max("node").alias("y"))
             .where("x <> y").select("band", "n"))
    member = scratch.put(posted.join(sizes, "band").distinct(), "members")
    scratch.drop(posted)
    # the texts that any pair can need, once for every round of verification
    some = member.select("node").distinct()
    whole = scratch.put(src.select(node.alias("node"), "text").join(some, "node", "left_semi").dropDuplicates(["node"]), "whole")
    met = member.groupBy("node").agg(F.sum("n").alias("met"))
    named = scratch.put(member.join(met, "node").select("band", "n", "node", F.struct("met", "node").alias("rank")), "ranked")
    centre = scratch.put(named.groupBy("band").agg(F.max("rank").alias("top")), "centres")
    top = F.struct(F.col("top.met").alias("met"), F.col("top.node").alias("node"))
    star = scratch.put(named.join(centre, "band").where("node <> top.node").select("node", top.alias("top")).distinct(), "star")
    scratch.drop(member)
    # first its best centre for every member, then one centre of each class that its buckets lead to besides its own
    first = star.groupBy("node").agg(F.max("top").alias("top")).select(F.col("node").alias("a"), F.col("top.node").alias("b"))
    links = scratch.put(_linked(whole, F.col("node"), first, threshold, scratch), "links")
    labels = scratch.put(components(links, scratch), "labels")
    to = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    apart = (star.select("node", F.col("top.node").alias("b")).join(labels, "node", "left").join(to, "b", "left")
             .withColumn("la", F.coalesce("label", "node")).withColumn("lb", F.coalesce("lb", "b")).where("la <> lb")
             .groupBy("node", "lb").agg(F.max("b").alias("b")).select(F.col("node").alias("a"), "b"))
    apart = scratch.put(apart.join(first, ["a", "b"], "left_anti"), "apart")
    links = scratch.put(links.union(_linked(_of(whole, apart), F.col("node"), apart, threshold, scratch)), "links")
    labels = scratch.put(components(links, scratch), "labels")
    scratch.drop(star)
    # members of buckets that still hold several classes: compared by what they share beyond the frequent shingles
    both = named.select("band", "node").join(labels, "node", "left").select("band", "node", F.coalesce("label", "node").alias("label"))
    open_ = scratch.put(both.groupBy("band").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("band"), "several")
    left = scratch.put(both.join(open_, "band").select("node", "label").distinct(), "open")
    scratch.drop(named, centre, open_)
    rare = scratch.put(_rare_pairs(whole, left, threshold, scratch), "rare")
    more = scratch.put(_linked(_of(whole, rare), F.col("node"), rare, threshold, scratch), "more")
    if not more.isEmpty():
        old, labels = labels, scratch.put(components(links.union(more), scratch), "labels")
        scratch.drop(old)
    known = texts.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    known = scratch.put(known, "known")
    least = known.groupBy("label").agg(F.min("first").alias("class_id"))
    classes = scratch.put(known.join(least, "label").select("key", "class_id", "copies", F.col("label").alias("group")), "classes")
    scratch.close(rows, classes)
    out = rows.withColumn("k", F.when(F.col("worded"), F.col("key"))).join(classes.withColumnRenamed("key", "k"), "k", "left")
    # texts without words, and rows without an id, stand alone
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id"))
    return out.select("doc_id", own.alias("class_id"), F.coalesce("copies", F.lit(1)).alias("copies"), "key", "group")


def _rare_pairs(whole: DataFrame, open_: DataFrame, threshold: float, scratch: Scratch) -> DataFrame:
    """Every pair (a, b) of nodes of different labels that can reach ``threshold``, found by its rarest shared shingle.

    Let X and Y be the shares of two documents' shingle weight that lies in shingles of both. Their
    probability Jaccard similarity is at most 1 / (1/X + 1/Y - 1), so at t both shares are at least t and the
    larger at least 2t / (1 + t). Taken in the order of rising frequency, what comes before the rarest shared
    shingle is not shared: at most 1 - t of either, (1 - t) / (1 + t) of one. So only a document's rarest
    shingles are listed, up to these weights, and a pair meets in one that is in a short list. What a large
    group shares comes last in every list and pairs nobody.

    Near copies in a large group meet in many a rare shingle without being linked. Each document carries a map of
    ``64 * MARKS`` bits, a shingle setting one of them. A bit that one has and the other lacks is a shingle that isn't
    shared, of the document's least weight at least, which lowers X or Y; the pair must still be able to reach t.
    """
    own = whole.join(open_.select("node"), "node", "left_semi")
    bag = scratch.put(own.mapInArrow(_bag, "node long, shingle long, w double"), "bag")
    common = bag.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1")
    shared = scratch.put(bag.join(common, "shingle"), "common")
    scratch.drop(bag)
    falling = Window.partitionBy("node").orderBy(F.desc("df"), F.desc("shingle"))
    rest = falling.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # weight before a shingle in rising frequency: all that isn't in it or after it
    before = (shared.withColumn("before", 1.0 - F.sum("w").over(rest))
              .withColumn("prior", F.collect_list("shingle").over(falling.rowsBetween(1, PRIOR))))
    listed = before.where(F.col("before") <= 1 - threshold + 1e-9).select("shingle", "node", "before", "prior", (F.col("before") <= (1 - threshold) / (1 + threshold) + 1e-9).alias("short"))
    listed = scratch.put(listed.join(open_, "node"), "listed")
    scratch.drop(shared)
    able = listed.groupBy("shingle").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.max("short").alias("s")).where("x <> y AND s").select("shingle")
    met = scratch.put(listed.join(able, "shingle"), "met")
    names = [f"m{i}" for i in range(MARKS)]
    marks = scratch.put(own.join(met.select("node").distinct(), "node", "left_semi").mapInArrow(_marks, "node long, least double, " + ", ".join(f"{m} long" for m in names)), "marks")
    met = met.join(marks, "node")
    side = lambda x: [F.col("least").alias(f"w{x}"), *[F.col(m).alias(f"{m}{x}") for m in names]]
    a = met.where("short").select("shingle", F.col("node").alias("a"), F.col("label").alias("la"), (1 / (1 - F.col("before"))).alias("xa"), F.col("prior").alias("pa"), *side("a"))
    b = met.select("shingle", F.col("node").alias("b"), F.col("label").alias("lb"), (1 / (1 - F.col("before"))).alias("xb"), F.col("prior").alias("pb"), F.col("short").alias("sb"), *side("b"))
    # were this the rarest shared one, X and Y were at most what is left: the pair must still reach the threshold
    able = F.col("xa") + F.col("xb") <= 1 + 1 / threshold + 1e-8
    # a pair that shares one of the rarer shingles just before has met there, where both conditions are weaker
    first = ~F.arrays_overlap("pa", "pb")
    once = (F.col("a") < F.col("b")) | ~F.col("sb")
    alone = lambda x, y: sum((F.bit_count(F.col(f"{m}{x}").bitwiseAND(F.bitwise_not(F.col(f"{m}{y}")))) for m in names), F.lit(0))
    left_a, left_b = (F.greatest(1 - F.col(f"w{x}") * alone(x, y), F.lit(0.0)) for x, y in ("ab", "ba"))
    alike = left_a + left_b <= (1 + 1 / threshold + 1e-8) * left_a * left_b
    return a.join(b, "shingle").where((F.col("la") != F.col("lb")) & able & (F.col("a") != F.col("b")) & once & first & alike).select("a", "b")


def _bag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for b in T.chunks(whole):
            h, d, w = weighted_shingles(T.Words(b.column("text")))
            yield pa.RecordBatch.from_arrays([b.column("node").take(pa.array(d)), pa.array(h.view(np.int64)), pa.array(w)], names=["node", "shingle", "w"])


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document: the least weight of a shingle, and the map of its shingles."""
    for whole in batches:
        for b in T.chunks(whole):
            h, d, w = weighted_shingles(T.Words(b.column("text")))
            bits = np.zeros((b.num_rows, 64 * MARKS), bool)
            bits[d, (T.mix(h) % np.uint64(64 * MARKS)).astype(np.int64)] = True
            least = np.ones(b.num_rows)
            np.minimum.at(least, d, w)
            maps = np.packbits(bits, axis=1, bitorder="little").view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(least), *[pa.array(np.ascontiguousarray(maps[:, i])) for i in range(MARKS)]],
                                             names=["node", "least", *[f"m{i}" for i in range(MARKS)]])


def _of(whole: DataFrame, pairs: DataFrame) -> DataFrame:
    """The texts of the documents in ``pairs``."""
    ids = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    return whole.join(ids, "node", "left_semi")


def _linked(whole: DataFrame, node: Column, pairs: DataFrame, threshold: float, scratch: Scratch) -> DataFrame:
    """Pairs (u, v) whose exact similarity, from the whole texts, reaches the threshold."""
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    found = (pairs.join(whole.select(node.alias("a"), F.col("text").alias("text_a")), "a")
             .join(whole.select(node.alias("b"), F.col("text").alias("text_b")), "b")
             .mapInArrow(_similarity, "a long, b long, sim double").where(F.col("sim") >= threshold - 1e-12)
             .select(F.col("a").alias("u"), F.col("b").alias("v")))
    return scratch.put(found, "found")


def op5_probminhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its near-duplicate class: doc_id, class_id, copies."""
    return near_duplicates(table(spark, sf_dir, "documents")).drop("key", "group")
