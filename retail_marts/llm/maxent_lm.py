"""Language-model scoring: a hashed maximum-entropy model with class-factored softmax.

Tokens are words (runs of anything but white space, A-Z lower-cased) and one end
per document. Counts of all learning tokens are kept by 64-bit hash, as a table in the
shared folder that grows with the corpus.

Vocabulary: the ``CLASSES - 1`` times ``MEMBERS`` most frequent tokens form classes of
equal size by frequency; all other tokens, unknown ones too, are the last class, a tree
with ``FAN_OUT`` branches a node. A token's way through it is the leading bits of its hash,
so a token never seen has one too; the tree is as deep as its distinct tokens ask for, about
``LEAF`` a leaf, and at most ``DEPTH`` levels.

    P(token | history) = P(last class or not | history) * P(class | history) * P(token | class, history)
    in the last class:   P(branch | history) * P(branch | node, history) * ... * P(token | leaf)

All but the first and the last factor are choices among 32, each of them ``FAN_BITS`` choices between two
halves: softmaxes over sums of feature weights, so that a token costs the weights on its own way and not
those of all its neighbours. In a leaf the last factor is
(c + 0.1) / (N' + 0.1 (V' + 1)) over that leaf's counts. Features, hashed with the choice to one
weight: none, the last token, the last two, and the
second and third last alone (skips). Choices start at the token frequencies.

Training is by distributed gradient updates: in each of ``ROUNDS`` rounds the documents
of that round (all learning documents are in one) update copies of the weights, one for about
``COPY_TOKENS`` tokens and dealt by a hash of the document, so the cluster doesn't matter, by Adagrad steps; the copies' changes are averaged weight by weight, each
weighed by its size, by groups of ``FAN`` copies at a time.

Scoring goes through whole documents in numpy batches with the ``FREQUENT`` most
frequent counts at hand (a fixed number); the counts of all rarer tokens are joined to
the documents' tokens by a shuffle, summed and joined back.

Defined cases: a null or empty text has the end token only; without any learning
document every probability is 1 (the formulas' value at N = V = 0); rows that share an id are scored each;
a null id is in fold 0, so held out; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_marts.llm import text as T
from retail_marts.llm.common import Scratch, fold, table

CLASSES, MEMBERS = 32, 32
FAN_BITS = 5
FAN_OUT, LEAF, DEPTH = 1 << FAN_BITS, 16, 4
TABLE_BITS = (20, 21)         # hashed weights for choices of classes and members, and for those of branches
BLOCK, ROOT = 1 << 16, 40     # weights that travel together; their changes' roots travel in units of 1 / ROOT
FREQUENT, NEAR_BITS = 1 << 17, 18
ROUNDS, FAN = 2, 32
STEP, BATCH, SHARE = 0.3, 4096, 2  # 2^SHARE neighbouring rows have one sum of squared gradients
COPY_TOKENS = 1 << 20         # tokens of a round that a copy of the weights is worth
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
END = np.uint64(0xE0D0FE0DC0FFEE01)
_G = np.uint64(0x9E3779B97F4A7C15)
_KEY = np.uint64(0xD6E8FEB86659FD93)
_PIECE = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)  # masks of a word's first n bytes
# the choices between halves that lead to a child, as numbered in a node, and whether the second half is taken; of two children and of 32
_LEVEL = np.arange(FAN_BITS, 0, -1)
_CHILD = np.arange(FAN_OUT)[:, None]
_WAYS = {1: (np.ones((2, 1), np.int64), np.array([[0], [1]], np.float32)),
         FAN_BITS: (_CHILD + FAN_OUT >> _LEVEL, (_CHILD >> _LEVEL - 1 & 1).astype(np.float32))}


def tokens(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, each text's end last, and where each text's tokens start (one more entry)."""
    raw, offs = T.buffers(col)
    inside = (raw != 0x20) & (raw - np.uint8(0x09) > 4)  # 0x09 to 0x0D: unsigned, so smaller bytes are large here
    edge = np.zeros(raw.size + 1, bool)
    edge[1:-1] = inside[1:] != inside[:-1]
    if raw.size:
        edge[offs] = True  # a word never runs over a text's end
    bounds = np.flatnonzero(edge)
    runs = inside[bounds[:-1]] if raw.size else np.zeros(0, bool)
    at, size = bounds[:-1][runs], np.diff(bounds)[runs]
    # bytes are hashed by eights, all words at once, then the longer ones' next eight
    low = np.zeros(raw.size + 8, np.uint8)
    low[:raw.size] = raw | (((raw - np.uint8(0x41)) < 26) << 5).astype(np.uint8)
    eight = np.lib.stride_tricks.as_strided(low[:8].view("<u8"), (raw.size + 1,), (1,))
    word = T.mix((eight[at] & _PIECE[np.minimum(size, 8)]) * _KEY + size.astype(np.uint64))
    left, back = np.flatnonzero(size > 8), 8
    while left.size:
        word[left] = T.mix((word[left] ^ eight[at[left] + back] & _PIECE[np.minimum(size[left] - back, 8)]) * _KEY + _G)
        back += 8
        left = left[size[left] > back]
    before = np.searchsorted(at, offs)
    starts = before + np.arange(before.size)
    out = np.full(int(starts[-1]), END, np.uint64)
    out[np.arange(at.size) + np.repeat(np.arange(before.size - 1), np.diff(before))] = word
    return out, starts


def contexts(h: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """Feature hash arrays, one entry per token: last, last two, second last, third last."""
    back = []
    for n in (1, 2, 3):
        p = np.full(h.size, n, np.uint64)  # before the text: a mark of its own
        p[n:] = h[:-n]
        for k in range(n):
            first = starts[:-1] + k
            p[first[first < starts[1:]]] = n
        back.append(p)
    last = T.mix(back[0] + _G)
    return [last, T.mix(last + back[1] * _G + np.uint64(2)), T.mix(back[1] * _G + np.uint64(3)), T.mix(back[2] * _G + np.uint64(4))]


class Vocabulary:
    """Token counts in total, the frequent tokens' own, and the classes."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, total: int, distinct: int):
        """``hashes`` in order of falling counts."""
        size = min((CLASSES - 1) * MEMBERS, hashes.size)
        place = np.full(hashes.size, -1, np.int32)
        place[:size] = np.arange(size)
        order = np.argsort(hashes)
        self.hashes, self.counts, self.place = hashes[order], counts[order], place[order]
        self.near = np.searchsorted(self.hashes, np.arange(1 << NEAR_BITS, dtype=np.uint64) << np.uint64(64 - NEAR_BITS))
        self.total, self.distinct, self.size = total, distinct, size
        self.rest_total, self.rest_distinct = total - int(counts[:size].sum()), distinct - size
        share = np.zeros((CLASSES, MEMBERS))
        share.reshape(-1)[:size] = counts[:size]
        self.member = share
        depth = 0
        while depth < DEPTH and LEAF * FAN_OUT ** depth < self.rest_distinct:
            depth += 1
        self.leaves(depth, np.full(1, self.rest_total), np.full(1, self.rest_distinct))

    def leaves(self, depth: int, total: np.ndarray, distinct: np.ndarray) -> None:
        """The last class's tree: counts and distinct tokens of each leaf."""
        self.depth, self.room = depth, total + 0.1 * (distinct + 1)
        self.by_class = np.append(self.member[:-1].sum(1), self.room.sum())

    def leaf(self, h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - FAN_BITS * self.depth)).astype(np.int64) if self.depth else np.zeros(h.size, np.int64)

    def path(self, h: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Node and branch of tokens of the last class, level by level; nodes are numbered from the root on."""
        leaf, first = self.leaf(h), 0
        for level in range(self.depth):
            down = leaf >> FAN_BITS * (self.depth - 1 - level)
            yield first + (down >> FAN_BITS), down % FAN_OUT
            first += FAN_OUT ** level

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(count, or -1 for a token that isn't frequent; number in the classes, or -1)."""
        if not self.hashes.size:
            return np.full(h.size, -1, np.int64), np.full(h.size, -1, np.int64)
        at, end = self.near.take((h >> np.uint64(64 - NEAR_BITS)).view(np.int64)), self.hashes.size - 1
        np.minimum(at, end, out=at)
        less = np.flatnonzero(self.hashes.take(at) < h)
        while less.size:  # hashes that begin alike, few
            at[less] += 1
            less = less[at[less] <= end]
            less = less[self.hashes.take(at[less]) < h[less]]
        np.minimum(at, end, out=at)
        hit = self.hashes.take(at) == h
        return np.where(hit, self.counts[at], -1), np.where(hit, self.place[at], -1).astype(np.int64)

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.1) / (self.total + 0.1 * (self.distinct + 1)))

    def rest(self, c: np.ndarray, leaf: np.ndarray | int = 0) -> np.ndarray:
        """log10 probability of a token of count ``c`` in its leaf."""
        return np.log10((c + 0.1) / self.room[leaf])


class Weights:
    """Weights of choices between two halves, one after the other in ``all``.

    Nodes are choices among 32: 0 is the last class or not (one choice between two), 1 the class, 2 and on a class's
    member, ``TAIL`` and on a branch of the tree. The choices of a node are numbered from 1 as in a heap. ``bias`` has
    32 weights a node, which start at the logit of the second half in the frequency model (beyond any weight where a half is
    empty); ``hashed`` are the weights of a feature and a choice, those of classes and members apart from those of branches."""

    TAIL = 2 + CLASSES

    def __init__(self, v: Vocabulary):
        levels = [v.room.reshape(FAN_OUT ** k, FAN_OUT, -1).sum(2) for k in range(v.depth)]
        rest = np.zeros((1, FAN_OUT))
        rest[0, [0, FAN_OUT // 2]] = v.by_class[:-1].sum(), v.by_class[-1]
        known = np.append(v.by_class[:-1], 0)[None]
        self._cut(np.concatenate([*[np.zeros(1 << b, np.float32) for b in TABLE_BITS], self._halves(np.concatenate([rest, known, v.member, *levels]))]))

    def _cut(self, every: np.ndarray) -> None:
        self.all, at = every, np.cumsum([0, *[1 << b for b in TABLE_BITS]])
        self.hashed = [every[i:j] for i, j in zip(at[:-1], at[1:])]
        self.bias = every[at[-1]:]

    def __getstate__(self):
        return self.all

    def __setstate__(self, every):
        self._cut(every)

    def copy(self) -> Weights:
        out = Weights.__new__(Weights)
        out._cut(self.all.copy())
        return out

    @staticmethod
    def _halves(mass: np.ndarray) -> np.ndarray:
        out = np.zeros(mass.shape, np.float32)
        for level in range(FAN_BITS):
            half = mass.reshape(len(mass), 1 << level, 2, -1).sum(3)
            with np.errstate(divide="ignore", invalid="ignore"):
                z = np.log(half[:, :, 1]) - np.log(half[:, :, 0])
            out[:, 1 << level:2 << level] = np.nan_to_num(z, nan=0.0, posinf=1e9, neginf=-1e9)
        return out.ravel()

    def tables(self) -> list[np.ndarray]:
        return [self.all]

    def choices(self, v: Vocabulary, h: np.ndarray, number: np.ndarray) -> Iterator[tuple[int, np.ndarray | slice, np.ndarray, np.ndarray, int]]:
        """Choices of a batch of tokens: (hashed table, the tokens that have them, nodes and children, a row for each of
        a token's nodes, halvings that a choice in them takes)."""
        last = (number < 0).astype(np.int64)[None]
        yield 0, slice(None), np.zeros_like(last), last, 1
        k = np.flatnonzero(number >= 0)
        if k.size:
            cls = number[k] // MEMBERS
            yield 0, k, np.stack([np.ones_like(cls), 2 + cls]), np.stack([cls, number[k] % MEMBERS]), FAN_BITS
        k = np.flatnonzero(number < 0)
        if k.size and v.depth:
            node, branch = (np.stack(x) for x in zip(*v.path(h[k])))
            yield 1, k, self.TAIL + node, branch, FAN_BITS

    @staticmethod
    def rows(table: int, features: list[np.ndarray], node: np.ndarray) -> list[np.ndarray]:
        """Where each feature's weights of each node are: that of choice n is at ``row ^ n``, all of them side by side."""
        own, shift = node.astype(np.uint64) * _KEY, np.uint64(64 - TABLE_BITS[table])
        return [((f ^ own) * _G >> shift).view(np.int64).ravel() for f in features]  # the hashes are mixed already

    def logits(self, table: int, node: np.ndarray, child: np.ndarray, levels: int, rows: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
        """Sums of the weights of the choices between halves, a node's one after the other, and where these are: the bias, then the features'."""
        way = _WAYS[levels][0].take(child.ravel(), 0).ravel()
        at = [np.repeat(node.ravel() * FAN_OUT, levels) + way, *[np.repeat(r, levels) ^ way for r in rows]]
        z = self.bias.take(at[0], mode="clip")
        for a in at[1:]:
            z += self.hashed[table].take(a, mode="clip")  # all are inside; no checks
        return z, at

    def log_probability(self, table: int, features: list[np.ndarray], node: np.ndarray, child: np.ndarray, levels: int) -> np.ndarray:
        """Of all choices of each token together."""
        z, _ = self.logits(table, node, child, levels, self.rows(table, features, node))
        z *= 1 - 2 * _WAYS[levels][1].take(child.ravel(), 0).ravel()
        np.minimum(z, 80, out=z)
        z = np.log1p(np.exp(z, out=z), out=z).reshape(len(node), -1, levels)
        return -sum(z[:, :, i].sum(0, dtype=np.float64) for i in range(levels))


class Steps:
    """A copy of the weights under training, with the squared gradients that every node's and every feature's weights have had."""

    def __init__(self, w: Weights):
        self.w = w.copy()
        self.acc = [np.zeros(x.size >> SHARE, np.float32) for x in self.w.hashed]
        self.bias_acc = np.zeros(self.w.bias.size // FAN_OUT, np.float32)

    def take(self, table: int, features: list[np.ndarray], node: np.ndarray, child: np.ndarray, levels: int) -> None:
        """One gradient step on a batch: all weights move towards the halves taken, the less, the more they have moved."""
        w, rows = self.w, self.w.rows(table, features, node)
        g, at = w.logits(table, node, child, levels, rows)
        np.clip(g, -80, 80, out=g)
        np.negative(g, out=g)
        np.exp(g, out=g)
        g += 1
        np.divide(-1, g, out=g)
        g += _WAYS[levels][1].take(child.ravel(), 0).ravel()
        by = g.reshape(-1, levels)
        square = sum(by[:, i] * by[:, i] for i in range(levels))
        for acc, weights, r, a in [(self.bias_acc, w.bias, node.ravel(), at[0]), *[(self.acc[table], w.hashed[table], r >> SHARE, a) for r, a in zip(rows, at[1:])]]:
            np.add.at(acc, r, square)
            rate = acc.take(r, mode="clip")
            rate += 1
            np.sqrt(rate, out=rate)
            np.divide(STEP, rate, out=rate)
            np.add.at(weights, a, g * np.repeat(rate, levels))


def train_partition(v: Vocabulary, w: Weights):
    """Task that updates a copy of the weights by its documents and yields the change, in blocks of weights."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = Steps(w)
        for whole in batches:
            for b in T.chunks(whole):
                h, starts = tokens(b.column("text"))
                features, number = contexts(h, starts), v.find(h)[1]
                for at in range(0, h.size, BATCH):
                    s = slice(at, at + BATCH)
                    for table, k, *choice in w.choices(v, h[s], number[s]):
                        steps.take(table, [x[s][k] for x in features], *choice)
        for at in range(0, w.all.size, BLOCK):
            change = steps.w.all[at:at + BLOCK] - w.all[at:at + BLOCK]
            change = np.rint(np.sign(change) * np.minimum(np.sqrt(np.abs(change)) * ROOT, 127)).astype(np.int8)  # most are small
            if change.any():
                yield pa.RecordBatch.from_arrays([pa.array([at // BLOCK], pa.int32()), pa.array([b""], pa.binary()), pa.array([change.tobytes()], pa.binary())],
                                                 names=["block", "seen", "change"])

    return run


def _average(pdf: pd.DataFrame) -> pd.DataFrame:
    """Changes of one block averaged weight by weight, weighed by their sizes; ``seen`` has these of an average already."""
    seen = total = None
    for s, c in zip(pdf["seen"], pdf["change"]):
        if s:
            x, n = np.frombuffer(c, np.float16).astype(np.float32), np.frombuffer(s, np.float16).astype(np.float32)
        else:
            x = np.frombuffer(c, np.int8).astype(np.float32) / ROOT
            n = x * x
            x = np.copysign(n, x)
        x *= n
        seen, total = (n, x) if seen is None else (seen + n, total + x)
    mean = (total / np.where(seen > 0, seen, 1)).astype(np.float16)
    return pd.DataFrame({"block": [pdf["block"].iloc[0]], "seen": [(seen / FAN).astype(np.float16).tobytes()], "change": [mean.tobytes()]})


def token_counts(docs: DataFrame) -> DataFrame:
    """token (hash), c: occurrences in all texts, ends included."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in T.chunks(whole, limit=4 * T.CHUNK_BYTES):
                u, n = np.unique(tokens(b.column("text"))[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(n.astype(np.int64))], names=["token", "n"])

    return docs.select("text").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("c"))


def train(docs: DataFrame, counts: DataFrame, rounds: int = ROUNDS) -> tuple[Vocabulary, Weights]:
    """Vocabulary and weights. ``docs``: the learning texts; ``counts``: their token counts."""
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    top = counts.orderBy(F.desc("c"), "token").limit(FREQUENT).toArrow()
    c, t = top.column("c").to_numpy(), top.column("token").to_numpy().astype(np.int64)
    order = np.lexsort((t, -c))
    v = Vocabulary(t[order].view(np.uint64), c[order], int(total["n"]), int(total["v"]))
    if v.depth:
        leaf = F.shiftrightunsigned("token", 64 - FAN_BITS * v.depth)
        known = t[order][:v.size].tolist()
        own = counts.where(~F.col("token").isin(known)).groupBy(leaf.alias("leaf")).agg(F.sum("c").alias("n"), F.count("*").alias("v")).toArrow()
        sums = np.zeros((2, FAN_OUT ** v.depth), np.int64)  # of a size that DEPTH bounds
        sums[:, own.column("leaf").to_numpy()] = own.column("n").to_numpy(), own.column("v").to_numpy()
        v.leaves(v.depth, *sums)
    w = Weights(v)
    src = docs.withColumn("round", F.pmod(F.xxhash64("doc_id", F.lit(41)), F.lit(rounds)))
    copies = max(-(-v.total // (rounds * COPY_TOKENS)), 1)
    deal = F.xxhash64("doc_id", "text", F.lit(43))
    # a round's shuffles are deleted with its end, they are read once
    conf = docs.sparkSession.conf
    had = conf.get(CLEANUP, "false")
    conf.set(CLEANUP, "true")
    try:
        for k in range(rounds if v.size else 0):
            # changes grow with the tokens, not with the number of partitions; the order of a copy's documents is fixed
            dealt = src.where(F.col("round") == k).select("text", deal.alias("deal")).repartition(copies, "deal").coalesce(copies).sortWithinPartitions("deal")
            change = dealt.select("text").mapInArrow(train_partition(v, w), "block int, seen binary, change binary")
            few = change
            if copies > FAN:
                few = (change.withColumn("part", F.spark_partition_id() % -(-copies // FAN)).groupBy("block", "part")
                       .applyInPandas(lambda pdf: _average(pdf), "block int, seen binary, change binary"))
            whole = few.groupBy("block").applyInPandas(lambda pdf: _average(pdf), "block int, seen binary, change binary")
            new = w.copy()
            for r in whole.collect():  # the weights themselves: a fixed size
                at = r["block"] * BLOCK
                new.all[at:at + BLOCK] += np.frombuffer(bytes(r["change"]), np.float16)
            w = new
    finally:
        conf.set(CLEANUP, had)
    return v, w


def score_tokens(v: Vocabulary, w: Weights, h: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per token: count (-1: not among the frequent), base and model log10 probability; a token that isn't
    frequent has only its class and leaf in the model's, and no base."""
    c, number = v.find(h)
    features = contexts(h, starts)
    model = np.zeros(h.size)
    for at in range(0, h.size, BATCH):
        s = slice(at, at + BATCH)
        out = np.zeros(h[s].size)
        for table, k, *choice in w.choices(v, h[s], number[s]):
            out[k] += w.log_probability(table, [x[s][k] for x in features], *choice)
        model[s] = out / np.log(10)
    own = (c >= 0) & (number < 0)
    model[own] += v.rest(c[own], v.leaf(h[own]))
    return c, np.where(c >= 0, v.base(np.maximum(c, 0)), 0.0), model


def score(docs: DataFrame, counts: DataFrame, v: Vocabulary, w: Weights) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score of every row."""
    scratch = Scratch(docs.sparkSession, "maxent")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in T.chunks(whole):
                h, starts = tokens(b.column("text"))
                c, base, model = score_tokens(v, w, h, starts)
                late = c < 0  # their counts are joined below
                model[late] -= np.log10(v.room[v.leaf(h[late])])
                rare = [np.unique(x[n < 0], return_counts=True) for x, n in
                        ((h[i:j], c[i:j]) for i, j in zip(starts[:-1], starts[1:]))]
                at = np.concatenate([[0], np.cumsum([len(u) for u, _ in rare])]).astype(np.int64)
                lists = [pa.LargeListArray.from_arrays(pa.array(at), pa.array(np.concatenate(x))).cast(pa.list_(pa.int64())) for x in
                         ([u.view(np.int64) for u, _ in rare], [n.astype(np.int64) for _, n in rare])]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array(np.diff(starts)), pa.array(np.add.reduceat((c > 0).astype(np.int64), starts[:-1])),
                     pa.array(np.add.reduceat(base, starts[:-1])), pa.array(np.add.reduceat(model, starts[:-1])), *lists],
                    names=["doc_id", "n_tokens", "n_known", "base_score", "score", "rare", "tf"])

    part = docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, n_known long, base_score double, score double, rare array<long>, tf array<long>")
    # the number of a row is fixed by writing it down
    part = scratch.put(part.withColumn("row", F.monotonically_increasing_id()), "part")
    seen = part.select("row", F.explode(F.arrays_zip("rare", "tf")).alias("x")).select("row", F.col("x.rare").alias("token"), F.col("x.tf").alias("tf"))
    few = counts.where(F.col("c") <= F.lit(int(v.counts.min()) if v.counts.size else 0))  # rarer ones only, ties of the last frequent too
    c = F.coalesce("c", F.lit(0))
    ten = lambda n, d: F.log10((c + 0.1) / F.lit(n + 0.1 * (d + 1)))
    late = (seen.join(few, "token", "left").groupBy("row")
            .agg(F.sum(F.when(c > 0, F.col("tf")).otherwise(0)).alias("more"), F.sum(F.col("tf") * ten(v.total, v.distinct)).alias("more_base"),
                 F.sum(F.col("tf") * F.log10(c + 0.1)).alias("more_score")))
    add = lambda a, b: (F.col(a) + F.coalesce(b, F.lit(0))).alias(a)
    return (part.drop("rare", "tf").join(late, "row", "left")
            .select("doc_id", "n_tokens", add("n_known", "more"), add("base_score", "more_base"), add("score", "more_score")))


def op6_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every document."""
    scratch = Scratch(spark, "lm")
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    learn = docs.where(fold(F.col("doc_id"), 10) != 0)
    counts = scratch.put(token_counts(learn), "counts")
    v, w = train(learn, counts)
    return score(docs, counts, v, w).select("doc_id", (fold(F.col("doc_id"), 10) == 0).alias("held_out"), "n_tokens", "n_known",
                                            F.lit(v.total).cast("long").alias("train_tokens"), "base_score", "score")
