"""Toxicity: a convolutional text classifier over hashed word embeddings, in numpy.

A word is looked up by three hashes (whole word, first 6 and first 9 bytes,
2^22 buckets) and its vector is the sum of the three embeddings; buckets seen in
fewer than three training documents have none. Filters of widths 1, 2 and 3 run
over the whole text, k-max pooling keeps each filter's four greatest
activations of different 16-word stripes, and a logistic layer gives the score.
Embeddings, filters and output are trained by gradient steps (Adagrad) on every
labelled row that may be learned from. The rows are dealt into shards of about ``shard``
by a hash of the id; one shard makes the first parameters, and then in each round every
shard takes its steps from the common ones, in Spark tasks, and the changes are averaged (a bucket's over the shards that saw it). They
are summed as multiples of 2^-24, exactly, so the result doesn't depend on the order of tasks. A shard's words are
looked up once, before the first round, and kept as numbers; buckets' parameters and changes travel as half-precision floats in blocks.

Thresholds are calibrated by language on the fifth of the labelled rows that training
leaves out, all of it, from counts by label of logits rounded to a thousandth.
The language is guessed from the text's words (naive Bayes learned on the
same rows): the lang column, like id, source and labels, is never an input of
a score. The score is shifted so that 0.5 is the language's threshold.

Defined cases: null or wordless texts score 0; without rows of both classes
every other score is 0.25; repeated labels of one id count as toxic if any is; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_marts.llm import text as T
from retail_marts.llm.common import Scratch, fold, short_shuffles, table

BITS, DIM, PER_WIDTH, WIDTHS, KMAX, STRIPE = 22, 16, 8, (1, 2, 3), 4, 16
FILTERS = PER_WIDTH * len(WIDTHS)
UNIT, STEP, ENDS = 2.0 ** 24, 1000, 40  # changes of dense parameters are summed in 1 / UNIT (halves are multiples of it), logits counted in 1 / STEP up to ENDS
BLOCK = 1 << 10  # buckets whose changes travel together


def buckets(words: T.Words) -> np.ndarray:
    """Three bucket numbers per word."""
    shift = np.uint64(64 - BITS)
    return np.stack([(h >> shift).astype(np.int32) for h in (
        words.hash, T.mix(words.prefix(6) + np.uint64(6)), T.mix(words.prefix(9) + np.uint64(9)))], 1)


def layout(rows: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents padded to whole stripes (two empty places at least): (rows, place is a word, stripe starts)."""
    n = np.diff(starts)
    stripes = -(-(n + 2) // STRIPE)
    at = np.concatenate([[0], np.cumsum(stripes)])
    out = np.zeros((int(at[-1]) * STRIPE, rows.shape[1]), rows.dtype)
    place = np.arange(len(rows)) + np.repeat(at[:-1] * STRIPE - starts[:-1], n)
    out[place] = rows
    real = np.zeros(len(out), bool)
    real[place] = True
    return out, real, at


def _sums_by(key: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, rising, and the sum of each one's rows of ``values``, added in their order."""
    if not key.size:
        return key, values
    both = np.sort(key.astype(np.int64) << 32 | np.arange(key.size))
    key = both >> 32
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return key[first], np.add.reduceat(values[both & 0xFFFFFFFF], first, axis=0)


class Cnn:
    """emb: one row per known bucket, row 0 empty. filt: per width a (width * DIM, PER_WIDTH) matrix."""

    def __init__(self, rows: int, seed: int = 5):
        r = np.random.default_rng(seed)
        self.emb = r.normal(0, 0.15, (rows + 1, DIM)).astype(np.float32)
        self.emb[0] = 0
        self.filt = [r.normal(0, 0.25, (w, DIM, PER_WIDTH)).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros(FILTERS, np.float32)
        self.out = r.normal(0, 0.1, (KMAX, FILTERS)).astype(np.float32)
        self.base = np.zeros(1, np.float32)
        self.acc = [np.full_like(p, 1e-3) for p in (self.emb, *self.filt, self.bias, self.out, self.base)]

    def dense(self) -> list[np.ndarray]:
        """The parameters beside the embeddings, and their sums of squared gradients."""
        return [*self.filt, self.bias, self.out, self.base, *self.acc[1:]]

    def activations(self, ids: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = self.emb.take(ids[:, 0], 0)
        for j in range(1, ids.shape[1]):
            x += self.emb.take(ids[:, j], 0)
        # every filter's part of the same offset side by side, all in one product
        z = x @ np.concatenate([f[o] for o in range(max(WIDTHS)) for f in self.filt if o < len(f)], 1)
        y, at = z[:, :FILTERS], FILTERS
        for o in range(1, max(WIDTHS)):
            first = sum(len(f) <= o for f in self.filt) * PER_WIDTH  # widths rise, so the last ones reach this far
            y[:-o, first:] += z[o:, at:at + FILTERS - first]
            at += FILTERS - first
        y = y + self.bias
        y[~real] = -1.0
        return x, y

    @staticmethod
    def pool(y: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """k greatest stripe maxima of each document and filter, and the stripes they came from (-1: none)."""
        top = y.reshape(-1, STRIPE, FILTERS).max(1)
        docs = at.size - 1
        best, stripe = np.zeros((docs, KMAX, FILTERS), np.float32), np.full((docs, KMAX, FILTERS), -1)
        size = np.diff(at)
        for n in np.unique(size):  # documents of one size at once
            own = np.flatnonzero(size == n)
            t = top[(at[own][:, None] + np.arange(n)).ravel()].reshape(own.size, n, FILTERS)
            k = min(KMAX, int(n))
            o = np.argsort(-t, 1, kind="stable")[:, :k] if n < 64 else np.argpartition(-t, KMAX - 1, 1)[:, :KMAX]
            v = np.take_along_axis(t, o, 1)
            if n >= 64:
                again = np.argsort(-v, 1, kind="stable")
                o, v = np.take_along_axis(o, again, 1), np.take_along_axis(v, again, 1)
            best[own, :k] = v
            stripe[own, :k] = o + at[own][:, None, None]
        return np.maximum(best, 0), stripe

    def logits(self, ids: np.ndarray, real: np.ndarray, at: np.ndarray) -> np.ndarray:
        best, _ = self.pool(self.activations(ids, real)[1], at)
        return np.tensordot(best, self.out, 2) + self.base[0]

    def train(self, ids: np.ndarray, starts: np.ndarray, y: np.ndarray, epochs: int, rate: float = 0.06, batch: int = 32, seed: int = 6) -> None:
        r, acc = np.random.default_rng(seed), self.acc
        padded, words, stripes = layout(ids, starts)
        padded, words = padded.reshape(-1, STRIPE, ids.shape[1]), words.reshape(-1, STRIPE)

        def ada(p, g, a, l2=0.0):
            g = g + l2 * p
            a += g * g
            p -= rate * g / np.sqrt(a)

        for _ in range(epochs):
            order = r.permutation(len(y))
            for lo in range(0, len(y), batch):
                docs = order[lo:lo + batch]
                at = np.concatenate([[0], np.cumsum(np.diff(stripes)[docs])])
                part = np.arange(at[-1]) + np.repeat(stripes[docs] - at[:-1], np.diff(at))
                got, real = padded[part].reshape(-1, ids.shape[1]), words[part].ravel()
                x, act = self.activations(got, real)
                best, stripe = self.pool(act, at)
                z = np.tensordot(best, self.out, 2) + self.base[0]
                dz = ((1 / (1 + np.exp(-z))) - y[docs]).astype(np.float32) / len(docs)
                g_out = np.tensordot(dz, best, 1)
                g_best = dz[:, None, None] * self.out[None] * (best > 0)
                d, k, f = np.nonzero(g_best)
                g, s = g_best[d, k, f], stripe[d, k, f]
                p = s * STRIPE + act.reshape(-1, STRIPE, FILTERS)[s, :, f].argmax(1)
                g_bias = np.bincount(f, weights=g, minlength=FILTERS).astype(np.float32)
                g_filt = [np.zeros_like(w) for w in self.filt]
                at_word, g_word = [np.zeros(0, np.int64)], [np.zeros((0, DIM), np.float32)]
                for i, w in enumerate(WIDTHS):
                    own_f = np.flatnonzero(f // PER_WIDTH == i)
                    by = np.zeros((own_f.size, PER_WIDTH), np.float32)
                    by[np.arange(own_f.size), f[own_f] % PER_WIDTH] = g[own_f]
                    for o in range(w):  # a word is followed by two empty places at least
                        q = p[own_f] + o
                        g_filt[i][o] = x[q].T @ by
                        at_word.append(q)
                        g_word.append(by @ self.filt[i][o].T)
                q, grad = _sums_by(np.concatenate(at_word), np.concatenate(g_word))
                u, g_emb = _sums_by(got[q].ravel(), np.repeat(grad, got.shape[1], axis=0))
                g_emb[u == 0] = 0
                acc[0][u] += g_emb * g_emb
                self.emb[u] -= rate * g_emb / np.sqrt(acc[0][u])
                for j, (w, gw) in enumerate(zip(self.filt, g_filt)):
                    ada(w, gw, acc[1 + j], 1e-5)
                ada(self.bias, g_bias, acc[-3])
                ada(self.out, g_out.astype(np.float32), acc[-2], 1e-5)
                ada(self.base, np.array([dz.sum()], np.float32), acc[-1])


class Model:
    """A trained network with its bucket list, language tables and thresholds."""

    def __init__(self, known: np.ndarray, net: Cnn, lang: np.ndarray, shift: np.ndarray):
        self.known, self.net, self.lang, self.shift = known, net, lang, shift
        self._rows = None

    def rows(self, b: np.ndarray) -> np.ndarray:
        if self._rows is None:
            self._rows = np.zeros(1 << BITS, np.int32)
            self._rows[self.known] = np.arange(1, self.known.size + 1)
        return self._rows[b]

    def __getstate__(self):
        return {**self.__dict__, "_rows": None}

    def language(self, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Number of the likeliest language of each document by its known words."""
        total = np.concatenate([np.zeros((1, self.lang.shape[1])), np.cumsum(self.lang[ids[:, 0]].astype(np.float64), 0)])
        return (total[starts[1:]] - total[starts[:-1]]).argmax(1)

    def score(self, col: pa.Array) -> np.ndarray:
        words = T.Words(col, T.ALNUM)
        out = np.zeros(len(col))
        if not words.hash.size:
            return out
        ids = self.rows(buckets(words))
        z = self.net.logits(*layout(ids, words.starts)) - self.shift[self.language(ids, words.starts)]
        return np.where(np.diff(words.starts) > 0, 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -40, 40))), 0.0)


def _threshold(z: np.ndarray, toxic: np.ndarray, other: np.ndarray) -> float:
    """Cut with the least errors, the middle of the best gap: ``z`` ascending, with its rows of either class."""
    missed = np.concatenate([[0], np.cumsum(toxic)])                   # positives below the cut
    false = np.concatenate([[0], np.cumsum(other[::-1])])[::-1]        # negatives above it
    k = np.flatnonzero((e := missed + false) == e.min())
    k = int(k[len(k) // 2])
    return float((z[max(k - 1, 0)] + z[min(k, len(z) - 1)]) / 2)


def _seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per bucket and language: documents that hold it, and its words (by the first hash)."""
    for whole in batches:
        for b in T.chunks(whole, limit=4 * T.CHUNK_BYTES):
            words = T.Words(b.column("text"), T.ALNUM)
            ids, langs = buckets(words), np.array(b.column("lang").to_pylist(), object)
            doc = np.repeat(np.arange(len(langs)), np.diff(words.starts))
            for lang in set(langs):
                own = np.array([x == lang for x in langs], bool)[doc]
                pairs = np.sort((ids[own].astype(np.int64) << 32 | doc[own][:, None]).ravel())
                bucket = pairs[np.append(pairs[1:] != pairs[:-1], True)[:pairs.size]] >> 32
                first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[:bucket.size])
                docs, bucket = np.diff(np.append(first, bucket.size)), bucket[first]
                n = np.bincount(np.searchsorted(bucket, ids[own, 0]), minlength=bucket.size)
                yield pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.repeat(pa.scalar(lang, pa.string()), bucket.size), pa.array(docs, pa.int64()), pa.array(n, pa.int64())],
                                                 names=["bucket", "lang", "docs", "words"])


def _vocabulary(fit: DataFrame, scratch: Scratch, least: int, langs: list[str]) -> Model:
    """The buckets in ``least`` documents or more and the language tables, counted over all rows; an untrained network."""
    n = fit.select("text", "lang").mapInArrow(_seen, "bucket int, lang string, docs long, words long").groupBy("bucket", "lang").agg(
        F.sum("docs").alias("docs"), F.sum("words").alias("words"))
    n = scratch.put(n, "buckets")
    total = {r["lang"]: r["w"] for r in n.groupBy("lang").agg(F.sum("words").alias("w")).collect()}
    often = n.groupBy("bucket").agg(F.sum("docs").alias("d")).where(F.col("d") >= least).select("bucket")
    got = n.join(often, "bucket").select("bucket", "lang", "words").toArrow()  # the model's own size
    bucket, lang = got["bucket"].to_numpy(), got["lang"].combine_chunks().dictionary_encode()
    known = np.unique(bucket)
    count = np.full((known.size + 1, len(langs)), 0.1)
    place = {x: k for k, x in enumerate(langs)}
    k = np.append([place.get(x, -1) for x in lang.dictionary.to_pylist()], -1)[lang.indices.fill_null(-1).to_numpy(zero_copy_only=False)].astype(int)
    row = np.searchsorted(known, bucket) + 1
    np.add.at(count, (row[k >= 0], k[k >= 0]), got["words"].to_numpy()[k >= 0])
    every = np.array([total.get(x, 0) for x in langs]) + 0.1 * len(count)
    model = Model(known.astype(np.int64), Cnn(known.size), np.log(count / every).astype(np.float32), np.zeros(len(langs)))
    model.lang[0] = 0
    scratch.drop(n)
    del got, lang
    pa.default_memory_pool().release_unused()
    return model


def _shards(fit: DataFrame, model: Model, scratch: Scratch) -> DataFrame:
    """One row per shard: the number of each word among the shard's distinct ones, these words' buckets (as the model
    numbers them), and the words and label of each document."""
    shared = fit.sparkSession.sparkContext.broadcast(model.known)

    def pack(group: pa.Table) -> pa.Table:
        model = Model(shared.value, None, None, None)
        group = group.sort_by([("place", "ascending"), ("doc_id", "ascending")])
        hashes, ids, sizes = [], [], []
        for whole in group.to_batches():
            for b in T.chunks(whole):
                words = T.Words(b.column("text"), T.ALNUM)
                u, first, number = np.unique(words.hash, return_index=True, return_inverse=True)
                hashes.append((u, number))
                ids.append(model.rows(buckets(words)[first]))
                sizes.append(np.diff(words.starts))
        u, first, number = np.unique(np.concatenate([u for u, _ in hashes]), return_index=True, return_inverse=True)
        cut = np.cumsum([len(u) for u, _ in hashes])[:-1]
        words = np.concatenate([n[w] for n, (_, w) in zip(np.split(number, cut), hashes)])
        cells = [words.astype(np.int32), np.concatenate(ids)[first], np.concatenate(sizes).astype(np.int32), group["toxic"].to_numpy().astype(np.int8)]
        return pa.table([group["shard"].slice(0, 1), *[pa.array([x.tobytes()], pa.binary()) for x in cells]], names=["shard", "words", "buckets", "sizes", "toxic"])

    out = scratch.put(fit.groupBy("shard").applyInArrow(pack, "shard long, words binary, buckets binary, sizes binary, toxic binary"), "shards")
    shared.destroy()
    return out


def _mean(group: pa.Table) -> pa.Table:
    """Averages of one block's changes; those of the dense parameters are block -1."""
    block = group["block"][0].as_py()
    if block < 0:
        whole = sum(np.frombuffer(c.as_buffer(), np.int64) for c in group["change"])
        return pa.table([pa.array([block], pa.int32()), pa.array([b""], pa.binary()), pa.array([(whole / UNIT / len(group)).tobytes()], pa.binary())], names=["block", "rows", "change"])
    total, n = np.zeros((BLOCK, 2 * DIM)), np.zeros(BLOCK)
    for r, c in zip(group["rows"], group["change"]):
        own = np.frombuffer(r.as_buffer(), np.uint16)
        total[own] += np.frombuffer(c.as_buffer(), np.float16).reshape(-1, 2 * DIM)
        n[own] += 1
    own = np.flatnonzero(n)
    mean = (total[own] / n[own, None]).astype(np.float32)
    return pa.table([pa.array([block], pa.int32()), pa.array([own.astype(np.uint16).tobytes()], pa.binary()), pa.array([mean.tobytes()], pa.binary())], names=["block", "rows", "change"])


def _round(shards: DataFrame, model: Model, epochs: int, seed: int) -> None:
    """Every shard trains from ``model``; the averaged changes are applied to it."""
    net = model.net
    shared = shards.sparkSession.sparkContext.broadcast(([net.emb.astype(np.float16), net.acc[0].astype(np.float16)], net.filt, net.bias, net.out, net.base, net.acc[1:]))

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (emb, acc), *dense, rest = shared.value
        for b in batches:
            for k in range(b.num_rows):
                words, ids, sizes, toxic = (np.frombuffer(b.column(c)[k].as_buffer(), t) for c, t in
                                            (("words", np.int32), ("buckets", np.int32), ("sizes", np.int32), ("toxic", np.int8)))
                number = np.zeros(len(emb), np.int32)  # only the shard's own buckets are copied
                number[0] = 1
                number[ids] = 1
                used = np.flatnonzero(number)
                number[used] = np.arange(used.size)
                own, first = Cnn.__new__(Cnn), [x[used].astype(np.float32) for x in (emb, acc)]
                own.emb, (own.filt, own.bias, own.out, own.base) = first[0].copy(), [[w.copy() for w in x] if isinstance(x, list) else x.copy() for x in dense]
                own.acc = [first[1].copy(), *[p.copy() for p in rest]]
                old = [*[p.copy() for p in own.dense()]]
                own.train(number[ids].reshape(-1, 3).take(words, 0), np.concatenate([[0], np.cumsum(sizes)]), toxic.astype(float), epochs, seed=seed)
                whole = np.concatenate([(n - o).ravel() for n, o in zip(own.dense(), old)]).astype(np.float64)
                yield _record(-1, b"", np.rint(whole * UNIT).astype(np.int64))
                hit = np.flatnonzero((own.acc[0] != first[1]).any(1))
                change = np.concatenate([own.emb[hit] - first[0][hit], own.acc[0][hit] - first[1][hit]], 1).astype(np.float16)
                row = used[hit]
                at = np.append(np.flatnonzero(np.diff(row // BLOCK, prepend=-1)), row.size)
                for i, j in zip(at[:-1], at[1:]):
                    yield _record(int(row[i] // BLOCK), (row[i:j] % BLOCK).astype(np.uint16).tobytes(), change[i:j])

    moved = (shards.mapInArrow(steps, "block int, rows binary, change binary").groupBy("block")
             .applyInArrow(lambda group: _mean(group), "block int, rows binary, change binary").toArrow())  # the model's own size
    shared.destroy()  # the next round has its own
    for block, rows, change in zip(*(moved[c] for c in ("block", "rows", "change"))):
        if block.as_py() < 0:
            flat, at = np.frombuffer(change.as_buffer(), np.float64), 0
            for p in net.dense():
                p += flat[at:at + p.size].reshape(p.shape)
                at += p.size
        else:
            row, mean = block.as_py() * BLOCK + np.frombuffer(rows.as_buffer(), np.uint16).astype(np.int64), np.frombuffer(change.as_buffer(), np.float32).reshape(-1, 2 * DIM)
            net.emb[row] += mean[:, :DIM]
            net.acc[0][row] += mean[:, DIM:]
    del moved
    pa.default_memory_pool().release_unused()


def _record(block: int, rows: bytes, change: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([rows], pa.binary()), pa.array([change.tobytes()], pa.binary())], names=["block", "rows", "change"])


def _calibrate(rows: DataFrame, model: Model) -> None:
    """Thresholds by language from all of ``rows``."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for whole in batches:
            for b in T.chunks(whole):
                words = T.Words(b.column("text"), T.ALNUM)
                ids = model.rows(buckets(words))
                z = np.clip(model.net.logits(*layout(ids, words.starts)), -ENDS, ENDS)
                yield pa.RecordBatch.from_arrays([pa.array(model.language(ids, words.starts), pa.int32()), pa.array(np.rint(z * STEP).astype(np.int32)), b.column("toxic")],
                                                 names=["k", "z", "toxic"])

    got = (rows.select("text", "toxic").mapInArrow(run, "k int, z int, toxic int").groupBy("k", "z")
           .agg(F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("n")).orderBy("z", "k").toArrow())  # languages x 2 x ENDS x STEP rows at most
    shared.destroy()
    k, z, toxic = got["k"].to_numpy(), got["z"].to_numpy() / STEP, got["toxic"].to_numpy()
    other = got["n"].to_numpy() - toxic
    zs, at = np.unique(z, return_inverse=True)
    everywhere = _threshold(zs, np.bincount(at, toxic), np.bincount(at, other))
    for i in range(len(model.shift)):
        own = k == i
        few = min(toxic[own].sum(), other[own].sum()) < 10
        model.shift[i] = everywhere if few else _threshold(z[own], toxic[own], other[own])


def train(docs: DataFrame, labels: DataFrame, learn, shard: int = 4096, rounds: int = 6, epochs: int = 8) -> Model | None:
    """A model of all labelled rows in ``learn``. One shard's ``epochs`` passes give the first parameters (averaged
    from random ones, the shards undo each other's steps); where there are more shards, all then train in ``rounds`` rounds of a pass."""
    marked = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(learn)
              .where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic")))
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
            .where(learn).join(marked, "doc_id").groupBy("doc_id", "toxic").agg(F.min(F.struct("lang", "text")).alias("x")))
    scratch = Scratch(docs.sparkSession, "toxicity")
    try:
        with short_shuffles(docs.sparkSession):
            return _trained(rows, scratch, shard, rounds, epochs)
    finally:
        scratch.close()


def _trained(rows: DataFrame, scratch: Scratch, shard: int, rounds: int, epochs: int) -> Model | None:
    rows = scratch.put(rows.select("doc_id", "toxic", "x.lang", "x.text", F.xxhash64("doc_id", F.lit(31)).alias("place")), "labelled")
    n = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return None
    size = sum(n.values())
    langs = sorted(r["lang"] for r in rows.where("lang IS NOT NULL").select("lang").distinct().collect()) or ["?"]
    out = F.pmod("place", F.lit(5)) == 0 if size >= 50 else F.lit(False)
    shards = -(-size // shard)
    fit = rows.where(~out).withColumn("shard", F.pmod(F.shiftright("place", 8), F.lit(shards)))
    model = _vocabulary(fit, scratch, min(3, max(1, size // 20)), langs)
    packed = _shards(fit, model, scratch)
    _round(packed.where("shard = 0"), model, epochs, 6)
    for i in range(rounds if shards > 1 else 0):
        _round(packed, model, 1, 7 + i)
    scratch.drop(packed)
    model.net.acc = None  # not needed to score
    _calibrate(rows.where(out) if size >= 50 else rows, model)
    return model


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, score of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for whole in batches:
            for b in T.chunks(whole):
                s = model.score(b.column("text")) if model else np.where(np.diff(T.Words(b.column("text"), T.ALNUM).starts) > 0, 0.25, 0.0)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s, pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, score double")


def op2_cnn_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    docs, doc_id = table(spark, sf_dir, "documents"), F.col("doc_id")
    model = train(docs, table(spark, sf_dir, "labels"), fold(doc_id, 5) != 0)
    return score(docs, model).select("doc_id", (fold(doc_id, 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
