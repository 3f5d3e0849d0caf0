"""Quality classifier by positive-unlabelled learning (non-negative risk).

Trusted positives are documents labelled quality 1; the unlabelled set is drawn
from all documents of the learning folds, whatever their label. Negative labels
are never used. The class prior is estimated from how a first classifier's
scores of held-back positives and unlabelled documents compare: the smallest
ratio of the two upper tails. The cut between 0 and 1 is the one of least estimated
error on rows held back from the network. A one-hidden-layer network then minimises

    prior * R_p(+)  +  max(0, R_u(-) - prior * R_p(-))

with the logistic loss; when the bracket turns negative the step goes the other
way, which keeps the network from fitting the unlabelled set as negatives.

A document's features are shares of its whole text: which character classes
follow which, capitals, digits, marks, distinct words.
Labels, language, source and id are no features.

Parameters with a bound: ``sample`` rows for each of the two training sets, in
the order of a hash of the id (rows of features, about 3 kB each, go to the
driver). Every document is scored, whole, in numpy batches on the executors.

Defined cases: a null or wordless text scores 0; without positives or
unlabelled rows every other score is 0.5; repeated labels of one id count as
quality 1 only if all agree; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as S

from retail_marts.llm import text as T
from retail_marts.llm.common import fold, table

# character classes: each ASCII mark its own, letters by case, digits, white space, other bytes
_CLASS = np.zeros(256, np.int64)
_CLASS[0x61:0x7B], _CLASS[0x41:0x5B], _CLASS[0x30:0x3A] = 1, 2, 3
_CLASS[0x20], _CLASS[0x0A], _CLASS[0x80:] = 4, 5, 6
for _n, _b in enumerate(b"""!"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"""):
    _CLASS[_b] = 7 + _n
_CLASSES = 40
PAIR_BINS = 512
DENSE = 14
FEATURES = PAIR_BINS + DENSE


def features(col: pa.Array) -> np.ndarray:
    """One float32 row per text."""
    w = T.Words(col, T.TOKEN)
    docs, size = len(col), np.diff(w.offs)
    out = np.zeros((docs, FEATURES), np.float32)
    if not w.hash.size:
        return out
    doc = np.repeat(np.arange(docs), size)
    cls = _CLASS[w.raw]
    per = np.maximum(size, 1)
    pair = (cls[:-1] * _CLASSES + cls[1:]) * 7919 % PAIR_BINS
    same = doc[:-1] == doc[1:]
    counts = np.bincount(doc[:-1][same] * PAIR_BINS + pair[same], minlength=docs * PAIR_BINS).reshape(docs, PAIR_BINS)
    out[:, :PAIR_BINS] = np.log1p(200.0 * counts / per[:, None])
    share = lambda ok: np.bincount(doc[ok], minlength=docs) / per
    n = np.maximum(np.diff(w.starts), 1)
    of_words = lambda x: np.bincount(w.doc, weights=x, minlength=docs) / n
    again = np.zeros(w.hash.size)
    again[1:] = (w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1])
    order = np.lexsort((w.hash, w.doc))
    h, d = w.hash[order], w.doc[order]
    new = np.ones(h.size, bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    at = np.flatnonzero(new)
    most = np.zeros(docs)
    np.maximum.at(most, d[at], np.diff(np.append(at, h.size)))
    distinct = np.bincount(d[at], minlength=docs)
    up = (_CLASS[w.raw[w.at]] == 2) & (_CLASS[w.raw[w.end - 1]] != 1)
    last = _CLASS[w.raw[w.end - 1]] >= 7
    twice = last & (w.len > 1) & (w.raw[np.maximum(w.end - 2, 0)] == w.raw[w.end - 1])
    dense = [np.log1p(n) / 8, share(cls == 1), share(cls == 2), share(cls == 3), share(cls == 5) * 10, share(cls >= 7),
             of_words(w.len) / 10, of_words(up), of_words(last), of_words(twice), of_words(again),
             np.log(distinct / n + 1e-3) / 4, most / n, np.log1p(distinct) / 8]
    out[:, PAIR_BINS:] = np.stack(dense, 1)
    out[np.diff(w.starts) == 0] = 0
    return out


class Net:
    """One hidden layer, logistic output; Adam steps in numpy."""

    def __init__(self, inputs: int, hidden: int = 24, seed: int = 1):
        r = np.random.default_rng(seed)
        self.p = [r.normal(0, np.sqrt(1.0 / inputs), (inputs, hidden)), np.zeros(hidden),
                  r.normal(0, np.sqrt(1.0 / hidden), hidden), np.zeros(1)]
        self.m = [np.zeros_like(x) for x in self.p]
        self.v = [np.zeros_like(x) for x in self.p]
        self.n = 0

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a = np.maximum(x @ self.p[0] + self.p[1], 0)
        return a, a @ self.p[2] + self.p[3][0]

    def step(self, x: np.ndarray, a: np.ndarray, slope: np.ndarray, rate: float = 2e-3, decay: float = 1e-4) -> None:
        back = (slope[:, None] * self.p[2][None, :]) * (a > 0)
        grads = [x.T @ back, back.sum(0), a.T @ slope, np.array([slope.sum()])]
        self.n += 1
        for i, g in enumerate(grads):
            g = g + decay * self.p[i]
            self.m[i] = 0.9 * self.m[i] + 0.1 * g
            self.v[i] = 0.999 * self.v[i] + 0.001 * g * g
            self.p[i] = self.p[i] - rate * (self.m[i] / (1 - 0.9**self.n)) / (np.sqrt(self.v[i] / (1 - 0.999**self.n)) + 1e-8)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def fit_nnpu(pos: np.ndarray, unl: np.ndarray, prior: float, epochs: int = 40, batch: int = 256, seed: int = 1) -> Net:
    """Network that minimises the non-negative unbiased risk."""
    net, r = Net(pos.shape[1], seed=seed), np.random.default_rng(seed)
    steps = max(1, max(len(pos), len(unl)) // batch)
    for _ in range(epochs):
        for _ in range(steps):
            xp, xu = pos[r.integers(0, len(pos), batch)], unl[r.integers(0, len(unl), batch)]
            x = np.concatenate([xp, xu])
            a, z = net.forward(x)
            zp, zu = z[:batch], z[batch:]
            # logistic loss: as positive log(1 + e^-z), as negative log(1 + e^z)
            negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
            up = -prior * _sigmoid(-zp) / batch       # slope of prior * R_p(+)
            dn_p, dn_u = -prior * _sigmoid(zp) / batch, _sigmoid(zu) / batch
            slope = np.concatenate([up + dn_p, dn_u]) if negative >= 0 else np.concatenate([-dn_p, -dn_u])
            net.step(x, a, slope)
    return net


def estimate_prior(pos: np.ndarray, unl: np.ndarray) -> float:
    """Share of positives among the unlabelled: smallest ratio of the scores' upper
    tails, on rows that the scoring network has not seen (two halves, each scored by
    the network of the other)."""
    levels, qu = np.concatenate([np.linspace(0.002, 0.02, 10), np.linspace(0.04, 0.9, 44)]), []
    for k in (0, 1):
        net = fit_nnpu(pos[k::2], unl[k::2], 0.5, epochs=15, seed=2 + k)
        sp, su = net.forward(pos[1 - k::2])[1], net.forward(unl[1 - k::2])[1]
        qu.append((su[None, :] >= np.quantile(sp, levels)[:, None]).mean(1))
    qu, qp = np.mean(qu, axis=0), 1 - levels
    slack = np.sqrt(np.log(4 / 0.1) / 2) * (1 / np.sqrt(len(unl)) + 1 / np.sqrt(len(pos))) / 2
    best = int(np.argmin((qu + slack) / qp))
    return float(np.clip(qu[best] / qp[best], 0.05, 0.97))


def choose_cut(sp: np.ndarray, su: np.ndarray, prior: float, slack: float = 0.003) -> float:
    """Cut for the scores of held-back positives and unlabelled rows: the highest one whose estimated
    error (missed positives, and accepted rows beyond the positives' share, not below zero) is within
    ``slack`` of the least. Where the classes lie apart, every cut between them has that error; the
    highest leaves nothing but positives above it."""
    cuts = np.sort(np.concatenate([sp, su]))
    p = 1 - np.searchsorted(np.sort(sp), cuts) / len(sp)
    u = 1 - np.searchsorted(np.sort(su), cuts) / len(su)
    error = prior * (1 - p) + np.maximum(0.0, u - prior * p)
    return float(cuts[np.flatnonzero(error <= error.min() + slack)[-1]])


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for b in T.chunks(whole):
            x = features(b.column("text"))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("kind"), pa.array([r.tobytes() for r in x], pa.binary())],
                names=["doc_id", "kind", "x"])


def train(docs: DataFrame, labels: DataFrame, learn, sample: int = 6000) -> dict:
    """Weights of the network and the prior. ``learn``: condition on ``doc_id`` of rows to learn from."""
    h = F.xxhash64(F.col("doc_id"), F.lit(17))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where(learn & F.col("doc_id").isNotNull())
    trusted = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality").where(learn)
               .groupBy("doc_id").agg(F.min("quality").alias("q")).where("q = 1").select("doc_id"))
    pick = lambda df, kind: df.orderBy(h, "doc_id").limit(sample).select("doc_id", F.lit(kind).alias("kind"))
    # at most 2 * sample ids: small enough to send to every executor whatever the corpus holds
    chosen = F.broadcast(pick(trusted, 1).union(pick(ids.distinct(), 0)))
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .where(learn).join(chosen, "doc_id").select("doc_id", "kind", "text")
            .mapInArrow(_feature_rows, "doc_id long, kind int, x binary"))
    got = rows.groupBy("doc_id", "kind").agg(F.min("x").alias("x")).orderBy("kind", "doc_id").toArrow()  # 2 * sample rows at most
    kind = got.column("kind").to_numpy()
    flat = np.frombuffer(b"".join(got.column("x").to_pylist()), np.float32).reshape(-1, FEATURES)
    del got
    x = {k: flat[kind == k] for k in (0, 1)}
    if len(x[1]) < 4 or len(x[0]) < 4:
        return {"p": None, "prior": None}
    r = np.random.default_rng(3)
    for k in x:
        x[k] = x[k][r.permutation(len(x[k]))]
    mean, std = x[0].mean(0, dtype=np.float64), x[0].std(0, dtype=np.float64) + 0.05
    pos, unl = (np.clip((x[k] - mean) / std, -8, 8).astype(np.float32) for k in (1, 0))
    prior = estimate_prior(pos, unl)
    # a sixth of either set is held back for the cut; the bias moves so that it lies at a score of 0.5
    hold = lambda a: np.arange(len(a)) % 6 == 5
    net = fit_nnpu(pos[~hold(pos)], unl[~hold(unl)], prior)
    if hold(pos).any() and hold(unl).any():
        net.p[3] = net.p[3] - choose_cut(net.forward(pos[hold(pos)])[1], net.forward(unl[hold(unl)])[1], prior)
    return {"p": [a.astype(np.float32) for a in net.p], "mean": mean.astype(np.float32), "std": std.astype(np.float32), "prior": prior}


def score_texts(model: dict, col: pa.Array) -> np.ndarray:
    x = features(col)
    empty = ~x.any(1)
    if model["p"] is None:
        z = np.zeros(len(x))
    else:
        w0, b0, w1, b1 = model["p"]
        z = np.maximum(np.clip((x - model["mean"]) / model["std"], -8, 8) @ w0 + b0, 0) @ w1 + b1[0]
    return np.where(empty, 0.0, _sigmoid(z.astype(np.float64)))


def score(docs: DataFrame, model: dict, out: str = "quality_score", text: str = "text") -> DataFrame:
    """The columns of ``docs`` and the score, as a column ``out`` that ``docs`` doesn't have."""
    schema = S.StructType([*docs.schema.fields, S.StructField(out, S.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in T.chunks(whole, text):
                s = pa.array(score_texts(model, b.column(text)), pa.float64())
                yield pa.RecordBatch.from_arrays([*b.columns, s], names=[*b.schema.names, out])

    return docs.mapInArrow(run, schema)


def learn_rows(doc_id):
    return fold(doc_id, 3) != 1


def op8_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs, labels, learn_rows(F.col("doc_id")))
    out = score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), model)
    return out.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), F.col("quality_score").alias("score"),
                      (F.col("quality_score") >= 0.5).cast("int").alias("predicted"))
