"""Language ID by mixture inference: EM over a document's words, languages chosen by penalised likelihood.

Model: each word of a document is drawn from one of the learned languages, whose
byte-trigram chain (with word ends) gives the word's likelihood. A language's chain is
counted over all learning documents: context of two bytes hashed to 2^12, times
64 values of the next byte; the counts, not texts, go to the driver (at most
2^18 numbers per language).

1. Expectation-maximisation over all languages estimates the document's proportions.
2. Sets of its 1, 2, 3, ... most probable languages are refitted in turn; a larger set
   is taken only if its log likelihood rises by more than half the logarithm of the
   number of words (BIC). Proportions outside the chosen set are zero.
3. The prediction is the language of the largest proportion, its score that proportion.

Defined cases: a null text, and one without any letter, is ``und`` with score 0;
so is every text if nothing was learned; null languages aren't learned from; ties go to
the language first in order; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_marts.llm import text as T
from retail_marts.llm.common import fold, table

CONTEXT_BITS, NEXT_BITS = 12, 6
BUCKETS = 1 << (CONTEXT_BITS + NEXT_BITS)
SMOOTH, ROUNDS, REFITS = 0.2, 8, 5
UNKNOWN = "und"

_SPACE = 0x20


def trigrams(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all trigrams in order, where each word's begin, and per document its first word (one more entry)."""
    raw, offs = T.buffers(col)
    size = np.diff(offs)
    clean = np.where(T.ALNUM[raw], T.lower_bytes(raw), _SPACE).astype(np.int64)
    b = np.full(raw.size + 2 * len(col) + 3, _SPACE, np.int64)  # two spaces before each document
    b[np.arange(raw.size) + 2 * (np.repeat(np.arange(len(col)), size) + 1)] = clean
    prev, now = b[1:-1], b[2:]
    two = np.where(prev == _SPACE, _SPACE, b[:-2])
    use = np.flatnonzero((now != _SPACE) | (prev != _SPACE))
    context = ((two[use] << 8 | prev[use]) * 40503 >> 4) & ((1 << CONTEXT_BITS) - 1)
    start = np.flatnonzero((now[use] != _SPACE) & (prev[use] == _SPACE))
    first = np.searchsorted(use[start] + 2, np.append(offs[:-1] + 2 * np.arange(1, len(col) + 1), b.size))
    return context << NEXT_BITS | now[use] & 63, start, first


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for whole in batches:
        for b in T.chunks(whole):
            grams, start, first = trigrams(b.column("text"))
            cut = np.append(start, grams.size)[first]
            langs = np.array(b.column("lang").to_pylist(), object)
            doc = np.repeat(np.arange(len(langs)), np.diff(cut))
            for lang in set(langs):
                n = np.bincount(grams[(langs == lang)[doc]], minlength=BUCKETS)
                total[lang] = total[lang] + n if lang in total else n
    for lang, n in total.items():
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * at.size, pa.string()), pa.array(at, pa.int64()), pa.array(n[at], pa.int64())],
                                         names=["lang", "bucket", "n"])


def train(docs: DataFrame, learn) -> tuple[list[str], np.ndarray]:
    """Languages in order, and log probabilities (bucket, language). ``learn``: condition for rows to learn from."""
    src = docs.where(learn).where("lang IS NOT NULL AND text IS NOT NULL").select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    got = (src.mapInArrow(_count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))).toArrow()
    names = np.array(got.column("lang").to_pylist(), object)
    langs = sorted(set(names))
    counts = np.zeros((len(langs), 1 << CONTEXT_BITS, 1 << NEXT_BITS))
    if langs:
        counts.reshape(len(langs), -1)[np.searchsorted(langs, names.astype(str)), got.column("bucket").to_numpy()] = got.column("n").to_numpy()
    # a context's own next bytes, smoothed by the language's bytes in general
    general = (counts.sum(1) + 1) / (counts.sum((1, 2)) + 64)[:, None]
    p = (counts + SMOOTH * 64 * general[:, None, :]) / (counts.sum(2, keepdims=True) + SMOOTH * 64)
    return langs, np.ascontiguousarray(np.log(p).reshape(len(langs), BUCKETS).T.astype(np.float32))


def _em(like: np.ndarray, starts: np.ndarray, pi: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions after ``rounds`` steps from ``pi``, and each document's log likelihood with those
    before the last step. ``like``: likelihoods of words up to a factor of their own; each document has words."""
    n = np.diff(np.append(starts, len(like)))
    for _ in range(rounds):
        r = like * np.repeat(pi, n, axis=0)
        total = r.sum(1)
        r /= total[:, None]
        pi = np.add.reduceat(r, starts, axis=0) / n[:, None]
    return pi, np.add.reduceat(np.log(total), starts)


def proportions(like: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Language proportions of documents (each with a word at least) after the choice of languages."""
    docs, k = starts.size, like.shape[1]
    n = np.diff(np.append(starts, len(like)))
    pi, _ = _em(like, starts, np.full((docs, k), 1.0 / k), ROUNDS)
    order = np.argsort(-pi, axis=1, kind="stable")
    best, best_ll = np.zeros((docs, k)), np.full(docs, -np.inf)
    live = np.arange(docs)
    for size in range(1, k + 1):
        own = np.repeat(np.isin(np.arange(docs), live), n)
        part, cut = like[own], np.concatenate([[0], np.cumsum(n[live])[:-1]])
        start = np.zeros((live.size, k))
        np.put_along_axis(start, order[live, :size], np.maximum(np.take_along_axis(pi[live], order[live, :size], 1), 1e-6), 1)
        fit, ll = _em(part, cut, start / start.sum(1, keepdims=True), 1 if size == 1 else REFITS)
        gain = ll - best_ll[live] > (0.5 * np.log(n[live] + 1) if size > 1 else 0)
        live, fit, ll = live[gain], fit[gain], ll[gain]
        best[live], best_ll[live] = fit, ll
        if not live.size:
            break
    return best


def predict(docs: DataFrame, langs: list[str], logp: np.ndarray) -> DataFrame:
    """doc_id, lang_pred, score and ``mixture`` (lang, share of the words) of every document."""
    kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in T.chunks(whole):
                pred, score, mixture = [UNKNOWN] * b.num_rows, np.zeros(b.num_rows), [[] for _ in range(b.num_rows)]
                grams, start, first = trigrams(b.column("text"))
                ok = np.flatnonzero((np.diff(first) > 0) & np.asarray(b.column("letter").fill_null(False)))
                if ok.size and langs:
                    like = np.add.reduceat(logp[grams], start, axis=0)
                    like = np.exp(np.maximum(like - like.max(1, keepdims=True), -60)).astype(np.float64)
                    keep = np.repeat(np.isin(np.arange(b.num_rows), ok), np.diff(first))
                    share = proportions(like[keep], np.concatenate([[0], np.cumsum(np.diff(first)[ok])[:-1]]))
                    for d, p in zip(ok, share):
                        pred[d], score[d] = langs[int(p.argmax())], min(float(p.max()), 1.0)
                        mixture[d] = [{"lang": langs[i], "share": float(p[i])} for i in np.flatnonzero(p)]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(pred, pa.string()), pa.array(score), pa.array(mixture, kind)],
                                                 names=["doc_id", "lang_pred", "score", "mixture"])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn(
        "letter", F.col("text").rlike(r"\p{L}"))
    return src.mapInArrow(run, "doc_id long, lang_pred string, score double, mixture array<struct<lang:string,share:double>>")


def op3_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score, mixture for every document."""
    docs, doc_id = table(spark, sf_dir, "documents"), F.col("doc_id")
    langs, logp = train(docs, fold(doc_id, 3) != 1)
    return predict(docs, langs, logp).select("doc_id", (fold(doc_id, 3) == 1).alias("held_out"), "lang_pred", "score", "mixture")
