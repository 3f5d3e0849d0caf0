"""Benchmark decontamination: BM25 index of the test items, block-max WAND, overlap check.

Test items are cut into entries of at most 64 words, as equal in length as can be, so a
longer item has entries of 32 words or more. The inverted index holds for
each word the entries it occurs in with its BM25 weight, as a share of the
entry's own score, so an entry found whole scores 1. Entries stand in blocks
of four, and for each word and block the largest weight is kept.

Every passage of every document is a query: windows of 96 words that start every
32, so any run of 65 words lies whole in one. Evaluation is block-max WAND over
many passages at once:

* threshold: that of an entry is the least weight a passage can hold and still verify
  (its lighter side quoted to 0.8, or both to 0.5), and 0.35 at most, so retrieval is never stricter
  than the verification behind it;
* pivot: words are ordered by how common they are; the most common ones, which
  together never reach half of an entry's threshold, can't make a result alone, so
  only the others open blocks;
* block bound: a passage goes on with a block only if the block's maxima of its
  words, plus what the common words could add, reach the threshold;
* the entries of those blocks get their exact score from the passage's words.

All entries at or above their threshold are retrieved and verified: the entry's
first half is its question, the second its answer (or the columns given), and
their runs of five words are looked up in the passage with its neighbours. A
document is contaminated if one part is found to 0.8 or both to 0.5. A part of fewer
than seven words (under three runs) is too little to tell: the whole entry stands in
its place; one of seven must be there whole. No match rests on fewer than five words.

The index goes to the executors in shards of at most ``SHARD_BYTES`` of item text;
each shard is one pass over the documents, whatever their number.

Defined cases: null or wordless documents and items match nothing, nor do items of
fewer than five words, which any text may hold; repeated
items are reported once each; items with a null id aren't reported; other
columns stay as they are; empty tables give no hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as S

from retail_marts.llm import text as T
from retail_marts.llm.common import Scratch, free_name, table

ENTRY, STRIPE, WINDOW, BLOCK, GRAM = 64, 32, 3, 4, 5
LEAST = 7  # words of a part that can stand alone
K1, B = 1.2, 0.75
SHARD_BYTES = 8 << 20
THRESHOLD, ONE_PART, BOTH_PARTS = 0.35, 0.8, 0.5
HITS = "array<struct<item_id:bigint,score:double,question:double,answer:double>>"


def _grams(words: np.ndarray) -> np.ndarray:
    """Distinct runs of five words; a shorter part is one run."""
    if not words.size:
        return np.zeros(0, np.uint64)
    n = min(GRAM, words.size)
    return np.unique(T.shingles(words, np.array([0, words.size]), n)[0])


def _lost(weight: np.ndarray, cost: np.ndarray, drops: int, run: int) -> float:
    """The most weight that words lose when runs of ``run`` words may be missing at a cost of ``drops`` in all.

    A word is lost if every run that holds it is. Runs are taken from left to right, ``best[d, r]`` being the most
    weight lost at cost d where the last r runs (``run`` at most) are missing: a word is lost once its last run is."""
    m = cost.size
    never = -1.0
    best = np.full((drops + 1, run + 1), never)
    best[0, run] = 0.0  # before the first run all are missing
    for i in range(m):
        new = np.full_like(best, never)
        new[:, 0] = best.max(axis=1)  # run i is there
        c = int(cost[i])
        if c <= drops:
            # run i missing: the word it is the last to hold, i itself, is lost if the run - 1 before it are missing too
            from_ = best[:drops + 1 - c]
            for r in range(run + 1):
                to = min(r + 1, run)
                gain = weight[i] if to == run else 0.0
                new[c:, to] = np.maximum(new[c:, to], np.where(from_[:, r] >= 0, from_[:, r] + gain, never))
        best = new
    # words past the start of the last run: lost if all runs that hold them are missing
    out = best[:, 0].max()
    for r in range(1, run + 1):
        tail = float(weight[max(m, m - r + run - 1):].sum())
        top = best[:, r].max()
        if top >= 0:
            out = max(out, top + tail)
    return max(float(out), 0.0)


def least_weight(e: dict, weight: dict[int, float]) -> float:
    """A lower bound of the weight of an entry's words in a passage that quotes enough of it to verify.

    A repeated run costs nothing after its first, a repeated word has its weight shared by its places; both only lower the bound."""
    def left(words: np.ndarray, grams: int, share: float, own: dict[int, float]) -> float:
        run = min(GRAM, words.size)
        each = [tuple(words[i:i + run].tolist()) for i in range(words.size - run + 1)]
        seen: set = set()
        cost = np.array([0 if g in seen or seen.add(g) else 1 for g in each])
        w = np.array([own[t] for t in words.tolist()])
        drops = grams - int(np.ceil(share * grams - 1e-9))
        return float(w.sum()) - _lost(w, cost, drops, run)

    def spread(places: np.ndarray) -> dict[int, float]:
        t, n = np.unique(places, return_counts=True)
        return {x: weight[x] / k for x, k in zip(t.tolist(), n.tolist())}

    sides = [(e["side"][k], e[k].size) for k in ("question", "answer") if e[k].size]
    if not sides:
        return 0.0
    bounds = [left(x, n, ONE_PART, spread(x)) for x, n in sides]
    if len(sides) == 2:
        both = spread(np.concatenate([x for x, _ in sides]))
        bounds.append(sum(left(x, n, BOTH_PARTS, both) for x, n in sides))
    return min(bounds)


def entries(items: list[tuple[int, str, str]]) -> list[dict]:
    """Entries of (item_id, question, answer) rows; an empty answer means: second half of the text."""
    out = []
    for item, question, answer in items:
        w = T.Words(pa.array([question or "", answer or ""]), T.ALNUM)
        q, a = w.hash[:w.starts[1]], w.hash[w.starts[1]:]
        words, half = np.concatenate([q, a]), q.size if a.size else (q.size + 1) // 2
        side = np.arange(words.size) < half
        pieces = -(-words.size // ENTRY)
        for part, own in zip(np.array_split(words, pieces), np.array_split(side, pieces)) if pieces else ():
            if own.all() or not own.any():  # a piece of a long item lies on one side: halve it
                own = np.arange(part.size) < (part.size + 1) // 2
            terms, tf = np.unique(part, return_counts=True)
            sides = {"question": part[own], "answer": part[~own]}
            sides = {k: x if x.size >= LEAST else part if part.size >= GRAM else part[:0] for k, x in sides.items()}
            out.append({"item": item, "n": part.size, "terms": terms, "tf": tf, "words": {k: x.size for k, x in sides.items()}, "side": sides,
                        **{k: _grams(x) for k, x in sides.items()}})
    return out


class Index:
    """The index of one shard. ``df``, ``total`` and ``length`` describe the entries of all shards."""

    def __init__(self, found: list[dict], df: dict[int, int], total: int, length: float, threshold: float = THRESHOLD):
        self.entries = found
        self.vocab = np.unique(np.concatenate([e["terms"] for e in found])) if found else np.zeros(0, np.uint64)
        freq = np.array([df.get(int(t), 1) for t in self.vocab], float)
        idf = np.log1p((total - freq + 0.5) / (freq + 0.5))
        self.blocks = -(-len(found) // BLOCK)
        rows = []
        for k, e in enumerate(found):
            t = np.searchsorted(self.vocab, e["terms"])
            w = idf[t] * e["tf"] * (K1 + 1) / (e["tf"] + K1 * (1 - B + B * e["n"] / length))
            e["w"], e["t"] = w / w.sum(), t
            e["threshold"] = min(threshold, least_weight(e, dict(zip(e["terms"].tolist(), e["w"].tolist()))))
            rows.append(np.stack([t, np.full(t.size, k // BLOCK), e["w"]], 1))
        post = np.concatenate(rows) if rows else np.zeros((0, 3))
        # pivot: the most common words whose weights together stay below half of every entry's threshold
        order = np.argsort(-freq, kind="stable")
        place = np.empty(order.size, int)
        place[order] = np.arange(order.size)
        cut = order.size
        for e in found:
            by = np.argsort(place[e["t"]], kind="stable")
            over = np.flatnonzero(np.cumsum(e["w"][by]) >= e["threshold"] / 2)
            if over.size:
                cut = min(cut, int(place[e["t"]][by][over[0]]))
        self.opens = place >= cut
        self.need = np.full(self.blocks, np.inf)
        self.least = np.full((self.blocks, BLOCK), np.inf)
        for k, e in enumerate(found):
            self.least[k // BLOCK, k % BLOCK] = e["threshold"]
            self.need[k // BLOCK] = min(self.need[k // BLOCK], e["threshold"] - float(e["w"][~self.opens[e["t"]]].sum()))
        # one posting per (word, block), words in order: the weights of the block's entries, and the largest of them
        width = max(self.blocks, 1)
        slot = np.concatenate([np.full(e["t"].size, k % BLOCK) for k, e in enumerate(found)]) if found else np.zeros(0, int)
        uniq, inv = np.unique(post[:, 0].astype(np.int64) * width + post[:, 1].astype(np.int64), return_inverse=True)
        self.post_weights = np.zeros((uniq.size, BLOCK))
        self.post_weights[inv, slot] = post[:, 2]
        self.post_block, self.post_max = uniq % width, self.post_weights.max(axis=1, initial=0.0)
        self.post_at = np.searchsorted(uniq // width, np.arange(self.vocab.size + 1))
        self.grams = {n: np.unique(np.concatenate(g)) for n in range(1, GRAM + 1)
                      if (g := [e[side] for e in found for side in ("question", "answer") if self.gram_words(e, side) == n])}
        self.gate = np.zeros(1 << 16, bool)
        self.gate[(self.vocab >> np.uint64(48)).astype(int)] = True

    def lookup(self, h: np.ndarray) -> np.ndarray:
        """Word number of each hash, -1 for words that no entry has."""
        out = np.full(h.size, -1, np.int64)
        maybe = np.flatnonzero(self.gate[(h >> np.uint64(48)).astype(np.int64)])
        if maybe.size:
            at = np.minimum(np.searchsorted(self.vocab, h[maybe]), self.vocab.size - 1)
            hit = self.vocab[at] == h[maybe]
            out[maybe[hit]] = at[hit]
        return out

    @staticmethod
    def gram_words(e: dict, side: str) -> int:
        """Words in a run of that side of an entry; 0 for a side without runs."""
        return min(GRAM, e["words"][side])

    def postings(self, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of words ``t``: each posting's place in ``t`` and its number."""
        many = self.post_at[t + 1] - self.post_at[t]
        at = np.repeat(self.post_at[t] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(int(many.sum()))
        return np.repeat(np.arange(t.size), many), at

    def search(self, words: T.Words) -> list[dict[int, tuple[float, float, float]]]:
        """Per document the verified entries: item -> (score, question, answer)."""
        found: list[dict[int, tuple[float, float, float]]] = [{} for _ in range(words.starts.size - 1)]
        if not self.vocab.size or not words.hash.size:
            return found
        term = self.lookup(words.hash)
        # stripes of 32 words, numbered through all documents; each known word once a stripe
        per = -(-np.diff(words.starts) // STRIPE)
        first = np.concatenate([[0], np.cumsum(per)])
        doc_of = np.repeat(np.arange(per.size), per)
        # windows start at every stripe but a document's last two, which the window before holds
        start = np.arange(doc_of.size) - first[doc_of] <= np.maximum(per[doc_of] - WINDOW, 0)
        known = np.flatnonzero(term >= 0)
        stripe = first[words.doc[known]] + (known - words.starts[words.doc[known]]) // STRIPE
        size = self.vocab.size
        once = np.unique(stripe * size + term[known])
        stripe, t = once // size, once % size
        reached = None
        step = max(64, 2_000_000 // self.blocks)
        for lo in range(0, doc_of.size, step):  # windows that start in these stripes
            hi = min(lo + step, doc_of.size)
            a, b = np.searchsorted(stripe, [lo, hi + WINDOW - 1])
            pairs = []
            for j in range(WINDOW):
                w = stripe[a:b] - j
                ok = (w >= lo) & (w < hi)
                ok[ok] = start[w[ok]] & (doc_of[w[ok]] == doc_of[stripe[a:b][ok]])
                pairs.append((w[ok] - lo) * size + t[a:b][ok])
            pair = np.unique(np.concatenate(pairs))
            window, word = pair // size, pair % size  # each window's distinct words
            # block bound, from the words that open blocks
            opens = self.opens[word]
            row, at = self.postings(word[opens])
            cell = window[opens][row] * self.blocks + self.post_block[at]
            bound = np.bincount(cell, weights=self.post_max[at], minlength=(hi - lo) * self.blocks).reshape(hi - lo, self.blocks)
            goes_on = bound >= self.need[None, :] - 1e-9
            # exact scores of the entries of the blocks that go on
            some = goes_on.any(axis=1)[window]
            row, at = self.postings(word[some])
            cell = window[some][row] * self.blocks + self.post_block[at]
            live = goes_on.ravel()[cell]
            cells, number = np.unique(cell[live], return_inverse=True)
            score = np.stack([np.bincount(number, weights=self.post_weights[at[live], k], minlength=cells.size) for k in range(BLOCK)], 1)
            c, k = np.nonzero(score >= self.least[cells % self.blocks] - 1e-9)
            if not c.size:
                continue
            # verification; passages in whose neighbourhood no entry's run of words occurs need none
            if reached is None:
                reached = self._reached(words)
            s, e = cells[c] // self.blocks + lo, cells[c] % self.blocks * BLOCK + k
            d = doc_of[s]
            begin = words.starts[d] + (s - first[d]) * STRIPE
            left = np.maximum(words.starts[d], begin - ENTRY)
            right = np.minimum(words.starts[d + 1], np.minimum(begin + WINDOW * STRIPE, words.starts[d + 1]) + ENTRY)
            near: dict[tuple[int, int], dict[int, np.ndarray]] = {}
            for i in np.flatnonzero(reached[right] > reached[left]):
                entry, span = self.entries[e[i]], (int(left[i]), int(right[i]))
                if entry["item"] is None:
                    continue
                if span not in near:
                    part = words.hash[span[0]:span[1]]
                    near[span] = {n: T.shingles(part, np.array([0, part.size]), n)[0] for n in self.grams}
                share = [float(np.isin(entry[side], near[span][self.gram_words(entry, side)]).mean()) if entry[side].size else 0.0
                         for side in ("question", "answer")]
                if max(share) >= ONE_PART or min(share) >= BOTH_PARTS:
                    had = found[d[i]].get(entry["item"], (0.0, 0.0, 0.0))
                    found[d[i]][entry["item"]] = max(had, (float(score[c[i], k[i]]), *share))
        return found

    def _reached(self, words: T.Words) -> np.ndarray:
        """Running count of the words at which a run begins that some entry holds too."""
        hit = np.zeros(words.hash.size + 1, np.int64)
        count = np.diff(words.starts)
        for n, grams in self.grams.items():
            h, d = T.shingles(words.hash, words.starts, n)
            runs = np.maximum(count - n + 1, np.minimum(count, 1))  # a shorter document counts as one
            at = words.starts[d] + np.arange(h.size) - (np.cumsum(runs) - runs)[d]
            place = np.minimum(np.searchsorted(grams, h), grams.size - 1)
            hit[at[grams[place] == h] + 1] = 1
        return np.cumsum(hit)


def build(items: DataFrame, question: str = "text", answer: str | None = None, item_id: str = "item_id") -> list[Index]:
    """One index per shard. The words' entry counts, their number and mean length are those of all items."""
    src = items.select(F.col(item_id).cast("long").alias("item_id"), F.coalesce(F.col(question).cast("string"), F.lit("")).alias("q"),
                       F.coalesce(F.col(answer).cast("string") if answer else F.lit(None).cast("string"), F.lit("")).alias("a")).distinct()

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            es = entries(list(zip(*(b.column(i).to_pylist() for i in range(3)))))
            if es:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([e["n"] for e in es], pa.int64()), pa.array([e["terms"].view(np.int64) for e in es], pa.list_(pa.int64()))],
                    names=["n", "terms"])

    made = src.mapInArrow(terms, "n long, terms array<long>")
    total, length = made.agg(F.count("*"), F.avg("n")).first()
    if not total:
        return []
    size = src.agg(F.sum(F.octet_length("q") + F.octet_length("a"))).first()[0]
    shards = -(-size // SHARD_BYTES)
    out = []
    df = made.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    for k in range(shards):
        own = src.where(F.pmod(F.xxhash64("item_id", "q"), F.lit(shards)) == k)
        found = entries(sorted(((r["item_id"], r["q"], r["a"]) for r in own.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1:])))
        mine = own.mapInArrow(terms, "n long, terms array<long>").select(F.explode("terms").alias("term")).distinct()
        freq = {r["term"] & 0xFFFFFFFFFFFFFFFF: r["df"] for r in df.join(mine, "term").collect()}
        out.append(Index(found, freq, total, length))
    return out


def find_leaks(docs: DataFrame, index: list[Index], out: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns of ``docs`` (or those of ``keep``) and ``out``: its verified items, by id, as an array of structs."""
    df = docs.withColumn(out, F.lit(None).cast(HITS))
    keep = docs.columns if keep is None else keep
    if not index:
        return df.select(*keep, out)
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("question", pa.float64()), ("answer", pa.float64())]))
    scratch = Scratch(docs.sparkSession, "leaks")
    for n, shard in enumerate(index):
        # the last pass is the last to need the text
        names = keep if n + 1 == len(index) else docs.columns
        schema = S.StructType([*(docs.schema[c] for c in names), S.StructField(out, df.schema[out].dataType)])

        def run(batches: Iterator[pa.RecordBatch], shard: Index = shard, names: list[str] = names) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for b in T.chunks(whole, text):
                    hits = [{x["item_id"]: x for x in had or ()} for had in b.column(out).to_pylist()]
                    for own, new in zip(hits, shard.search(T.Words(b.column(text), T.ALNUM))):
                        own.update({i: dict(zip(("item_id", "score", "question", "answer"), (i, *v))) for i, v in new.items()})
                    lists = pa.array([[h[i] for i in sorted(h)] for h in hits], kind)
                    yield pa.RecordBatch.from_arrays([*map(b.column, names), lists], names=[*names, out])

        df = df.mapInArrow(run, schema)
        if len(index) > 1:
            df = scratch.put(df, "shard")
    return df


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that hold no test item."""
    hits = free_name(docs, "hits")
    return find_leaks(docs, build(items), hits).where(F.size(F.coalesce(hits, F.array())) == 0).drop(hits)


def op7_bm25_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, contaminated, n_items, items, best score and overlaps."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    df = find_leaks(docs, build(table(spark, sf_dir, "benchmark")), "hits", keep=["doc_id"]).withColumn("hits", F.coalesce("hits", F.array()))
    return df.select("doc_id", (F.size("hits") > 0).cast("int").alias("contaminated"), F.size("hits").alias("n_items"),
                     F.col("hits.item_id").alias("items"), F.array_max("hits.score").alias("score"),
                     F.array_max("hits.question").alias("question_overlap"), F.array_max("hits.answer").alias("answer_overlap"))
