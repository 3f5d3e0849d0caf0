"""Removal of long repeats (runs of ``window`` words) by recompression.

A window is ``window`` consecutive words of one document. A word goes if a
window that covers it also starts in a document of a smaller id.

1. Recompression. Rounds rewrite the word sequence: runs of one symbol get a
   name, then pairs (left, right) of neighbours, the sides being drawn from the
   symbols themselves. A name is a hash of what it stands for, so every task
   gives equal parts equal names and the rounds need no exchange. Whether a
   boundary between two symbols survives depends on ``reach`` words around it
   only; a symbol spans at most ``widest`` words, and longer runs stay spelled
   out. So two occurrences of a window have equal symbols in its interior
   (``reach`` words from either end), and at least one symbol lies there whole.
2. Every window names the highest (longest, then least hashed) whole symbol of
   its interior. Consecutive windows with the same symbol form a *bundle*: one
   row with a hash of the symbol and its reach (``g``), which all its windows
   contain, and a 128-bit hash of all the bundle's words.
3. Bundles whose ``g`` occurs in one document only can't repeat and end here.
4. A bundle seen in a smaller document goes as a whole. What is left are
   bundles in which a document first departs from others with the same ``g``:
   their windows, of each distinct bundle once, are compared by 128-bit hash.
5. The spans found meet the whole texts, and the remaining words are joined.

Copies of a passage thus cost one row a bundle and no pairs; what depends on the
size of a group is only the combined minimum of its ids.

Defined cases: a null text has no words; a null id counts as greater than every
id and as one document; rows that share an id are never each other's source;
repeated rows are judged alike; documents shorter than the window keep all
words; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_marts.llm import text as T
from retail_marts.llm.common import Scratch, table

WINDOW = 50
_G = np.uint64(0x9E3779B97F4A7C15)
_LAST = 2**63 - 1  # where a null id sorts


def rounds(window: int) -> tuple[list[tuple[str, int]], int, int]:
    """The rounds (kind, most words of a symbol after it) that leave at least half a window as
    interior, room for a whole symbol included; their reach and the widest symbol."""
    out, reach, widest, cap = [], 0, 1, 2
    while True:
        for kind, most in (("run", cap), ("pair", 2 * cap)):
            # a run is seen from any of its boundaries; a pair by the two symbols at one
            wider = reach + (max(most, widest) if kind == "run" else widest)
            if window - 2 * wider < max(2 * most - 1, window // 2):
                return out, reach, widest
            out, reach, widest = [*out, (kind, most)], wider, most
        cap *= 2


def symbols(words: np.ndarray, doc: np.ndarray, steps: list[tuple[str, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of words and name of each symbol after the rounds."""
    name, at, size = words.copy(), np.arange(words.size), np.ones(words.size, np.int64)
    for k, (kind, most) in enumerate(steps):
        if name.size < 2:
            break
        tag, salt = np.uint64(2 * k + 1), np.uint64((2 * k + 1) * int(_G) % 2**64)
        together = doc[at[1:]] == doc[at[:-1]]
        keep = np.ones(name.size, bool)
        if kind == "run":
            head = np.concatenate([[True], ~(together & (name[1:] == name[:-1]))])
            first = np.flatnonzero(head)
            total, count = np.add.reduceat(size, first), np.diff(np.append(first, name.size))
            named = (count > 1) & (total <= most)
            keep = head | ~np.repeat(named, count)
            f = first[named]
            name[f] = T.mix(name[f] * _G + count[named].astype(np.uint64) + (tag << np.uint64(32)))
            size[f] = total[named]
        else:
            left = (T.mix(name + salt) & np.uint64(1)) == 0
            f = np.flatnonzero(together & left[:-1] & ~left[1:] & (size[:-1] + size[1:] <= most))
            name[f] = T.mix((name[f] + tag) * _G + T.mix(name[f + 1] + tag))
            size[f] += size[f + 1]
            keep[f + 1] = False
        name, at, size = name[keep], at[keep], size[keep]
    return at, size, name


def _least(order: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Index of the least ``order`` (the first of equal ones) in each range lo <= i < hi."""
    span, k, best = hi - lo, 0, np.arange(order.size)
    out = np.zeros(lo.size, np.int64)
    while lo.size:
        here = (span >> k) == 1  # ranges of 2^k to 2^(k + 1) - 1 entries: two overlapping ones cover them
        a, b = best[lo[here]], best[hi[here] - (1 << k)]
        out[here] = np.where(order[a] <= order[b], a, b)
        if not (span >> (k + 1)).any():
            break
        a, b = best[:-(1 << k)], best[1 << k:]
        best = np.where(order[a] <= order[b], a, b)
        k += 1
    return out


def bundles(words: T.Words, window: int) -> tuple[np.ndarray, ...]:
    """Per bundle: document, its first window's word and number of windows, ``g`` and two hashes."""
    steps, reach, _ = rounds(window)
    none = np.zeros(0, np.int64)
    w, doc = words.hash, words.doc
    if w.size < window:
        return none, none, none, none, none, none
    p = np.flatnonzero(doc[:w.size - window + 1] == doc[window - 1:])
    if not p.size:
        return none, none, none, none, none, none
    at, size, name = symbols(w, doc, steps)
    lo, hi = np.searchsorted(at, p + reach), np.searchsorted(at + size, p + window - reach, "right")
    order = ((np.uint64(63) - np.minimum(size, 63).astype(np.uint64)) << np.uint64(58)) | (T.mix(name) >> np.uint64(6))
    top = _least(order, lo, hi)
    head = np.flatnonzero(np.concatenate([[True], top[1:] != top[:-1]]))
    n = np.diff(np.append(head, p.size))
    p, s = p[head], top[head]
    one, two = T.Runs(w), T.Runs(T.mix(w ^ _G))
    g = one.of(at[s] - reach, at[s] + size[s] + reach)
    end = p + n - 1 + window
    return doc[p], p - words.starts[doc[p]], n, g.view(np.int64), one.of(p, end).view(np.int64), two.of(p, end).view(np.int64)


_MARKS = "id long, key long, at int, n int, g long, b1 long, b2 long"


def _mark(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in T.chunks(whole):
                d, at, n, g, b1, b2 = bundles(T.Words(b.column("text"), as_is=True), window)
                if d.size:
                    row = pa.array(d)
                    yield pa.RecordBatch.from_arrays(
                        [b.column("id").take(row), b.column("key").take(row), pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32)),
                         pa.array(g), pa.array(b1), pa.array(b2)], names=["id", "key", "at", "n", "g", "b1", "b2"])
    return run


def _windows(window: int):
    """One row for each window of the listed bundles: its hash, and the bundle and place it came from."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in T.chunks(whole):
                words = T.Words(b.column("text"), as_is=True)
                todo = b.column("todo")
                row = np.repeat(np.arange(b.num_rows), todo.value_lengths().to_numpy(zero_copy_only=False))
                at, n, b1, b2 = (np.asarray(todo.flatten().field(k)) for k in ("at", "n", "b1", "b2"))
                off = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                p = np.repeat(words.starts[row] + at, n) + off
                w = [T.Runs(h).of(p, p + window).view(np.int64) for h in (words.hash, T.mix(words.hash ^ _G))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w[0]), pa.array(w[1]), b.column("id").take(pa.array(np.repeat(row, n))), pa.array(np.repeat(b1, n)), pa.array(np.repeat(b2, n)), pa.array(off.astype(np.int32))],
                    names=["w1", "w2", "id", "b1", "b2", "off"])
    return run


_KEPT = "doc_id long, kept string, n_words long, n_removed long, spans array<struct<lo:int,hi:int>>"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole texts without the words of their spans, which are merged and sorted."""
    for whole in batches:
        for b in T.chunks(whole):
            words = T.Words(b.column("text"), as_is=True)
            spans = b.column("spans")
            size = spans.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            row, flat = np.repeat(np.arange(b.num_rows), size), spans.drop_null().flatten()
            depth = np.zeros(words.hash.size + 1, np.int64)
            np.add.at(depth, words.starts[row] + np.asarray(flat.field("lo")), 1)
            np.add.at(depth, words.starts[row] + np.asarray(flat.field("hi")), -1)
            gone = np.cumsum(depth)[:-1] > 0
            # every kept word and one place after it; the last place of a document is dropped again
            keep = np.flatnonzero(~gone)
            shift = words.doc[keep]  # a space is added at each document's end, so later bytes move on
            raw = np.full(words.raw.size + b.num_rows, 0x20, np.uint8)
            moved = np.arange(words.raw.size) + np.repeat(np.arange(b.num_rows), np.diff(words.offs))
            raw[moved] = words.raw
            at, end = words.at[keep] + shift, words.end[keep] + shift
            raw[end] = 0x20
            edge = np.zeros(raw.size + 1, np.int64)
            np.add.at(edge, at, 1)
            np.add.at(edge, end + 1, -1)
            out = raw[np.cumsum(edge)[:-1] > 0]
            length = np.bincount(shift, weights=end + 1 - at, minlength=b.num_rows).astype(np.int64)
            stop = np.cumsum(length)
            kept = pa.array([out[s:max(s, e - 1)].tobytes() for s, e in zip(stop - length, stop)], pa.binary())
            total = np.diff(words.starts)
            removed = np.bincount(words.doc[gone], minlength=b.num_rows)
            step = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
            lo, hi = np.flatnonzero(step[:-1] == 1), np.flatnonzero(step == -1)
            first = words.starts[:-1]
            per: list[list[dict]] = [[] for _ in range(b.num_rows)]
            for x, y in zip(lo, hi):  # a run of removed words may go on in the next document: split it there
                for d in range(words.doc[x], words.doc[y - 1] + 1):
                    f, e = max(x, first[d]), min(y, words.starts[d + 1])
                    if f < e:
                        per[d].append({"lo": int(f - first[d]), "hi": int(e - first[d])})
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), kept.cast(pa.string()), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(per, pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())])))],
                names=["doc_id", "kept", "n_words", "n_removed", "spans"])


def repeat_spans(src: DataFrame, window: int, scratch: Scratch) -> DataFrame:
    """(id, key, spans): word ranges to remove from each text that has some."""
    marks = scratch.put(src.where("text IS NOT NULL").select("id", "key", "text").mapInArrow(_mark(window), _MARKS), "marks")
    shared = scratch.put(marks.groupBy("g").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("g"), "shared")
    open_ = scratch.put(marks.join(shared, "g", "left_semi"), "open")  # a table on either side: Spark can split a hot g
    scratch.drop(marks, shared)
    distinct = scratch.put(open_.groupBy("b1", "b2").agg(
        F.min("id").alias("first"), F.max("id").alias("last"), F.min("g").alias("g"), F.min("n").alias("n"),
        F.min(F.struct("id", "key", "at")).alias("one")), "distinct")
    # one g in several bundles that first come from different documents: their windows may meet
    contested = distinct.groupBy("g").agg(F.min("first").alias("a"), F.max("first").alias("z")).where("a < z").select("g")
    todo = (distinct.join(contested, "g", "left_semi").select("one.id", "one.key", F.struct("one.at", "n", "b1", "b2").alias("t"))
            .groupBy("id", "key").agg(F.collect_list("t").alias("todo")))
    windows = scratch.put(src.join(todo, ["id", "key"]).select("id", "text", "todo")
                          .mapInArrow(_windows(window), "w1 long, w2 long, id long, b1 long, b2 long, off int"), "windows")
    seen = scratch.put(windows.groupBy("w1", "w2").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
                       .where("lo < hi").select("w1", "w2", "lo"), "seen")
    late = (windows.join(seen, ["w1", "w2"]).where("id > lo").groupBy("b1", "b2").agg(F.collect_set("off").alias("offs")))
    info = scratch.put(distinct.select("b1", "b2", "first", "last").join(late, ["b1", "b2"], "left")
                       .where("first < last OR offs IS NOT NULL").select("b1", "b2", "first", "offs"), "info")
    scratch.drop(windows, seen, distinct)
    span = lambda lo, hi: F.struct(lo.cast("int").alias("lo"), hi.cast("int").alias("hi"))
    found = (open_.select("id", "key", "at", "n", "b1", "b2").join(info, ["b1", "b2"]).where("id > first OR offs IS NOT NULL")
             .select("id", "key", F.when(F.col("id") > F.col("first"), F.array(span(F.col("at"), F.col("at") + F.col("n") - 1 + window)))
                     .otherwise(F.transform("offs", lambda o: span(F.col("at") + o, F.col("at") + o + window))).alias("s")))
    out = scratch.put(found.groupBy("id", "key").agg(F.flatten(F.collect_set("s")).alias("spans")), "spans")
    scratch.close(out)
    return out


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per input row: doc_id, kept (the remaining words joined by one space), n_words,
    n_removed, spans (removed word ranges lo <= i < hi, merged)."""
    if window < 1:
        raise ValueError("a window holds at least one word")
    scratch = Scratch(docs.sparkSession, "repeats")
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    src = src.withColumn("id", F.coalesce("doc_id", F.lit(_LAST))).withColumn("key", F.xxhash64("text"))
    spans = repeat_spans(src, window, scratch)
    return src.join(spans, ["id", "key"], "left").select("doc_id", "text", "spans").mapInArrow(_cut, _KEPT)


def op11_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its repeats of 50 words: doc_id, n_words, n_removed, kept_sha256."""
    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP11_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT r, coalesce(doc_id, 9223372036854775807) AS id, p, array_to_string(w[p : p + 49], ' ') AS s
        FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM d WHERE len(w) >= 50)),
bad AS (SELECT r, p FROM win JOIN (SELECT s, min(id) AS lo FROM win GROUP BY s HAVING min(id) < max(id)) USING (s) WHERE id > lo),
gone AS (SELECT DISTINCT r, unnest(range(p, p + 50)) AS i FROM bad),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY i) AS k FROM (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d) ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, (SELECT count(*) FROM gone WHERE gone.r = d.r)::BIGINT AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""
