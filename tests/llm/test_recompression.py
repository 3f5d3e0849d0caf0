"""Recompression: equal interiors get equal symbols; removal against comparing every window."""

import random
import re

import numpy as np
import pytest

from retail_marts.llm import recompression as R


def brute(rows, window):
    words = [re.findall("[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    ids = [2**63 - 1 if i is None else i for i, _ in rows]
    least: dict = {}
    for i, w in zip(ids, words):
        for p in range(len(w) - window + 1):
            k = tuple(w[p:p + window])
            least[k] = min(least.get(k, i), i)
    out = []
    for (i, _), j, w in zip(rows, ids, words):
        gone = {x for p in range(len(w) - window + 1) if least[tuple(w[p:p + window])] < j for x in range(p, p + window)}
        out.append((i, " ".join(x for k, x in enumerate(w) if k not in gone), len(w), len(gone)))
    return sorted(map(repr, out))


def documents(seed, vocab):
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randrange(vocab)}"
    base = [[word() for _ in range(rnd.randint(0, 200))] for _ in range(12)]
    rows = []
    for d in range(70):
        t = []
        for _ in range(rnd.randint(0, 5)):
            b = rnd.choice(base)
            a = rnd.randint(0, len(b))
            t += b[a:a + rnd.randint(0, 120)] + [word() for _ in range(rnd.choice([0, 0, 5]))]
            if t and rnd.random() < 0.2:
                t[rnd.randrange(len(t))] = "É"
        rows.append((rnd.choice([d, d, None, 3]), "\t ".join(t) if rnd.random() < 0.9 else None))
    return rows


@pytest.mark.parametrize("window,vocab", [(6, 2), (17, 3), (50, 1), (50, 2), (50, 2000)])
def test_removal_equals_comparing_every_window(spark, window, vocab):
    rows = documents(window + vocab, vocab)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(repr((r.doc_id, r.kept, r.n_words, r.n_removed)) for r in R.remove_repeats(df, window).collect())
    assert got == brute(rows, window)


def test_spans_are_what_is_removed(spark):
    rows = documents(5, 50)
    got = R.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 17).collect()
    for r in got:
        assert sum(s.hi - s.lo for s in r.spans) == r.n_removed
        assert all(a.hi < b.lo for a, b in zip(r.spans, r.spans[1:]))


@pytest.mark.parametrize("vocab", [1, 2, 4, 1000])
def test_symbols_inside_a_window_do_not_depend_on_its_surroundings(vocab):
    rng = np.random.default_rng(vocab)
    steps, reach, widest = R.rounds(50)
    names = R.T.mix(np.arange(1, vocab + 1, dtype=np.uint64))
    for _ in range(200):
        core = rng.choice(names, 50)
        seen = set()
        for _ in range(2):
            before = rng.choice(names, rng.integers(0, 40))
            w = np.concatenate([before, core, rng.choice(names, rng.integers(0, 40))])
            at, size, name = R.symbols(w, np.zeros(w.size, int), steps)
            at = at - before.size
            ok = (at >= reach) & (at + size <= 50 - reach)
            seen.add(tuple(zip(at[ok], size[ok], name[ok])))
            assert size.max() <= widest
        assert len(seen) == 1 and seen.pop()


def test_hot_passage_and_odd_rows(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, f"own{i} {passage} tail{i}", "x") for i in range(300)] + [(1000, "", "x"), (1001, None, None), (1002, "é " * 30_000, "x")] + [(5, f"own5 {passage} tail5", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words string")
    got = {(r.doc_id, r.n_words, r.n_removed) for r in R.remove_repeats(df).collect()}
    assert {(i, 62, 0 if i == 0 else 60) for i in range(300)} | {(1000, 0, 0), (1001, 0, 0), (1002, 30_000, 0)} == got
    assert R.remove_repeats(df.limit(0)).count() == 0
