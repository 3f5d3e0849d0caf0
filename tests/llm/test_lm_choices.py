"""The language model's tokens, lookups and the weights that a token costs."""

import re

import numpy as np
import pyarrow as pa

from retail_marts.llm import maxent_lm


def test_tokens_are_the_same_where_their_lowered_words_are():
    r = np.random.default_rng(8)
    words = ["", "a", "A", "Zz", "zZ", "[", "{", "@", "`", "É", "é", "x" * 8, "X" * 8, "x" * 9, "x" * 16, "x" * 17, "x" * 16 + "y", "x\0", "x\0\0", "naïve", "12345678", "123456789"]
    texts = [None, "", " \t\n\x0b\x0c\r", "\x08\x0e"] + ["".join(w + r.choice([" ", "\t", "\r\n", "\x0b ", "\x0c"]) for w in r.choice(words, 30)) for _ in range(40)]
    texts += ["a" * 100, "end", "of a", " text"]
    want = [[re.sub(rb"[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())] + [None] for t in texts]
    for col in (pa.array(texts), pa.array(["cut", *texts, "off"])[1:-1]):
        h, starts = maxent_lm.tokens(col)
        assert np.diff(starts).tolist() == [len(w) for w in want]
        by = dict(zip((x for w in want for x in w), h.tolist()))
        assert [by[x] for w in want for x in w] == h.tolist() and len(set(by.values())) == len(by)
    f = maxent_lm.contexts(h, starts)[0]
    last = [p for w in want for p in ["", *w[:-1]]]
    seen = dict(zip(last, f.tolist()))
    assert [seen[p] for p in last] == f.tolist() and len(set(seen.values())) == len(seen)


def test_lookup_equals_a_dictionary():
    r = np.random.default_rng(9)
    h = np.unique(np.concatenate([r.integers(0, 1 << 63, 3000), np.arange(40) + (5 << 46), [0]]).astype(np.uint64))  # forty begin alike
    order = r.permutation(h.size)
    c = np.arange(h.size, 0, -1)
    v = maxent_lm.Vocabulary(h[order], c, int(c.sum()), h.size)
    ask = np.concatenate([h, h + np.uint64(1), [np.uint64(2**64 - 1)]])
    known = dict(zip(h[order].tolist(), c.tolist()))
    assert v.find(ask)[0].tolist() == [known.get(x, -1) for x in ask.tolist()]


def test_a_token_moves_the_weights_on_its_own_way_only(spark):
    d = spark.createDataFrame([(i, " ".join(f"w{i * 5 + k}" for k in range(5))) for i in range(400)], "doc_id long, text string")
    v, w = maxent_lm.train(d, maxent_lm.token_counts(d))
    moved = sum(np.count_nonzero(x != y) for x, y in zip(w.tables(), maxent_lm.Weights(v).tables()))
    # the bias and four features of each token, each for: the last class or not, and five halvings for a class and a member or a branch
    assert 0 < moved <= 400 * 6 * 5 * (1 + 5 * max(2, v.depth))
