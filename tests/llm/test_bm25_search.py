"""The block-max search against scoring every window with every entry."""

import numpy as np
import pyarrow as pa

from retail_marts.llm import bm25_decontam as m, text as T


def _brute(index, words):
    out = []
    for a, b in zip(words.starts[:-1], words.starts[1:]):
        found = {}
        for at in range(a, b, m.STRIPE):
            here = set(words.hash[at:min(b, at + m.WINDOW * m.STRIPE)].tolist())
            near = words.hash[max(a, at - m.ENTRY):min(b, min(b, at + m.WINDOW * m.STRIPE) + m.ENTRY)]
            for e in index.entries:
                score = sum(w for t, w in zip(e["terms"].tolist(), e["w"]) if t in here)
                if score < e["threshold"] - 1e-9:
                    continue
                share = []
                for side in ("question", "answer"):
                    n = index.gram_words(e, side)
                    runs = set(T.shingles(near, np.array([0, near.size]), n)[0].tolist()) if n and near.size >= n else set()
                    share.append(sum(g in runs for g in e[side].tolist()) / len(e[side]) if len(e[side]) else 0.0)
                if max(share) >= m.ONE_PART or min(share) >= m.BOTH_PARTS:
                    found[e["item"]] = max(found.get(e["item"], (0.0, 0.0, 0.0)), (score, *share))
        out.append(found)
    return out


def test_search_equals_scoring_everything():
    rng = np.random.default_rng(5)
    vocab = np.array([f"w{i}" for i in range(120)])
    say = lambda n: " ".join(rng.choice(vocab, n))
    items = [(i, say(int(rng.integers(8, 90))), "") for i in range(30)] + [(30, "one two three", ""), (31, "word", ""), (32, say(9), say(6))]
    found = m.entries(items)
    df = {}
    for e in found:
        for t in e["terms"].tolist():
            df[t] = df.get(t, 0) + 1
    index = m.Index(found, df, len(found), float(np.mean([e["n"] for e in found])))
    texts = [say(int(rng.integers(1, 400))) for _ in range(30)] + ["", None, "word", "one two three", "x one two three y"]
    for i, q, a in items:
        texts.append(" ".join([say(int(rng.integers(0, 150))), q, a, say(int(rng.integers(0, 150)))]))
        half = (q + " " + a).split()
        texts.append(" ".join([say(50), *half[:len(half) // 2], say(20)]))
    words = T.Words(pa.array(texts), T.ALNUM)
    got, want = index.search(words), _brute(index, words)
    assert sum(map(bool, want)) > 30
    for x, y in zip(got, want):
        assert set(x) == set(y)
        assert all(np.allclose(x[i], y[i]) for i in x)


def test_no_quote_of_a_side_is_lost():
    """Every piece of an entry that verifies weighs its threshold or more, whatever words are left out."""
    rng = np.random.default_rng(11)
    vocab = np.array([f"w{i}" for i in range(400)])
    often = 1.0 / np.arange(1, 401)
    say = lambda n: " ".join(rng.choice(vocab, n, p=often / often.sum()))
    found = m.entries([(i, say(int(rng.integers(5, 64))), "") for i in range(120)] + [(200, "a b c d e f g h " * 7, ""), (201, "z " * 40, "")])
    df = {}
    for e in found:
        for t in e["terms"].tolist():
            df[t] = df.get(t, 0) + 1
    index = m.Index(found, df, len(found), float(np.mean([e["n"] for e in found])))
    below = 0
    for e in index.entries:
        weight = dict(zip(e["terms"].tolist(), e["w"].tolist()))
        below += e["threshold"] < m.THRESHOLD
        for side in ("question", "answer"):
            words, n = e["side"][side], index.gram_words(e, side)
            for _ in range(40):  # quotes with words replaced, in one to three places
                quote = words.copy()
                for _ in range(int(rng.integers(0, 4))):
                    a = int(rng.integers(0, quote.size))
                    quote[a:a + int(rng.integers(1, 4))] = 1
                if np.isin(e[side], T.shingles(quote, np.array([0, quote.size]), n)[0]).mean() >= m.ONE_PART:
                    assert sum(w for t, w in weight.items() if t in set(quote.tolist())) >= e["threshold"] - 1e-9
    assert below


def test_lost_weight_equals_brute_force():
    rng = np.random.default_rng(12)
    for _ in range(200):
        size, run = int(rng.integers(1, 11)), int(rng.integers(1, 6))
        run = min(run, size)
        w, runs = rng.random(size), size - run + 1
        cost = rng.integers(0, 2, runs)
        drops = int(rng.integers(0, runs + 1))
        best = 0.0
        for mask in range(1 << runs):
            gone = [i for i in range(runs) if mask >> i & 1]
            if sum(cost[i] for i in gone) <= drops:
                best = max(best, sum(w[p] for p in range(size) if all(i in gone for i in range(max(0, p - run + 1), min(p, runs - 1) + 1))))
        assert np.isclose(m._lost(w, cost, drops, run), best)


def test_a_side_of_seven_words_is_found_whole_only():
    words = [f"v{i}" for i in range(15)]
    found = m.entries([(1, " ".join(words), ""), (2, " ".join(f"x{i}" for i in range(40)), "")])
    df = {t: 1 for e in found for t in e["terms"].tolist()}
    index = m.Index(found, df, len(found), 27.5)
    pad = " ".join(f"p{i}" for i in range(90))
    texts = [" ".join([pad, *q, pad]) for q in (words[8:], words[:8], words[8:14], words[2:7])]
    assert [set(x) for x in index.search(T.Words(pa.array(texts), T.ALNUM))] == [{1}, {1}, set(), set()]
