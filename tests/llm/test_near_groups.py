"""Large groups of near copies that stay just below the threshold."""

import numpy as np

from retail_marts.llm import probminhash


def test_a_group_of_near_copies_below_the_threshold_makes_few_pairs(spark, monkeypatch):
    """Texts made from one by changing runs of words: similarity of most pairs about 0.7, of some 0.8 or more."""
    r = np.random.default_rng(21)
    base, rows = [f"b{i}" for i in range(150)], []
    for i in range(260):
        words = list(base)
        for k in range(3):  # a replacement that a few others have too, so that it is in no way unique
            at = int(r.integers(0, 30)) * 5
            words[at] = f"x{at}_{int(r.integers(0, 3))}"
        rows.append((i, " ".join(words)))
    asked = []
    plain = probminhash._rare_pairs
    monkeypatch.setattr(probminhash, "_rare_pairs", lambda w, o, t, s: asked.append((out := s.put(plain(w, o, t, s), "asked")).count()) or out)
    got = {x.doc_id: x.class_id for x in probminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(asked) <= 6 * len(rows), asked
    # brute force over all pairs
    bags = []
    for _, text in rows:
        w = text.split()
        bags.append(sorted({tuple(w[i:i + 5]) for i in range(len(w) - 4)}))
    sets, parent = [set(b) for b in bags], list(range(len(rows)))
    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both / (len(sets[i]) + len(sets[j]) - both) >= 0.8:
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    assert got == {i: root(i) for i in range(len(rows))}
