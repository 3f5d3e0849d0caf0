"""Defined cases and brute-force comparisons of the training-data operators on small tables."""

import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from retail_marts.llm import (bm25_decontam, chat_events, cnn_toxicity, feistel_pii, language_mixture, maxent_lm, poisson_mix, probminhash,
                              pu_quality, va_file)
from retail_marts.llm import text as T

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i * 7919 % 3001}" for i in range(30_000))


def docs(spark, rows, schema=DOCS):
    return spark.createDataFrame([(i, t, "en", "web", len(t or "")) for i, t in rows], schema)


ODD = [(1, None), (2, ""), (3, "... 12 ,"), (None, "a text without any id at all"), (5, LONG), (6, "one"), (7, "same words here"), (7, "same words here")]


# 1 vector search

def brute_top(rows, queries, k):
    ok = {(i, tuple(np.floor(256 * np.array(v, float)).astype(int))) for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    out = set()
    for q in {i for i, _ in ok if queries(i)}:
        qv = min(v for i, v in ok if i == q)
        best = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in ok if i != q)[:k]
        out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(best)}
    return out


def test_top_k_equals_brute_force(spark):
    r = np.random.default_rng(1)
    rows = [(i, [float(x) for x in r.normal(size=6).astype(np.float32)]) for i in range(300)]
    rows += [(1000 + i, rows[50][1]) for i in range(20)]  # ties of one vector
    rows += [(2000, None), (2050, [None] * 6), (2100, [float("nan")] + [0.0] * 5), (None, rows[0][1]), rows[50]]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string")
    got = {tuple(x) for x in va_file.top_k(df, F.col("vec_id") % 50 == 0).collect()}
    assert got == brute_top(rows, lambda i: i % 50 == 0, 5)
    assert va_file.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


# 2 and 8 classifiers

def labelled(spark, n=400):
    r = np.random.default_rng(2)
    base = [f"plain{i}" for i in range(60)]
    text = lambda bad: " ".join(r.choice(base, 40)) + (" idiot fool rubbish !!!! $$$$ ####" * 4 if bad else "")
    d = docs(spark, [(i, text(i % 4 == 0)) for i in range(n)] + [(None, "x"), (n + 1, None), (n + 2, ""), (n + 3, LONG)])
    return d, spark.createDataFrame([(i, int(i % 4 != 0), int(i % 4 == 0)) for i in range(n)], "doc_id long, quality int, toxic int")


def test_toxicity_on_planted_words(spark):
    d, lab = labelled(spark)
    got = {r["doc_id"]: r["score"] for r in cnn_toxicity.score(d, cnn_toxicity.train(d, lab, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)).collect()}
    assert len(got) == 404 and got[401] == 0 and got[402] == 0
    assert np.mean([(got[i] >= 0.5) == (i % 4 == 0) for i in range(400)]) > 0.97
    none = cnn_toxicity.score(d, cnn_toxicity.train(d, lab.limit(0), F.lit(True)))
    assert {r["score"] for r in none.collect()} == {0.0, 0.25}


def test_toxicity_learns_from_every_labelled_row(spark):
    """Each shard holds a part of the rows; vocabulary, steps and thresholds come from all of them."""
    d, lab = labelled(spark)
    model = cnn_toxicity.train(d, lab, F.lit(True), shard=100)
    got = {r["doc_id"]: r["score"] for r in cnn_toxicity.score(d, model).collect()}
    assert np.mean([(got[i] >= 0.5) == (i % 4 == 0) for i in range(400)]) > 0.97


def test_toxicity_counts_words_in_all_rows(spark):
    """Each word is in three of 3,600 rows: half of the words are in three rows that aren't held out (a third, of 2,500 rows a class)."""
    d = docs(spark, [(i, f"word{i // 3} here") for i in range(3600)])
    lab = spark.createDataFrame([(i, 1, int(i % 360 == 0)) for i in range(3600)], "doc_id long, quality int, toxic int")
    model = cnn_toxicity.train(d, lab, F.lit(True), epochs=1)
    first = cnn_toxicity.buckets(T.Words(pa.array([f"word{i}" for i in range(1200)]), T.ALNUM))[:, 0]
    assert (model.rows(first) > 0).mean() > 0.43


def test_quality_on_planted_junk(spark):
    d, lab = labelled(spark, 900)
    model = pu_quality.train(d, lab, F.lit(True))
    got = {r["doc_id"]: r["quality_score"] for r in pu_quality.score(d, model).collect()}
    assert got[901] == 0 and got[902] == 0 and len(got) == 904
    good, bad = ([got[i] for i in range(900) if (i % 4 != 0) == k] for k in (True, False))
    assert min(good) > max(bad) and np.mean(np.array(good) >= 0.5) > 0.97
    assert pu_quality.train(d, lab.limit(0), F.lit(True))["p"] is None


# 3 language

def test_language_mixture(spark):
    r = np.random.default_rng(3)
    words = {"en": ["the", "thing", "whether", "hands"], "de": ["über", "schön", "nicht", "ein"], "fr": ["être", "que", "où", "leçon"]}
    text = lambda *ls: " ".join(r.choice(words[x]) for x in ls for _ in range(60))
    rows = [(i, text(x), x) for i, x in enumerate([*words] * 20)]
    d = spark.createDataFrame(rows + [(100, text("en", "en", "de"), None), (101, None, "fr"), (102, "", "de"), (103, "12 345 ..", None), (104, LONG, None), (100, "être", None)],
                              "doc_id long, text string, lang string")
    langs, logp = language_mixture.train(d, F.col("doc_id") < 60)
    got = language_mixture.predict(d, langs, logp).collect()
    assert langs == ["de", "en", "fr"] and len(got) == d.count()
    by = {r["doc_id"]: r for r in got if r["doc_id"] != 100}
    assert all(by[i]["lang_pred"] == x and len(by[i]["mixture"]) == 1 for i, _, x in rows)
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (101, 102, 103))
    mixed = next(r for r in got if r["doc_id"] == 100 and len(r["mixture"]) > 1)
    assert mixed["lang_pred"] == "en" and 0.55 < mixed["score"] < 0.78
    none = language_mixture.predict(d, *language_mixture.train(d, F.lit(False))).collect()
    assert {r["lang_pred"] for r in none} == {"und"}


# 4 mixing

def test_mixing_counts_and_defined_cases(spark):
    d = spark.createDataFrame([(i, "abcd", "en", "a" if i < 1500 else None, "k") for i in range(2000)] + [(None, None, "en", "z", "k")],
                              "doc_id long, text string, lang string, source string, copy string")
    out = poisson_mix.mix(d, {"a": 1.0, None: 1.0})
    n = {r["source"]: r["count"] for r in out.groupBy("source").count().collect()}
    assert abs(n["a"] - 1000) < 160 and abs(n[None] - 1000) < 160  # equal characters
    assert out.columns == [*d.columns, "copy_"] and sorted(out.collect(), key=str) == sorted(poisson_mix.mix(d.repartition(5), {"a": 1.0, None: 1.0}).collect(), key=str)
    assert poisson_mix.mix(d.limit(0)).count() == 0


# 5 near duplicates

def brute_classes(rows):
    sets = {}
    for i, t in rows:
        w = T.Words(pa.array([t], pa.string()))
        h, _, x = probminhash.weighted_shingles(w)
        sets[i] = (h, x)
    label = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and sets[a][0].size and probminhash.probability_jaccard(*sets[a], *sets[b]) >= 0.8:
                x, y = label[a], label[b]
                label = {k: min(x, y) if v in (x, y) else v for k, v in label.items()}
    return label


def test_near_duplicates_equal_brute_force(spark):
    r = np.random.default_rng(5)
    rows = []
    for g in range(12):
        base = [f"w{x}" for x in r.integers(0, 3000, 120)]
        for c in range(8):
            t = list(base)
            for at in r.integers(0, 120, c % 4):
                t[at] = "changed"
            rows.append((g * 100 + c, " ".join(t)))
    rows += [(5000, None), (5001, ""), (5002, "one two"), (5003, "one two"), (5004, LONG), (5005, LONG + " more")]
    got = {x["doc_id"]: x["class_id"] for x in probminhash.near_duplicates(docs(spark, rows)).collect()}
    assert got == brute_classes(rows)
    odd = probminhash.near_duplicates(docs(spark, ODD)).collect()
    assert len(odd) == len(ODD) and [x["class_id"] for x in odd if x["doc_id"] is None] == [None]
    assert probminhash.near_duplicates(docs(spark, [])).count() == 0


# 6 language model

def test_language_model_counts_and_gain(spark):
    r = np.random.default_rng(6)
    rows = [(i, " ".join(f"A{x} b{x}" for x in r.integers(0, 50, 60))) for i in range(300)] + [(901, None), (902, ""), (903, "never Seen"), (903, LONG), (None, "a1")]
    d = docs(spark, rows).select("doc_id", "text")
    learn = [t.lower().split() + [None] for i, t in rows if i is not None and i < 300]
    counts = maxent_lm.token_counts(d.where("doc_id < 300"))
    v, w = maxent_lm.train(d.where("doc_id < 300"), counts)
    from collections import Counter
    c = Counter(x for t in learn for x in t)
    n, k = sum(c.values()), len(c)
    assert (v.total, v.distinct) == (n, k)
    got = maxent_lm.score(d, counts, v, w).collect()
    assert len(got) == len(rows)
    want = sorted((len(t.lower().split()) + 1, round(sum(np.log10((c[x] + 0.1) / (n + 0.1 * (k + 1))) for x in t.lower().split() + [None]), 4))
                  for t in (t or "" for _, t in rows))
    have = sorted((x["n_tokens"], round(x["base_score"], 4)) for x in got)
    assert np.abs(np.array(have, float) - np.array(want, float)).max() < 1e-2
    own = [x for x in got if x["doc_id"] is not None and x["doc_id"] < 300]
    assert sum(x["score"] for x in own) > 0.9 * sum(x["base_score"] for x in own)  # pairs are learned, from 36,000 tokens
    # the model's probabilities of all next tokens, one unknown among them, sum to one
    h, s = maxent_lm.tokens(pa.array(["a1 b1"]))
    every = np.append(v.hashes, np.uint64(12345))
    total = 0.0
    for x in every:
        one, starts = np.array([h[0], x], np.uint64), np.array([0, 2])
        cnt, _, lp = maxent_lm.score_tokens(v, w, one, starts)
        total += 10 ** (lp[1] + (v.rest(np.array([0.0]))[0] if cnt[1] < 0 else 0.0))
    assert total == pytest.approx(1, abs=1e-3)
    empty = maxent_lm.train(d.limit(0), maxent_lm.token_counts(d.limit(0)))
    assert {x["score"] for x in maxent_lm.score(d, maxent_lm.token_counts(d.limit(0)), *empty).collect()} == {0.0}


def test_language_model_tells_rare_words_apart(spark):
    """Pairs of words outside the frequent classes are learned too; all probabilities sum to one, whatever the parallelism."""
    r = np.random.default_rng(16)
    rows = [(i, " ".join(f"k{x} v{x}" for x in r.integers(0, 1500, 100))) for i in range(600)]
    d = docs(spark, rows).select("doc_id", "text")
    counts = maxent_lm.token_counts(d).cache()
    v, w = maxent_lm.train(d, counts)
    assert v.rest_distinct > 2000 and v.depth == 2
    h, s = maxent_lm.tokens(pa.array([t for _, t in rows]))
    c, number = v.find(h)
    n = np.flatnonzero((number < 0) & (np.arange(h.size) - np.repeat(s[:-1], np.diff(s)) < 200))
    n = n[(n - s[np.searchsorted(s, n, "right") - 1]) % 2 == 1]  # the second words of pairs
    _, base, model = maxent_lm.score_tokens(v, w, h, s)
    assert n.size > 10_000 and model[n].mean() > base[n].mean() + 0.25
    # one unknown token for each leaf
    k1 = np.uint64(v.hashes[0])
    unknown = (np.arange(v.room.size, dtype=np.uint64) << np.uint64(64 - 5 * v.depth)) + np.uint64(7)
    every = np.concatenate([v.hashes, unknown])
    one = np.stack([np.full(every.size, k1), every], 1).ravel()
    cnt, _, lp = maxent_lm.score_tokens(v, w, one, np.arange(0, one.size + 1, 2))
    lp = lp[1::2] + np.where(cnt[1::2] < 0, v.rest(np.zeros(every.size), v.leaf(every)), 0)
    assert (10 ** lp).sum() == pytest.approx(1, abs=1e-3)
    again = maxent_lm.train(d.repartition(3), counts)[1]
    assert all(np.array_equal(x, y) for x, y in zip(w.tables(), again.tables()))


# 7 decontamination

def test_decontamination_catches_planted_items(spark):
    r = np.random.default_rng(7)
    word = lambda n: " ".join(f"t{x}" for x in r.integers(0, 4000, n))
    items = [(i, word(40)) for i in range(30)] + [(99, None), (98, ""), (None, word(30))]
    rows = [(i, word(200)) for i in range(40)] + [(100 + i, f"{word(150)} {t.upper()} {word(300)}") for i, t in items[:30]] + ODD
    bench = spark.createDataFrame(items, "item_id long, text string")
    hits = {x["doc_id"]: [h["item_id"] for h in x["hits"] or []] for x in bm25_decontam.find_leaks(docs(spark, rows), bm25_decontam.build(bench), "hits").collect()}
    assert all(hits[100 + i] == [i] for i in range(30)) and not any(h for d, h in hits.items() if d is None or d < 100)
    assert bm25_decontam.clean_documents(docs(spark, rows), bench).count() == 40 + len(ODD)
    assert bm25_decontam.clean_documents(docs(spark, rows), bench.limit(0)).count() == len(rows)


def test_short_pieces_and_items_leave_clean_documents(spark):
    """A word or short phrase shared with an item is no leak; the item itself is one, whatever its length."""
    r = np.random.default_rng(17)
    word = lambda n: " ".join(f"t{x}" for x in r.integers(0, 4000, n))
    items = [(n, f"{word(n - 1)} common") for n in (64, 65, 66, 70, 130)] + [(n, f"{word(n - 2)} common phrase") for n in (2, 3, 9)] + [(1, "common")]
    half = {i: t.split()[:(len(t.split()) + 1) // 2] for i, t in items}
    clean = [(i, f"{word(100)} common {word(100)} common phrase {word(20)}") for i in range(20)]
    clean += [(30 + k, f"{word(80)} {' '.join(half[9])} {word(80)}") for k in range(2)]  # five words of the item of nine
    leaks = [(100 + i, f"{word(120)} {t} {word(120)}") for i, t in items if i > 3]
    leaks += [(500 + i, f"{word(120)} {' '.join(half[i])} {word(120)}") for i in (64, 65, 66, 70, 130)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {x["doc_id"]: [h["item_id"] for h in x["hits"] or []] for x in bm25_decontam.find_leaks(docs(spark, clean + leaks), bm25_decontam.build(bench), "hits").collect()}
    assert not any(got[i] for i, _ in clean)
    assert all(got[i] == [i - (500 if i >= 500 else 100)] for i, _ in leaks)
    assert {x["doc_id"] for x in bm25_decontam.clean_documents(docs(spark, clean + leaks), bench).collect()} == {i for i, _ in clean}


# 9 personal data

def test_pseudonyms_keep_format_and_links(spark):
    t = "card 4111 1111 1111 1111, on 2021-02-28 or 03/04/1999, call +49 170 1234567, Ann.Lee@mail.org, 10.0.0.255, 078-05-1120; DE89 3704 0044 0532 0130 00"
    bad = "4111 1111 1111 1112 and 2021-02-30 and 300.1.1.1 and 000-12-3456"
    rows = [(1, t), (2, f"again {t}"), (3, bad), (4, None), (5, ""), (6, LONG)]
    got = {r["doc_id"]: r for r in feistel_pii.pseudonymise(docs(spark, rows).withColumn("found", F.lit("x")), "key", count="n").collect()}
    assert got[2]["text"] == "again " + got[1]["text"] and got[1]["n"] >= 7
    same = lambda s: "".join("9" if c.isdigit() else "a" if c.islower() else "A" if c.isupper() else c for c in s)
    no_ip = lambda x: re.sub(r"\d+(\.\d+){3}", "IP", x)
    assert same(no_ip(got[1]["text"])) == same(no_ip(t)) and not any(x in got[1]["text"] for x in ("4111 1111", "2021-02-28", "1234567", "Ann.Lee", "078-05"))
    assert got[3]["text"] == bad and got[4]["text"] is None and got[5]["text"] == "" and got[6]["text"] == LONG


def test_pseudonyms_of_values_beside_other_digits_and_capitals(spark):
    """Each value gets the pseudonym it has alone, and what stands beside it stays."""
    card, amex, iban, austrian, phone = "4111 1111 1111 1111", "378282246310005", "ES91 2100 0418 4502 0005 1332", "AT61 1904 3002 3457 3201", "+1 (555) 123-4567"
    beside = [("", card, " 12/27"), ("", "4111111111111111", " 123 cvv"), ("", iban, " BIC CAIXESBB"), ("", "ES9121000418450200051332", " 2024 paid"),
              ("", austrian, " IS mine"), ("", phone, " 1234 5678"), ("", phone, " 24 times"), ("no 12 ", card, " ok"), ("A1 ", iban, "."), ("7 ", "2021-02-28", " 12")]
    rows = [(i, a + v + b) for i, (a, v, b) in enumerate(beside)] + [(100 + i, v) for i, (_, v, _) in enumerate(beside)]
    rows += [(200, f"{amex} {card} {iban}"), (201, amex), (202, f"\n{card}\n"), (203, "7 " * 3000)]
    got = {r["doc_id"]: r for r in feistel_pii.pseudonymise(docs(spark, rows), "key", count="n").collect()}
    for i, (a, v, b) in enumerate(beside):
        assert got[100 + i]["text"] != v and got[100 + i]["n"] == 1
        assert got[i]["text"] == a + got[100 + i]["text"] + b and got[i]["n"] == 1
    assert got[200]["text"] == " ".join(got[i]["text"] for i in (201, 100, 102)) and got[200]["n"] == 3
    assert got[202]["text"] == f"\n{got[100]['text']}\n"


# 10 chat

def test_chat_events_fold_and_round_trip(spark):
    log = [(1, 1, 1, "delta", "user", "Hi \\h ###"), (1, 2, 2, "delta", "assistant", "Hel"), (1, 3, 2, "delta", "assistant", "lo </turn>"),
           (1, 4, 3, "delta", "user", "dropped"), (1, 5, 2, "regenerate", "assistant", "New"), (1, 6, 2, "delta", "assistant", " text"),
           (1, 7, 1, "edit", "user", "Edited: ### a"), (2, 1, 1, "delta", None, None), (None, 1, 1, "delta", "a:b", "x\ny")]
    e = spark.createDataFrame(log, "conv_id long, seq long, msg long, kind string, role string, text string")
    got = {r["conv_id"]: ([tuple(t) for t in r["turns"]], r["loss_text"]) for r in chat_events.read_back(chat_events.format_chats(e)).collect()}
    assert got == {1: ([("user", "Edited: ### a"), ("assistant", "New text")], "New text"), 2: ([("", "")], ""), None: ([("a:b", "x\ny")], "")}
    assert chat_events.format_chats(e.limit(0)).count() == 0
