"""Forms of personal data, links beside other digits, and the permutation itself."""

from pyspark.sql import functions as F

from retail_marts.llm import feistel_pii as m


def _new(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.text for r in m.pseudonymise(rows, "key").orderBy("doc_id").collect()]


def test_forms_are_found_and_keep_their_format(spark):
    values = ["2021-02-28T10:00:00Z", "de89370400440532013000", "de89 3704 0044 0532 0130 00", "4111.1111.1111.1111", "555 123 4567", "020 7946 0958",
              "2021.02.28", "03-04-1999", "28 Feb 2021", "3 September 2021", "2001:db8::1", "2001:DB8:0:0:0:0:0:1", "fe80::1", "fe80:0:0:0:0:0:0:1"]
    got = _new(spark, [f"see {v} there" for v in values] + values)
    n = len(values)
    for v, inside, alone in zip(values, got[:n], got[n:]):
        assert inside == f"see {alone} there" and alone != v, v
    by = dict(zip(values, got[n:]))
    assert by["2021-02-28T10:00:00Z"][10:] == "T10:00:00Z"
    assert by["2021.02.28"].replace(".", "-") == by["2021-02-28T10:00:00Z"][:10]
    assert by["de89 3704 0044 0532 0130 00"].replace(" ", "") == by["de89370400440532013000"]
    assert by["2001:db8::1"] == by["2001:DB8:0:0:0:0:0:1"].lower() and by["fe80::1"] == by["fe80:0:0:0:0:0:0:1"]


def test_what_is_no_value_stays(spark):
    clean = ["std::dec", "12:30:45", "3.14159265358979", "1 555 123 4567", "555 123 4567 8", "32 Feb 2021", "30 Feb 2021", "2021.13.01", "1:2:3:4:5:6:7:8:9",
             "1:2:3:4:5:6:7::8", "xx89370400440532013000", "de8937040044053201300", "in May 2021", "40-40-1999", "2021-02-28Ta", "a::b"]
    assert _new(spark, clean) == clean


def test_what_follows_a_value_keeps_its_link(spark):
    cards = ["4111 1111 1111 1111", "3782 822463 10005", "5555-5555-5555-4444"]
    phone = "+49 170 1234567"
    alone = _new(spark, [*cards, phone])
    beside = [(c, f" {i % 12 + 1:02d}/{i % 100:02d}") for c in cards for i in range(100)] + [(phone, f" {100 + 9 * i} units") for i in range(100)]
    beside += [(cards[0], f"-{i}") for i in range(10)]
    of = dict(zip([*cards, phone], alone))
    assert _new(spark, [v + rest for v, rest in beside]) == [of[v] + rest for v, rest in beside]


def test_feistel_is_a_permutation(spark):
    for size in (1, 2, 3):
        df = spark.range(10 ** size).select(m.permute(F.lpad(F.col("id").cast("string"), size, "0"), "card", "key").alias("p"))
        assert sorted(r.p for r in df.collect()) == [str(i).zfill(size) for i in range(10 ** size)]
    days = spark.range(146097).select(F.date_format(F.date_add(F.lit("1800-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("d"))
    assert days.select(m._date(F.col("d"), "key").alias("p")).distinct().count() == 146097


def test_the_key_decides(spark):
    one = spark.createDataFrame([(1, "4111 1111 1111 1111")], "doc_id long, text string")
    assert m.pseudonymise(one, "a").first().text != m.pseudonymise(one, "b").first().text
    spark.conf.set(m.KEY_SETTING, "own")
    try:
        assert m.session_key(spark) == "own"
    finally:
        spark.conf.unset(m.KEY_SETTING)
    assert m.session_key(spark) == m.TRIAL_KEY
