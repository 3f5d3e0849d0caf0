"""PII: validated numbers, dates and mail addresses replaced by format-preserving Feistel pseudonyms.

Native: one regular expression finds every place where a candidate can start, also
inside another one. From left to right the admissible prefixes there are validated, the
longest first, what is left is searched again as text, and a keyed Feistel network permutes
the value's symbols inside its own format. All of it is SQL functions over arrays of symbols;
no Python runs on the executors. The same key gives equal values equal pseudonyms in every
document, so links survive.

A prefix ends where a whole group does. An IBAN is tried at its country's length first, a card
number at its issuer's (15, 14 or 16 digits), a phone number at its country's: what follows such a
value doesn't change its pseudonym. Phone numbers of other countries have no length of their own: a
group of digits after one is taken with it as far as 15 digits.

| kind | validated by | permuted | kept |
| --- | --- | --- | --- |
| card number | 13 to 19 digits, Luhn | all digits but the last | separators; the check digit is made anew |
| IBAN | remainder modulo 97; in small letters the country's length too | account part, letters as letters | country, spaces, case; check digits made anew |
| phone | 10 to 15 digits; without + in groups of 3-3-4 or after a leading 0, alone among digits | digits after the country code | country code, separators |
| social security number | area, group, serial not void | all digits | hyphens |
| IPv4 address | octets up to 255 | the four octets | dots |
| IPv6 address | eight groups, or fewer with `::` after one that holds a digit | the eight groups | case; written without `::` |
| date 1800 to 2199 | calendar; digits, or an English month's name between them | the day's number in the 400 years | order, separators, zero padding, a time after T |
| mail address | address syntax | local part, letters as letters | case, dots, domain |

Feistel: symbols s_i with radix r_i are cut into halves that take turns; in each
of 10 rounds one half is shifted by SHA-512(key, kind, round, other half), symbol by
symbol modulo its radix. Shifts can be undone, so it is a permutation of the
values of one format. A date is its day number as two symbols of radix 189 and
773 (189 * 773 = 146097 days in 400 years, whatever year they start).

What fails validation stays as it is. Defined cases: a null text stays null, an
empty one empty; values are compared without separators and case; d/m/y is read
before m/d/y where both are valid; other columns stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_marts.llm.common import free_name, table

ROUNDS = 10
#: Session setting with the key of the registered query and the pipeline.
KEY_SETTING = "spark.retail_marts.pii.key"
#: Their key where it is unset, for trials: anyone who reads this can undo it.
TRIAL_KEY = "change-me"

MAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}"
DATE = r"\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{4}\.\d{2}\.\d{2}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}/\d{1,2}/\d{4}|\d{2}-\d{2}-\d{4}"
MONTHS = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()
MONTH = (r"(?:Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|June?|July?|Aug(?:ust)?|Sep(?:tember)?"
         r"|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?)")
DATE_NAMED = rf"\d{{1,2}} {MONTH} \d{{4}}"
IPV4 = r"\d{1,3}(?:\.\d{1,3}){3}"
HEX = "[0-9A-Fa-f]{1,4}"
IPV6 = rf"(?<!:)(?:(?:{HEX}:){{7}}{HEX}|(?=[A-Fa-f]{{0,3}}[0-9])(?:{HEX}:){{1,6}}(?::{HEX}){{1,6}})(?!:)"
PHONE = (r"\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}"
         r"|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4}")
#: National numbers, only where no other group of digits stands beside them.
NATIONAL = r"(?<!\d )(?:[2-9]\d{2} \d{3} \d{4}|0\d{2,4} \d{3,4} \d{3,4})(?! \d)"
#: Digits of a phone number with its country code, likeliest first.
PHONE_DIGITS = {(11,): "1 7 27 30 31 33 34 36 41 46 48 60 61 66", (12,): "20 40 44 52 57 62 63 82 90 91 92 351 380 420", (10, 11): "32 45 47 64 65",
                (12, 11, 13): "39 43 49 353 358", (12, 11): "81 54", (13, 12): "55 86"}
CARD = r"\d(?:[ -]?\d){12,18}"
CARD_DOTS = r"\d{4}(?:\.\d{4}){3}|\d{4}\.\d{6}\.\d{5}"
#: A card number may have a hyphen and one or two digits after it.
CARD_END = r"(?![A-Za-z0-9]|\.\d|-\d{3})"
SSN = r"\d{3}-\d{2}-\d{4}"
IBAN = r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"
IBAN_SMALL = r"[a-z]{2}\d{2}(?: ?[a-z0-9]{4}){2,7}(?: ?[a-z0-9]{1,3})?"
END = r"(?![A-SU-Za-z0-9]|T(?!\d{2}:\d{2})|[.-]\d)"
#: Where a candidate starts; no character is consumed, so starts inside a candidate are found too. Its first characters are looked at first.
START = rf"(?={MAIL}|(?=[+(]|[A-Fa-f]{{0,3}}[0-9]|[A-Za-z]{{2}}[0-9]{{2}})(?<![A-Za-z0-9]|\d\.)(?:{DATE}|{DATE_NAMED}|{IPV4}|{IPV6}|{PHONE}|{NATIONAL}|{CARD}|{CARD_DOTS}|{SSN}|{IBAN}|{IBAN_SMALL}){END})"
#: White space that no candidate holds, before a word with a digit or @: candidates hold single blanks between [A-Z0-9)] or a month and [A-Z0-9(].
BREAK = rf"(?=[\t\n\x0B\f\r][^\s0-9@]*+[0-9@])|(?= (?=[^\s0-9@]*+[0-9@])(?:(?![A-Z0-9(])|(?<!(?:[A-Z0-9)]|{MONTH}) )))"
#: No candidate is longer (a mail address: 64 + 1 + 8 * 64 + 24), one more character shows its end.
REACH = 640
#: Length of an IBAN by country; others are tried at every length.
IBAN_LENGTH = {land: n for n, lands in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU"}.items() for land in lands.split()}
FOUND = "struct<size:int,new:string>"


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.transform(F.array(value), use)[0]


def feistel(syms: Column, radix: Column, kind: str, key: str) -> Column:
    """Keyed permutation of an int array within the radix of each place."""
    h = F.expr("0") + F.floor(F.size(syms) / 2).cast("int")
    rest = F.size(syms) - h

    def shift(half: Column, own: Column, other: Column, r: Column) -> Column:
        digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), r.cast("string"), F.size(half).cast("string"),
                                    F.array_join(other.cast("array<string>"), ",")), 512)
        return _let(digest, lambda d: F.transform(half, lambda x, i: F.pmod(
            x + F.conv(F.substring(d, F.pmod(i, F.lit(32)) * 4 + 1, F.lit(4)), 16, 10).cast("int"), F.get(own, i))))

    def step(s: Column, r: Column) -> Column:
        odd = r % 2 == 1
        left, right = F.slice(radix, F.lit(1), h), F.slice(radix, h + 1, rest)
        return F.struct(F.when(odd, shift(s["l"], left, s["r"], r)).otherwise(s["l"]).alias("l"),
                        F.when(odd, s["r"]).otherwise(shift(s["r"], right, s["l"], r)).alias("r"))

    start = F.struct(F.slice(syms, F.lit(1), h).alias("l"), F.slice(syms, h + 1, rest).alias("r"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda s: F.concat(s["l"], s["r"]))


def _digit(c: Column) -> Column:
    return c.rlike("[0-9]")


def permute(payload: Column, kind: str, key: str) -> Column:
    """Pseudonym of a string of [a-z0-9]: digits stay digits, letters letters."""
    chars = F.split(payload, "")
    syms = F.transform(chars, lambda c: F.when(_digit(c), F.ascii(c) - 48).otherwise(F.ascii(c) - 97))
    radix = F.transform(chars, lambda c: F.when(_digit(c), F.lit(10)).otherwise(F.lit(26)))
    return F.array_join(F.zip_with(feistel(syms, radix, kind, key), radix, lambda x, r: F.when(
        r == 10, x.cast("string")).otherwise(F.char(x + 97))), "")


def _bare(s: Column) -> Column:
    return F.lower(F.regexp_replace(s, "[^A-Za-z0-9]", ""))


def fill(form: Column, payload: Column) -> Column:
    """``payload`` put in the places of the letters and digits of ``form``, in the same case."""
    def place(c: Column, i: Column) -> Column:
        at = F.length(F.regexp_replace(F.substring(form, F.lit(1), i), "[^A-Za-z0-9]", "")) + 1
        q = F.substring(payload, at, F.lit(1))
        return F.when(c.rlike("[A-Z]"), F.upper(q)).when(c.rlike("[a-z0-9]"), q).otherwise(c)

    return F.array_join(F.transform(F.split(form, ""), place), "")


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of a digit string, the last digit undoubled."""
    n = F.length(digits)
    return F.aggregate(
        F.transform(F.split(digits, ""), lambda c, i: F.when((n - i) % 2 == 1, c.cast("int")).otherwise(
            c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0))),
        F.lit(0), lambda a, x: a + x)


def mod97(s: Column) -> Column:
    """Remainder modulo 97 of a string of [a-z0-9] read as the IBAN rule reads it."""
    return F.aggregate(F.split(s, ""), F.lit(0), lambda a, c: F.when(_digit(c), (a * 10 + F.ascii(c) - 48) % 97).otherwise(
        (a * 100 + F.ascii(c) - 87) % 97))


def _card(m: Column, key: str) -> Column:
    def new(d: Column) -> Column:
        body = permute(F.substring(d, F.lit(1), F.length(d) - 1), "card", key)
        return _let(body, lambda p: fill(m, F.concat(p, F.pmod(10 - luhn_sum(F.concat(p, F.lit("0"))) % 10, F.lit(10)).cast("string"))))

    return _let(_bare(m), lambda d: F.when(luhn_sum(d) % 10 == 0, new(d)))


def _iban(m: Column, key: str) -> Column:
    def new(b: Column) -> Column:
        land = F.substring(b, 1, 2)
        return _let(permute(F.substring(b, F.lit(5), F.length(b) - 4), "iban", key), lambda p: fill(m, F.concat(
            land, F.lpad((98 - mod97(F.concat(p, land, F.lit("00")))).cast("string"), 2, "0"), p)))

    ok = lambda b: mod97(F.concat(F.substring(b, F.lit(5), F.length(b) - 4), F.substring(b, 1, 4))) == 1
    return _let(_bare(m), lambda b: F.when(ok(b), new(b)))


def _phone(m: Column, key: str) -> Column:
    code = F.regexp_extract(m, r"^\+(?:\d{1,3}(?=[ .(-])|\d{2})", 0)
    rest = F.substring(m, F.length(code) + 1, F.length(m))
    n = F.length(_bare(m))
    return F.when((n >= 10) & (n <= 15), F.concat(code, _let(rest, lambda r: fill(r, permute(_bare(r), "phone", key)))))


def _ssn(m: Column, key: str) -> Column:
    void = m.rlike(r"^(000|666|9..)|^...-00|-0000$")
    return F.when(~void, fill(m, permute(_bare(m), "ssn", key)))


def _ipv4(m: Column, key: str) -> Column:
    parts = F.transform(F.split(m, r"\."), lambda x: x.cast("int"))
    new = F.array_join(feistel(parts, F.array_repeat(F.lit(256), 4), "ipv4", key).cast("array<string>"), ".")
    return F.when(F.forall(parts, lambda x: x < 256), new)


def _ipv6(m: Column, key: str) -> Column:
    short = m.contains("::")
    left, right = F.split(F.substring_index(m, "::", 1), ":"), F.split(F.substring_index(m, "::", -1), ":")
    zeros = F.array_repeat(F.lit("0"), F.lit(8) - F.size(left) - F.size(right))
    groups = F.when(short, F.concat(left, zeros, right)).otherwise(F.split(m, ":"))
    given = F.size(F.split(m, ":+"))

    def new(g: Column) -> Column:
        code = feistel(F.transform(g, lambda x: F.conv(x, 16, 10).cast("int")), F.array_repeat(F.lit(65536), 8), "ipv6", key)
        out = F.array_join(F.transform(code, lambda x: F.hex(x)), ":")
        return F.when(m.rlike("[A-F]"), out).otherwise(F.lower(out))

    return F.when((short & (given < 8)) | (~short & (given == 8)), _let(groups, new))


def _is_day(y: Column, mo: Column, d: Column) -> Column:
    last = F.when(mo.isin(4, 6, 9, 11), 30).when(mo != 2, 31).when(
        (y % 4 == 0) & ((y % 100 != 0) | (y % 400 == 0)), 29).otherwise(28)
    return y.between(1800, 2199) & mo.between(1, 12) & (d >= 1) & (d <= last)


def _new_day(y: Column, mo: Column, d: Column, key: str, form) -> Column:
    """``form`` of the pseudonym of a valid day."""
    start = F.lit("1800-01-01").cast("date")
    day = F.date_diff(F.make_date(y, mo, d), start)
    code = feistel(F.array(F.floor(day / 773).cast("int"), (day % 773).cast("int")),
                   F.array(F.lit(189), F.lit(773)), "date", key)
    return _let(code, lambda c: _let(F.date_add(start, F.get(c, F.lit(0)) * 773 + F.get(c, F.lit(1))), form))


def _two(x: Column, padded: Column) -> Column:
    return F.when(padded, F.lpad(x.cast("string"), 2, "0")).otherwise(x.cast("string"))


def _date(m: Column, key: str) -> Column:
    a, b, c = (F.regexp_extract(m, r"^(\d+)\D(\d+)\D(\d+)$", i).cast("int") for i in (1, 2, 3))
    mark = F.regexp_extract(m, r"^\d+(\D)", 1)
    padded = F.length(m) == 10
    ymd = lambda t: F.concat(F.year(t).cast("string"), mark, _two(F.month(t), padded), mark, _two(F.day(t), padded))
    dmy = lambda t: F.concat(_two(F.day(t), padded), mark, _two(F.month(t), padded), mark, F.year(t).cast("string"))
    mdy = lambda t: F.concat(_two(F.month(t), padded), mark, _two(F.day(t), padded), mark, F.year(t).cast("string"))
    return (F.when(a > 31, F.when(_is_day(a, b, c), _new_day(a, b, c, key, ymd)))
            .when(_is_day(c, b, a), _new_day(c, b, a, key, dmy))
            .when(mark.isin("/", "-") & _is_day(c, a, b), _new_day(c, a, b, key, mdy)))


def _date_named(m: Column, key: str) -> Column:
    day, name, year = (F.regexp_extract(m, r"^(\d+) (\w+) (\d+)$", i) for i in (1, 2, 3))
    y, d = year.cast("int"), day.cast("int")
    mo = F.array_position(F.array(*map(F.lit, MONTHS)), F.substring(name, 1, 3)).cast("int")
    form = lambda t: F.concat(_two(F.day(t), F.length(day) == 2), F.lit(" "), F.when(F.length(name) == 3, F.date_format(t, "MMM")).otherwise(
        F.date_format(t, "MMMM")), F.lit(" "), F.year(t).cast("string"))
    return F.when(_is_day(y, mo, d), _new_day(y, mo, d, key, form))


def _mail(m: Column, key: str) -> Column:
    local = F.substring_index(m, "@", 1)
    return F.when(local.rlike("[A-Za-z0-9]"), F.concat(
        _let(local, lambda x: fill(x, permute(_bare(x), "mail", key))), F.substring(m, F.length(local) + 1, F.length(m))))


def _valid(m: Column, new) -> Column:
    """Length and pseudonym of ``m``, null where it is empty or fails validation."""
    return _let(m, lambda m: _let(F.when(m != "", new(m)), lambda q: F.when(q.isNotNull(), F.struct(
        F.length(m).cast("int").alias("size"), q.alias("new")))))


def _longest(w: Column, kind: str, first: str, more: str, sizes: Column, new, end: str = END) -> Column:
    """The first of ``sizes`` (letters and digits) at which the start of ``w`` is of the kind and valid."""
    def prefix(n: Column) -> Column:
        form = F.concat(F.lit(f"^{first}(?:{more}){{"), (n - 1).cast("string"), F.lit("}" + end))
        m = F.call_function("regexp_extract", w, form, F.lit(0))
        return _let(m, lambda m: F.when(m.rlike(f"^(?:{kind})$"), m).otherwise(""))

    return F.aggregate(sizes, F.lit(None).cast(FOUND), lambda had, n: F.coalesce(had, _valid(prefix(n), new)))


def pseudonym(w: Column, key: str) -> Column:
    """Length and pseudonym of the value at the start of ``w``, null where there is none."""
    one = lambda p, new: _valid(F.regexp_extract(w, f"^(?:{p}){END}", 0), lambda m: new(m, key))
    down = lambda own, top, least: F.concat(own, F.sequence(F.lit(top), F.lit(least), F.lit(-1)))
    land = F.element_at(F.create_map(*(F.lit(x) for pair in IBAN_LENGTH.items() for x in pair)), F.upper(F.substring(w, 1, 2)))
    none = F.array().cast("array<int>")
    digits = F.coalesce(*(F.when(w.rlike(rf"^\+(?:{'|'.join(codes.split())})"), F.array(*map(F.lit, n))) for n, codes in PHONE_DIGITS.items()), none)
    issuer = F.when(w.rlike("^3[47]"), 15).when(w.rlike("^3[068]"), 14).otherwise(16)
    return F.coalesce(
        _valid(F.regexp_extract(w, f"^{MAIL}", 0), lambda m: _mail(m, key)), one(DATE, _date), one(DATE_NAMED, _date_named),
        one(IPV4, _ipv4), one(IPV6, _ipv6), one(NATIONAL, _phone),
        F.when(w.rlike(f"^(?:{PHONE})"), _longest(w, PHONE, r"[+(]?\d", r"[ .()-]{0,2}\d", down(digits, 15, 10), lambda m: _phone(m, key))),
        one(SSN, _ssn), one(CARD_DOTS, _card),
        F.when(w.rlike(f"^{CARD}"), _longest(w, CARD, r"\d", r"[ -]?\d", down(F.array(issuer), 19, 13), lambda m: _card(m, key), CARD_END)),
        F.when(w.rlike(f"^{IBAN}"), _longest(w, IBAN, "[A-Z]", " ?[A-Z0-9]", down(F.when(land.isNull(), none).otherwise(F.array(land)), 35, 12), lambda m: _iban(m, key))),
        F.when(land.isNotNull() & w.rlike(f"^{IBAN_SMALL}"), _longest(w, IBAN_SMALL, "[a-z]", " ?[a-z0-9]", F.array(land), lambda m: _iban(m, key))))


def _scan(run: Column, key: str) -> Column:
    """Text of ``run`` with pseudonyms, and the number of values replaced. ``run`` starts with white space."""
    def step(s: Column, part: Column) -> Column:
        ahead = F.substring(run, s["at"] + 1, F.lit(REACH))
        hit = F.when((s["at"] > 0) & (s["at"] >= s["upto"]), _let(ahead, lambda w: pseudonym(w, key)))
        rest = lambda n: F.substring(part, F.greatest(n, F.lit(0)) + 1, F.length(part))
        return _let(hit, lambda h: F.struct(
            (s["at"] + F.length(part)).cast("int").alias("at"), F.coalesce(s["at"] + h["size"], s["upto"]).cast("int").alias("upto"),
            F.concat(s["text"], F.coalesce(h["new"], F.lit("")), rest(F.coalesce(h["size"], s["upto"] - s["at"]))).alias("text"),
            (s["n"] + F.coalesce((h["new"] != F.substring(run, s["at"] + 1, h["size"])).cast("int"), F.lit(0))).cast("int").alias("n")))

    zero = F.struct(F.lit(0).alias("at"), F.lit(0).alias("upto"), F.lit("").alias("text"), F.lit(0).alias("n"))
    return F.aggregate(F.split(run, START, -1), zero, step, lambda s: F.struct(s["text"].alias("text"), s["n"].alias("n")))


def session_key(spark: SparkSession) -> str:
    """The key in the session's setting, the trial key where it is unset."""
    return spark.conf.get(KEY_SETTING, TRIAL_KEY)


def pseudonymise(docs: DataFrame, key: str, text: str = "text", count: str | None = None) -> DataFrame:
    """The columns of ``docs`` with pseudonyms in ``text``; ``count`` names a column for the number of values replaced."""
    new = free_name(docs, "new")
    t = F.col(text)
    plain = lambda r: F.struct(r.alias("text"), F.lit(0).alias("n"))
    runs = F.split(F.concat(F.lit("\n"), t), BREAK, -1)  # the line break is taken away again
    df = docs.withColumn(new, F.when(t.rlike("[0-9@]"), F.transform(
        runs, lambda r: F.when(r.rlike(START), _scan(r, key)).otherwise(plain(r)))))
    whole = F.array_join(F.transform(F.col(new), lambda x: x["text"]), "")
    df = df.withColumn(text, F.when(F.col(new).isNotNull(), F.substring(whole, F.lit(2), F.length(whole))).otherwise(t))
    if count:
        df = df.withColumn(count, F.coalesce(F.aggregate(F.col(new), F.lit(0), lambda a, x: a + x["n"]), F.lit(0)))
    return df.drop(new)


def op9_feistel_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: doc_id, text with pseudonyms, n_replaced."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return pseudonymise(docs, session_key(spark), count="n_replaced")
