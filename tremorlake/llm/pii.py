"""PII: format-preserving pseudonyms by a keyed Feistel network.

Numbers and dates are found by pattern, validated, and replaced by a keyed
permutation within their own format.  Equal values get equal pseudonyms in all
documents, and two values never share one:

* card: 13 to 19 digits that pass the Luhn check; first digit and separators stay, the check digit is made anew
* phone: 8 to 15 digits after a plus sign in any grouping, or area code and seven digits; the number's digits are permuted, signs and country code stay, so one number has one pseudonym in all spellings
* ssn: 3-2-4 digits with hyphens, no zero group, area not 666 or 9xx; stays valid
* ip: four numbers up to 255; the address is permuted as two 16-bit halves
* date: real calendar days YYYY-MM-DD from 1700 to 2099, permuted as 189 x 773 days (400 years)
* email: not a number, so no permutation: the local part becomes a keyed 16-digit hexadecimal name at example.invalid

Numbers beside each other look like one: of a run of numbers parted by single
blanks or hyphens, every part of whole numbers with 13 to 19 digits is held
against the Luhn check.  The leftmost part that passes is the card, and of parts
that overlap the one with more digits.  What is left of the run is searched for
dates, ssn and phones.

Everything is one pass over each row: nothing is shuffled, so no value can be
hot.  The Feistel rounds are a fold over a fixed list, so the expression does
not grow with them.

Defined results: null texts stay null with no findings; empty texts stay empty.
Rows that are repeated are treated alike.  Candidates that fail validation stay
as they are.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremorlake.llm.common import whole_text

KEY = "change-me"
ROUNDS = 10
KINDS = ["email", "ip", "date", "ssn", "phone", "card"]

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
IP = r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d]|\.\d)"
DATE = r"(?<!\d)\d{4}-\d{2}-\d{2}(?!\d)"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
#: After the plus sign any grouping, but no card's groups and no half of a following date.
PHONE = (r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}(?![\d-])|(?<![\w+])\+\d{8,15}(?!\d)"
         r"|(?<![\w+])\+\d(?:(?![ .-]\d{4}[ -](?:\d{4}[ -]\d{4}|\d{6}[ -]\d{4,5}))[ .()-]{0,2}\d){7,14}(?!-?\d)")
CARD = r"(?<!\d)\d(?:[ -]?\d){12,18}(?!\d)"
#: The calling codes of one and two digits; all others have three.
CALLING_CODE = r"^(?:1|7|20|27|30|31|32|33|34|36|39|40|41|43|44|45|46|47|48|49|51|52|53|54|55|56|57|58|60|61|62|63|64|65|66|81|82|84|86|90|91|92|93|94|95|98|\d{3})"
#: 13 digits or more with single blanks and hyphens, up to where an address or a phone with other signs begins.
NUMBERS = rf"(?<!\d)\d(?:(?![ -](?:{EMAIL}|\d{{1,3}}(?:\.\d{{1,3}}){{3}}|\d{{3}}(?:\.\d{{3}}[ .-]|[ -]\d{{3}}\.)\d{{4}}))[ -]?\d){{12,}}+"
PATTERN = "|".join((EMAIL, IP, DATE, SSN, PHONE, NUMBERS))
#: What may stand beside cards in a run of numbers; the cards are masked.
BESIDE = "|".join(("#+", DATE, SSN, PHONE))
_FULL = [f"^(?:{p})$" for p in (EMAIL, IP, DATE, SSN, PHONE, CARD)]
#: 1700-01-01; 400 Gregorian years have 146,097 = 189 x 773 days.
FIRST_DAY, DAYS_A, DAYS_B = "1700-01-01", 189, 773


def feistel(left: Column, right: Column, a: Column, b: Column, tweak: Column, key: str = KEY, rounds: int = ROUNDS) -> Column:
    """Keyed permutation of pairs (left < a, right < b): a struct (l, r).

    Even rounds add a keyed hash of the right part to the left one modulo a;
    odd rounds the other way round.  Each round can be undone, so it is one to one.
    """
    def mixed(r, part):
        digest = F.sha2(F.concat_ws("|", F.lit(key), tweak, r, part), 256)
        return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")

    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"), a.cast("long").alias("a"), b.cast("long").alias("b"))

    def step(s, i):
        even = i % 2 == 0
        return F.struct(F.when(even, (s["l"] + mixed(i, s["r"])) % s["a"]).otherwise(s["l"]).alias("l"),
                        F.when(even, s["r"]).otherwise((s["r"] + mixed(i, s["l"])) % s["b"]).alias("r"),
                        s["a"].alias("a"), s["b"].alias("b"))

    return F.aggregate(F.array(*[F.lit(i) for i in range(rounds)]), start, step)


def _bind(value: Column, body) -> Column:
    """body(value) with the value worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def permute_digits(digits: Column, tweak: Column, key: str = KEY) -> Column:
    """Keyed permutation of the digit strings of each length from 2 to 36; others stay."""
    def body(d):
        k = F.floor(F.length(d) / 2).cast("int")
        m = F.length(d) - k
        ten = lambda n: F.pow(F.lit(10), n).cast("long")
        moved = feistel(F.substring(d, F.lit(1), k).cast("long"), F.substring(d, k + 1, m).cast("long"),
                        ten(k), ten(m), F.concat_ws("/", tweak, F.length(d)), key)
        return _bind(moved, lambda x: F.concat(F.lpad(x["l"].cast("string"), k, "0"), F.lpad(x["r"].cast("string"), m, "0")))
    return F.when(F.length(digits).between(2, 36), _bind(digits, body)).otherwise(digits)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn_sum(payload: Column) -> Column:
    """Luhn sum of the digits left of the check digit."""
    back = F.reverse(F.split(payload, ""))
    def add(acc, d):
        x = d.cast("int") * F.when(acc["i"] % 2 == 0, 2).otherwise(1)
        return F.struct((acc["i"] + 1).alias("i"), (acc["s"] + F.when(x > 9, x - 9).otherwise(x)).alias("s"))
    return F.aggregate(back, F.struct(F.lit(0).alias("i"), F.lit(0).alias("s")), add, lambda acc: acc["s"])


def _check_digit(payload: Column) -> Column:
    return ((10 - _luhn_sum(payload) % 10) % 10).cast("string")


def _refill(m: Column, digits: Column) -> Column:
    """The match with its digits, in order, replaced by ``digits``; all other characters stay."""
    def put(acc, ch):
        is_digit = ch.rlike("[0-9]")
        return F.struct((acc["i"] + F.when(is_digit, 1).otherwise(0)).alias("i"),
                        F.concat(acc["o"], F.when(is_digit, F.substring(acc["d"], acc["i"], F.lit(1))).otherwise(ch)).alias("o"),
                        acc["d"].alias("d"))
    return F.aggregate(F.split(m, ""), F.struct(F.lit(1).alias("i"), F.lit("").alias("o"), digits.alias("d")), put, lambda acc: acc["o"])


def kind_of(m: Column) -> Column:
    """Place in KINDS of the first kind whose pattern and validation the match passes; null if none."""
    d = _digits(m)
    octets = F.forall(F.split(m, r"\."), lambda x: (x.try_cast("int") <= 255) & ((F.length(x) == 1) | ~x.startswith("0")))
    day = m.try_cast("date").isNotNull() & m.between("1700-01-01", "2099-12-31")
    ssn = ~m.substr(1, 3).isin("000", "666") & ~m.startswith("9") & (m.substr(5, 2) != "00") & (m.substr(8, 4) != "0000")
    card = _is_card(d)
    tests = [F.lit(True), octets, day, ssn, F.lit(True), card]
    return F.coalesce(*[F.when(m.rlike(p) & t, F.lit(i)) for i, (p, t) in enumerate(zip(_FULL, tests, strict=True))])


def pseudonym(m: Column, kind: Column, key: str = KEY) -> Column:
    """The keyed pseudonym of a validated match, in the match's own format."""
    email = F.concat(F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(m)), 256), 1, 16), F.lit("@example.invalid"))
    part = lambda i: F.element_at(F.split(m, r"\."), i).cast("int")
    two16 = F.lit(65536)
    ip = _bind(feistel(part(1) * 256 + part(2), part(3) * 256 + part(4), two16, two16, F.lit("ip"), key), lambda x: F.concat_ws(
        ".", F.floor(x["l"] / 256), x["l"] % 256, F.floor(x["r"] / 256), x["r"] % 256))
    n = F.datediff(m.try_cast("date"), F.lit(FIRST_DAY).cast("date"))
    date = _bind(feistel(F.floor(n / DAYS_B), n % DAYS_B, F.lit(DAYS_A), F.lit(DAYS_B), F.lit("date"), key), lambda x: F.date_format(
        F.date_add(F.lit(FIRST_DAY).cast("date"), (x["l"] * DAYS_B + x["r"]).cast("int")), "yyyy-MM-dd"))
    # Areas 1-665 and 667-899 as 898 numbers, groups 1-99 and serials 1-9999 as 99 x 9999 numbers.
    area = m.substr(1, 3).cast("int")
    ssn = _bind(feistel(F.when(area > 666, area - 2).otherwise(area - 1), (m.substr(5, 2).cast("int") - 1) * 9999 + m.substr(8, 4).cast("int") - 1,
                        F.lit(898), F.lit(99 * 9999), F.lit("ssn"), key), lambda x: F.concat_ws(
        "-", F.lpad(F.when(x["l"] >= 665, x["l"] + 2).otherwise(x["l"] + 1).cast("string"), 3, "0"),
        F.lpad((F.floor(x["r"] / 9999) + 1).cast("string"), 2, "0"), F.lpad((x["r"] % 9999 + 1).cast("string"), 4, "0")))
    # The country code is a part of the format; the number is permuted by its digits alone, however they are written.
    code = F.when(m.startswith("+"), F.regexp_extract(_digits(m), CALLING_CODE, 0)).otherwise(F.lit(""))
    trunk = F.when(m.rlike(r"^\+\d{1,3}[ .-]?\(0\)"), F.lit("0")).otherwise(F.lit(""))
    split = F.struct(F.concat(code, trunk).alias("lead"), _digits(m).alias("all"))
    phone = _refill(m, _bind(split, lambda x: F.concat(x["lead"], permute_digits(
        F.substring(x["all"], F.length(x["lead"]) + 1, F.length(x["all"])), F.lit("phone"), key))))
    payload = _bind(_digits(m), lambda d: F.concat(F.substring(d, 1, 1), permute_digits(
        F.substring(d, F.lit(2), F.length(d) - 2), F.concat(F.lit("card"), F.substring(d, 1, 1)), key)))
    card = _refill(m, _bind(payload, lambda p: F.concat(p, _check_digit(p))))
    out = m
    for i, x in enumerate([email, ip, date, ssn, phone, card]):
        out = F.when(kind == i, x).otherwise(out)
    return out


def _is_card(d: Column) -> Column:
    """Whether the digits are those of a card."""
    return F.length(d).between(13, 19) & ~d.startswith("0") & (
        F.substring(d, F.length(d), F.lit(1)) == _check_digit(F.substring(d, F.lit(1), F.length(d) - 1)))


def cards(run: Column) -> Column:
    """(start, size) in characters of the cards in a run of numbers that single blanks or hyphens part."""
    def searched(number):
        def longest(_, i):
            ends = F.transform(F.sequence(F.lit(1), F.least(F.lit(19), F.size(number) - i)), lambda n: F.struct(
                n.alias("n"), F.array_join(F.slice(number, i + 1, n), "").alias("d")))
            good = F.filter(ends, lambda x: _is_card(x["d"]))
            return F.coalesce(F.try_element_at(good, F.lit(-1)), F.struct(F.lit(0).alias("n"), F.lit("").alias("d")))

        def pick(best):
            def step(acc, number_at):
                i = acc["i"]
                own = F.get(best, i)
                width = F.length(number_at)
                # A longer part that begins inside this one is the card.
                more = F.exists(F.slice(best, i + 2, F.greatest(own["n"] - 1, F.lit(0))), lambda x: F.length(x["d"]) > F.length(own["d"]))
                takes = (i >= acc["next"]) & (own["n"] > 0) & ~more
                one = F.array(F.struct(acc["at"].alias("start"), (F.length(own["d"]) + own["n"] - 1).alias("size")))
                return F.struct((i + 1).alias("i"), (acc["at"] + width + 1).alias("at"), F.when(takes, i + own["n"]).otherwise(acc["next"]).alias("next"),
                                F.when(takes, F.concat(acc["out"], one)).otherwise(acc["out"]).alias("out"))
            none = F.array().cast("array<struct<start:int,size:int>>")
            return F.aggregate(number, F.struct(F.lit(0).alias("i"), F.lit(0).alias("at"), F.lit(0).alias("next"), none.alias("out")), step, lambda acc: acc["out"])

        return _bind(F.transform(number, longest), pick)

    return _bind(F.split(run, "[ -]"), searched)


def _inside(before: Column, run: Column) -> Column:
    """The run as (gap, hit) parts: its cards, and dates, ssn and phones beside them; ``before`` is the character ahead."""
    def masked(found):
        mask = F.aggregate(found, F.struct(F.lit(0).alias("at"), F.lit("").alias("o")), lambda acc, c: F.struct(
            (c["start"] + c["size"]).alias("at"),
            F.concat(acc["o"], F.substring(run, acc["at"] + 1, c["start"] - acc["at"]), F.repeat(F.lit("#"), c["size"])).alias("o")),
            lambda acc: F.concat(before, acc["o"], F.substring(run, acc["at"] + 1, F.length(run))))
        return _bind(mask, cut)

    def cut(mask):
        parts = F.arrays_zip(F.split(mask, BESIDE, -1).alias("gap"), F.regexp_extract_all(mask, F.lit(BESIDE), F.lit(0)).alias("hit"))
        none = F.array().cast("array<struct<gap:string,hit:string>>")

        def step(acc, p):
            start = acc["at"] + F.length(p["gap"])
            size = F.coalesce(F.length(p["hit"]), F.lit(0))
            shown = lambda at, n: F.substring(run, at - F.length(before) + 1, n)
            first = F.greatest(acc["at"], F.length(before))
            one = F.array(F.struct(shown(first, start - first).alias("gap"), F.when(p["hit"].isNotNull(), shown(start, size)).alias("hit")))
            return F.struct((start + size).alias("at"), F.concat(acc["out"], one).alias("out"))
        return F.aggregate(parts, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda acc: acc["out"])

    return _bind(cards(run), masked)


def pseudonymise(docs: DataFrame, key: str = KEY) -> DataFrame:
    """(doc_id, text, found): the text with pseudonyms; found has (kind, start, stop) in code points of the old text."""
    parts = F.arrays_zip(F.split("text", PATTERN, -1).alias("gap"), F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0)).alias("hit"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", whole_text().rlike(PATTERN).alias("any"))
    def opened(p):
        before = F.when(F.length(p["gap"]) > 0, F.substring(p["gap"], -1, 1)).otherwise("")
        ahead = F.array(F.struct(p["gap"].alias("gap"), F.lit(None).cast("string").alias("hit")))
        return F.when(p["hit"].rlike(f"^(?:{NUMBERS})$"), F.concat(ahead, _inside(before, p["hit"]))).otherwise(F.array(F.struct(p["gap"].alias("gap"), p["hit"].alias("hit"))))
    rows = rows.withColumn("parts", F.when(F.col("any"), F.transform(F.flatten(F.transform(parts, opened)), lambda p: F.struct(
        p["gap"].alias("gap"), p["hit"].alias("hit"), F.when(p["hit"].isNotNull(), kind_of(p["hit"])).alias("kind")))))
    made = F.transform("parts", lambda p: F.struct(p["gap"].alias("gap"), p["hit"].alias("hit"), p["kind"].alias("kind"),
                                                   F.when(p["kind"].isNotNull(), pseudonym(p["hit"], p["kind"], key)).otherwise(p["hit"]).alias("new")))
    rows = rows.withColumn("made", made)
    none = F.array().cast("array<struct<kind:int,start:int,stop:int>>")
    def place(acc, p):
        start = acc["at"] + F.length(p["gap"])
        stop = start + F.coalesce(F.length(p["hit"]), F.lit(0))
        one = F.array(F.struct(p["kind"].alias("kind"), start.alias("start"), stop.alias("stop")))
        return F.struct(stop.alias("at"), F.when(p["kind"].isNotNull(), F.concat(acc["out"], one)).otherwise(acc["out"]).alias("out"))
    found = F.aggregate(F.coalesce("made", F.array().cast(rows.schema["made"].dataType)), F.struct(F.lit(0).alias("at"), none.alias("out")), place, lambda acc: acc["out"])
    text = F.array_join(F.transform("made", lambda p: F.concat(p["gap"], F.coalesce(p["new"], F.lit("")))), "")
    return rows.select("doc_id", F.coalesce(text, F.col("text")).alias("text"), found.alias("found"))


def report(found: DataFrame) -> DataFrame:
    """Per document: counts by kind, the spans as text, and the pseudonymised text."""
    name = lambda k: F.element_at(F.array(*[F.lit(x) for x in KINDS]), k + 1)
    count = lambda k: F.size(F.filter("found", lambda x: x["kind"] == k)).cast("long")
    return found.select(
        "doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.array_join(F.transform("found", lambda x: F.concat_ws(":", name(x["kind"]), x["start"], x["stop"])), ",").alias("spans"), "text")
