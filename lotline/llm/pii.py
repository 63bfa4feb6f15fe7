"""PII: format-preserving Feistel pseudonyms (DataFrame functions only).

Candidates are found by one pattern (a text's valid cards and account numbers
are looked up first and stand in it as they are, so digits beside them hide
none), validated by kind (Luhn sum, octets,
calendar, numbering rules), and replaced by a keyed permutation of the values
of the same kind and format; so equal values get equal pseudonyms in every
document, different ones different pseudonyms, and what is valid stays valid.
Invalid candidates and everything else stay as they are.

Two Feistel networks do this.  Text of digits and letters is cut in two halves
that shift each other, each character inside its class.  Values with a valid
range are numbered and permuted on ``a * b`` numbers, exactly their count:
dates on their 400-year cycle of 146,097 days (years 200 to 9799), addresses on 65,536 squared, and so
on.  A text is one projection: split at the candidates, map, join again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

ROUNDS = 8
KINDS = ("email", "date", "ip", "ssn", "phone", "card", "iban")
# each begins only where no longer number or word goes on to its left, so no text is scanned twice
_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}+(?:\.[A-Za-z0-9-]{1,63}+){1,8}"
_DATE = r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}[/.]\d{1,2}[/.]\d{4})(?![\d/-]|\.\d)"
_IP = r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d)"
_SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
_PHONE = r"(?<![\d+(-])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d|-\d)|(?<![\d+])\+\d{7,15}(?!\d)|(?<![\d+])\+\d{1,3}(?:[ -]\d{1,4}){2,6}(?![ -]?\d)"
_CARD = r"(?<![\d.+-])\d(?:[ -]?\d){12,18}(?!\d|[.-]\d)"
# together, or in fours: looked for at every length, as capitals or digits beside an account number are not part of it
_IBANS = (r"[A-Z]{2}\d{2}[A-Z0-9]{11,28}", *[rf"[A-Z]{{2}}\d{{2}}(?: [A-Z0-9]{{4}}){{{n}}}{rest}" for n in range(2, 8) for rest in ("", " [A-Z0-9]{1,3}")])
_ALONE, _ENDS = r"(?<![A-Za-z0-9])", r"(?![A-Za-z0-9])"
# printed forms, looked for at every group, as digits beside a card (a list number, a check code, a date) are not part of it
_GROUPS = (r"\d{4}(?:[ -]\d{4}){3}[ -]\d{3}", r"\d{4}(?:[ -]\d{4}){3}", r"\d{4}[ -]\d{6}[ -]\d{5}", r"\d{4}[ -]\d{6}[ -]\d{4}", r"\d{4}(?:[ -]\d{3}){3}", r"\d{13,19}")
_LEFT, _RIGHT = r"(?<![\d.+])(?:(?<!-)|(?<=\d-))", r"(?!\d|\.\d)"
# fixed values: characters of an account number by country, as its registry (ISO 13616) lists them
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC"}
_IBAN = "|".join(f"(?:{c.replace(' ', '|')})[0-9]{{2}}[A-Z0-9]{{{n - 4}}}" for n, c in IBAN_LENGTHS.items())
OTHERS = "|".join((_DATE, _IP, _SSN, _PHONE))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once, however often and deep the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _digest(key: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), *[p.cast("string") for p in parts]), 512)


def _chars(text: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.substring(text, i, F.lit(1)))


def _shift(text: Column, key: str, turn: Column, other: Column) -> Column:
    """Digits and ASCII letters moved inside their class by a stream made of the other half; an empty text stays."""
    def move(c: Column, i: Column) -> Column:
        stream = _digest(key, turn, other, F.floor(i / 32))
        by = F.conv(F.substring(stream, (i % 32) * 4 + 1, F.lit(4)), 16, 10).cast("int")
        moved = c
        for first, last in (("a", "z"), ("A", "Z"), ("0", "9")):
            n = ord(last) - ord(first) + 1
            moved = F.when(c.between(first, last), F.chr(F.lit(ord(first)) + (F.ascii(c) - ord(first) + by) % n)).otherwise(moved)
        return moved

    return F.when(F.length(text) == 0, text).otherwise(F.array_join(F.transform(_chars(text), move), ""))


def feistel_text(text: Column, key: str) -> Column:
    """Keyed permutation of the texts of the same length and character classes."""
    return _let(text, lambda t: _feistel_text(t, key))


def _feistel_text(text: Column, key: str) -> Column:
    half = F.floor(F.length(text) / 2).cast("int")
    begin = F.struct(F.substring(text, F.lit(1), half).alias("l"), F.substring(text, half + 1, F.length(text)).alias("r"))
    end = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), begin, lambda s, i: F.struct(
        s["r"].alias("l"), _shift(s["l"], key, i, s["r"]).alias("r")))
    return _let(end, lambda s: F.concat(s["l"], s["r"]))  # an even number of rounds: each half is back in its place


def feistel_number(x: Column, a: int, b: int, key: str) -> Column:
    """Keyed permutation of 0 ... a * b - 1."""
    def stream(i: Column, other: Column) -> Column:
        return F.conv(F.substring(_digest(key, i, other), 1, 15), 16, 10).cast("long")

    def two_turns(s: Column, i: Column) -> Column:
        return _let((s["l"] + stream(i * 2, s["r"])) % a, lambda l: F.struct(l.alias("l"), ((s["r"] + stream(i * 2 + 1, l)) % b).alias("r")))

    begin = _let(x.cast("long"), lambda v: F.struct(F.floor(v / b).cast("long").alias("l"), (v % b).alias("r")))
    return _let(F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS // 2)), begin, two_turns), lambda s: s["l"] * b + s["r"])


# ---------------------------------------------------------------------- kinds
def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _put(form: Column, digits: Column) -> Column:
    """``digits`` in the places of the digits of ``form``."""
    def place(c: Column, i: Column) -> Column:
        nth = F.length(_digits(F.substring(form, F.lit(1), i + 1)))
        return F.when(c.between("0", "9"), F.substring(digits, nth, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(_chars(form), place), "")


def _formed(form: Column, digits: Column) -> Column:
    return _let(digits, lambda d: _put(form, d))


def _luhn_sum(digits: Column) -> Column:
    """Sum of the digits, every other one doubled, beginning with the last but one."""
    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add)


def _date_parts(text: Column) -> tuple[Column, Column, Column]:
    iso, slash = text.rlike("^[0-9]{4}-"), text.contains("/")
    parts = F.split(text, "[-/.]")
    one, two, three = (F.get(parts, F.lit(i)).cast("int") for i in range(3))
    # day.month.year with dots; with slashes month/day/year, or day/month/year where that is no month
    slash = slash & (one <= 12)
    return (F.when(iso, one).otherwise(three), F.when(iso, two).when(slash, one).otherwise(two), F.when(iso, three).when(slash, two).otherwise(one))


def _day_first(text: Column) -> Column:
    """Written day/month/year, which only shows on days after the 12th."""
    return text.contains("/") & (F.get(F.split(text, "/"), F.lit(0)).cast("int") > 12)


def _cycles(year: Column) -> Column:
    """Years from the cycle 1800-2199 to that of ``year``; the calendar repeats every 400 years."""
    return (F.floor((year - 1800) / 400) * 400).cast("int")


def _date(text: Column) -> Column:
    """The day in 1800-2199 that a date of the years 200-9799 has in its own cycle; null if it is not valid."""
    year, month, day = _date_parts(text)
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    same = (year - _cycles(year)).cast("string")
    return F.when(year.between(200, 9799), F.try_to_date(F.concat_ws("-", same, two(month), two(day)), "yyyy-MM-dd"))


def _new_date(text: Column, key: str) -> Column:
    first = F.to_date(F.lit("1800-01-01"))
    moved = F.date_add(first, feistel_number(F.datediff(_date(text), first), 189, 773, f"{key}|date").cast("int"))  # 189 * 773 days are 400 years
    return F.when(_day_first(text), _let(_new_late_day(_date(text), key), lambda day: _date_like(text, day))).otherwise(_let(moved, lambda day: _date_like(text, day)))


def _new_late_day(date: Column, key: str) -> Column:
    """Days after the 12th among themselves, so that day/month stays apart from month/day; 9 * 9833 of them are in 400 years."""
    first = F.to_date(F.lit("1800-01-01"))
    before = lambda m: F.datediff(F.add_months(first, m), first) - m * 12  # noqa: E731  late days before month m
    month = (F.year(date) - 1800) * 12 + F.month(date) - 1
    number = F.datediff(date, first) - (month + 1) * 12

    def day(x: Column) -> Column:  # a month has 18.4 of them, so x is at most a month off its share
        near = F.transform(F.sequence(F.lit(-2), F.lit(2)), lambda i: F.floor(x * 4800 / 88497).cast("int") + i)
        m = F.get(F.filter(near, lambda m: (before(m) <= x) & (x < before(m + 1))), F.lit(0))
        return _let(m, lambda m: F.date_add(F.add_months(first, m), (x - before(m) + 12).cast("int")))

    return _let(feistel_number(number, 9, 9833, f"{key}|day/month"), day)


def _date_like(text: Column, moved: Column) -> Column:
    parts, d, m, y = F.split(text, "[-/.]"), F.dayofmonth(moved).cast("string"), F.month(moved).cast("string"), F.lpad((F.year(moved) + _cycles(_date_parts(text)[0])).cast("string"), 4, "0")
    # a part written with a leading zero gets one
    zero = F.get(parts, F.lit(0)).startswith("0") | F.get(parts, F.lit(1)).startswith("0")
    wide = lambda x: F.when(zero, F.lpad(x, 2, "0")).otherwise(x)
    return (F.when(text.rlike("^[0-9]{4}-"), F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")))
            .when(_day_first(text), F.concat_ws("/", d, wide(m), y)).when(text.contains("/"), F.concat_ws("/", wide(m), wide(d), y)).otherwise(F.concat_ws(".", wide(d), wide(m), y)))


def _octets(text: Column) -> Column:
    return F.transform(F.split(text, "\\."), lambda x: x.cast("long"))


def _new_ip(text: Column, key: str) -> Column:
    o = _octets(text)
    new = feistel_number(F.aggregate(o, F.lit(0).cast("long"), lambda t, y: t * 256 + y), 65536, 65536, f"{key}|ip")
    return _let(new, lambda x: F.concat_ws(".", *[(F.shiftright(x, s) % 256).cast("string") for s in (24, 16, 8, 0)]))


def _ssn_parts(text: Column) -> tuple[Column, Column, Column]:
    return F.substring(text, 1, 3).cast("int"), F.substring(text, 5, 2).cast("int"), F.substring(text, 8, 4).cast("int")


def _new_ssn(text: Column, key: str) -> Column:
    area, group, serial = _ssn_parts(text)  # areas 001-665 and 667-899, groups 01-99, serials 0001-9999
    at = F.when(area > 666, area - 2).otherwise(area - 1)
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")

    def write(x: Column) -> Column:
        at = F.floor(x / (99 * 9999))
        return F.concat_ws("-", pad(at + F.when(at >= 665, 2).otherwise(1), 3), pad(F.floor(x / 9999) % 99 + 1, 2), pad(x % 9999 + 1, 4))

    return _let(feistel_number((at.cast("long") * 99 + group - 1) * 9999 + serial - 1, 898, 99 * 9999, f"{key}|ssn"), write)


def _new_card(text: Column, key: str) -> Column:
    def checked(body: Column) -> Column:  # the last digit makes the sum right
        return F.concat(body, ((F.lit(10) - _let(F.concat(body, F.lit("0")), _luhn_sum) % 10) % 10).cast("string"))

    body = _let(_digits(text), lambda d: feistel_text(F.substring(d, F.lit(1), F.length(d) - 1), f"{key}|card"))
    return _formed(text, _let(body, checked))


def _rest_97(text: Column) -> Column:
    """Remainder by 97 of digits and letters (A: 10 ... Z: 35) read as one number."""
    def add(rest: Column, c: Column) -> Column:
        return F.when(c.between("0", "9"), rest * 10 + F.ascii(c) - 48).otherwise(rest * 100 + F.ascii(c) - 55) % 97

    return F.aggregate(_chars(text), F.lit(0), add)


def is_iban(text: Column) -> Column:
    """A country's letters and length, check digits 02 to 98; with the first four characters at the end the remainder is 1."""
    plain = F.replace(text, F.lit(" "), F.lit(""))
    shaped = plain.rlike(f"^(?:{_IBAN})$") & F.substring(plain, 3, 2).cast("int").between(2, 98)
    return shaped & (_rest_97(F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))) == 1)


def _new_iban(text: Column, key: str) -> Column:
    def write(account: Column) -> Column:  # the country stays, the check digits follow
        plain = F.replace(account, F.lit(" "), F.lit(""))
        check = F.lit(98) - _rest_97(F.concat(plain, F.substring(text, 1, 2), F.lit("00")))
        return F.concat(F.substring(text, 1, 2), F.lpad(check.cast("string"), 2, "0"), account)

    return _let(feistel_text(F.substring(text, F.lit(5), F.length(text)), f"{key}|iban"), write)


def _new_phone(text: Column, key: str) -> Column:
    country = F.regexp_extract(text, r"^\+[0-9]{1,3}(?=[ .(-])", 0)  # a country code that is set apart stays
    rest = F.substring(text, F.length(country) + 1, F.length(text))
    return F.concat(country, _let(rest, lambda r: _formed(r, feistel_text(_digits(r), f"{key}|phone"))))


def _new_email(text: Column, key: str) -> Column:
    name, domain = F.substring_index(text, "@", 1), F.substring_index(text, "@", -1)
    top = F.substring_index(domain, ".", -1)  # stays; the rest of a domain has one pseudonym for all its addresses
    below = F.substring(domain, F.lit(1), F.length(domain) - F.length(top))
    return F.concat(feistel_text(name, f"{key}|email"), F.lit("@"), feistel_text(below, f"{key}|domain"), top)


def kind(text: Column) -> Column:
    """Kind of a candidate, null if it is not valid."""
    digits, area, group, serial = _digits(text), *_ssn_parts(text)
    return (
        F.when(text.contains("@"), "email")
        .when(text.rlike("^[A-Z]"), F.when(is_iban(text), "iban"))
        .when(text.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"), F.when(F.forall(_octets(text), lambda x: x < 256), "ip"))
        .when(text.rlike(r"^([0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}([/.])[0-9]{1,2}\2[0-9]{4})$"), F.when(_date(text).isNotNull(), "date"))
        .when(text.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), F.when(area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0), "ssn"))
        .when(text.rlike(r"^[+(]|^[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}$"), F.when(F.length(digits).between(7, 15), "phone"))
        .when(is_card(text), "card"))


def is_card(text: Column) -> Column:
    digits = _digits(text)
    return F.length(digits).between(13, 19) & (_let(digits, _luhn_sum) % 10 == 0) & digits.rlike("[1-9]")


def _valid(text: Column, forms: tuple, left: str, right: str, valid: Callable[[Column], Column], others: str | None = None) -> Column:
    """Alternative for the valid values of ``forms`` in a text, found at every place where one can begin; empty if there is none."""
    found = [F.regexp_extract_all(text, F.lit(f"{left}(?=({f}){right})"), F.lit(1)) for f in forms]
    found += [F.regexp_extract_all(text, F.lit(f"({others})"), F.lit(1))] if others else []
    values = F.filter(F.array_distinct(F.concat(*found)), valid)
    longest = F.transform(F.sort_array(F.transform(values, lambda c: F.struct(F.length(c).alias("n"), c.alias("c"))), asc=False), lambda s: s["c"])
    return F.when(F.size(longest) > 0, F.concat(F.lit(f"|{left}(?:"), F.array_join(longest, "|"), F.lit(f"){right}"))).otherwise("")


def pattern(text: Column) -> Column:
    """Pattern of a text's candidates: the valid cards and account numbers are found first and stand in it as they are."""
    cards = F.when(text.rlike(r"\d(?:[ -]?\d){12}"), _valid(text, _GROUPS, _LEFT, _RIGHT, is_card, _CARD)).otherwise("")
    ibans = F.when(text.rlike(rf"{_ALONE}[A-Z]{{2}}\d{{2}} ?[A-Z0-9]{{4}}"), _valid(text, _IBANS, _ALONE, _ENDS, is_iban)).otherwise("")
    return F.concat(F.lit(_EMAIL), ibans, cards, F.lit(f"|{OTHERS}"))


def pseudonym(text: Column, kind: Column, key: str) -> Column:
    """A candidate's pseudonym: a value of the same kind and format; itself where the kind is null."""
    new = {"email": _new_email, "date": _new_date, "ip": _new_ip, "ssn": _new_ssn, "phone": _new_phone, "card": _new_card, "iban": _new_iban}
    out = text
    for name, make in new.items():
        out = F.when(kind == name, make(text, key)).otherwise(out)
    return F.coalesce(out, text)


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``docs`` (all columns) with pseudonyms in the text, and n_<kind> (long) values replaced.

    A null or empty text stays as it is (no values).  ``key`` is the secret:
    the same key links values across tables.  Columns named n_<kind> are
    replaced.  An empty table gives no rows.
    """
    kept = [c for c in docs.columns if c not in {f"n_{k}" for k in KINDS}]
    text = F.col(f"`{text_col}`").cast("string")
    # most texts have neither a digit nor an @; they are not searched
    searched = text.rlike("[0-9@]")
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.when(searched, pattern(text)).alias("_pattern"))
    found = F.transform(F.regexp_extract_all(text, F.concat(F.lit("("), F.col("_pattern"), F.lit(")")), F.lit(1)), lambda m: F.struct(m.alias("old"), kind(m).alias("kind")))
    rows = rows.withColumn("_found", F.when(F.col("_pattern").isNotNull(), found))
    new = F.transform("_found", lambda m: pseudonym(m["old"], m["kind"], key))
    parts = F.zip_with(F.split(text, F.col("_pattern"), -1), new, lambda between, value: F.concat(between, F.coalesce(value, F.lit(""))))
    changed = F.when(F.size("_found") > 0, F.array_join(parts, "")).otherwise(text)
    counts = [F.when(F.size("_found") > 0, F.size(F.filter("_found", lambda m: m["kind"] == k))).otherwise(F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS]
    return rows.select(*[changed.alias(c) if c == text_col else F.col(f"`{c}`") for c in kept], *counts)
