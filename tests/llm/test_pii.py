import datetime
import re

from lotline.llm import pii
from pyspark.sql import functions as F
from tests_llm_util import ODD, docs, small  # noqa: F401


def luhn(s):
    d = [int(c) for c in re.sub("[^0-9]", "", s)][::-1]
    return sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(d)) % 10 == 0


def shape(s):
    return re.sub("[0-9]", "0", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", s)))


def test_networks_are_permutations(spark):
    for a, b in ((7, 13), (1, 9), (16, 16)):
        got = [r[0] for r in spark.range(a * b).select(pii.feistel_number(F.col("id"), a, b, "k")).collect()]
        assert sorted(got) == list(range(a * b)) and got != list(range(a * b))
    texts = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("t"))
    got = [r[0] for r in texts.select(pii.feistel_text(F.col("t"), "k")).collect()]
    assert sorted(got) == [f"{i:03}" for i in range(1000)]
    letters = spark.createDataFrame([(x + y,) for x in "abcdefghijklmnopqrstuvwxyz" for y in "abcdefghijklmnopqrstuvwxyz"], "t string")
    assert len({r[0] for r in letters.select(pii.feistel_text(F.col("t"), "k")).collect()}) == 676
    odd = spark.createDataFrame([("",), ("a",), ("-",), ("x" * 300,)], "t string").select("t", pii.feistel_text(F.col("t"), "k").alias("p")).collect()
    assert all(shape(r.t) == shape(r.p) for r in odd)


VALID = {
    "card": ["4041894974608795", "4111 1111 1111 1111", "5500-0000-0000-0004", "378282246310005"],
    "ip": ["42.144.35.254", "10.0.0.1"],
    "phone": ["+1 (988) 555-2485", "555-123-4567", "(212) 555-0123", "+33 1 23 45 67 89", "+4915112345678"],
    "ssn": ["123-45-6789", "665-01-0001", "667-99-9999"],
    "date": ["1999-12-31", "2/28/2024", "29.02.2024", "01/02/2003"],
    "iban": ["DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "BE68 5390 0754 7034", "NO9386011117947"],
    "email": ["bosbt.42@mail8.example.com", "Jane_Doe+x@a-b.co.uk"],
}
INVALID = ["4041894974608796", "300.1.1.1", "1.2.3.4.5", "000-12-3456", "666-12-3456", "900-12-3456", "2023-02-30", "13/45/2020", "12345", "3.14", "0000000000000000", "a@b", "1-2-3", "DE88370400440532013000", "GB82 WEST 1234 5698 7654 33", "0150-01-01", "9900-01-01"]


def test_values_and_formats(spark):
    rows = [(k, v, f"before {v} after, {v}.") for k, vs in VALID.items() for v in vs] + [(None, v, f"before {v} after") for v in INVALID]
    df = spark.createDataFrame(rows, "kind string, value string, text string")
    out = pii.pseudonymise(df, "k").collect()
    for r in out:
        if r.kind is None:
            assert r.text == f"before {r.value} after", r.value
            continue
        new = r.text.removeprefix("before ").split(" after, ")[0]
        assert r.text == f"before {new} after, {new}." and new != r.value, r
        assert r[f"n_{r.kind}"] == 2
        if r.kind not in ("ip", "date"):
            assert shape(new) == shape(r.value)
        if r.kind == "card":
            assert luhn(new)
        if r.kind == "ip":
            assert all(0 <= int(x) < 256 for x in new.split("."))
        if r.kind == "ssn":
            area, group, serial = map(int, new.split("-"))
            assert 1 <= area <= 899 and area != 666 and group and serial
        if r.kind == "date":
            y, m, d = map(int, new.split("-") if "-" in new else [new.split("/")[i] for i in (2, 0, 1)] if "/" in new else new.split(".")[::-1])
            assert 1800 <= datetime.date(y, m, d).year <= 2199
    # what comes out is found and valid again, and equal values stay equal, with another key others
    again = pii.pseudonymise(df.filter("kind is not null").drop("text").withColumn("text", F.col("value")), "k").collect()
    other = pii.pseudonymise(df.filter("kind is not null").drop("text").withColumn("text", F.col("value")), "other").collect()
    assert {r.value: r.text for r in again} == {r.value: r.text.removeprefix("before ").split(" after, ")[0] for r in out if r.kind}
    assert all(a.text != b.text for a, b in zip(sorted(again), sorted(other)))
    twice = pii.pseudonymise(spark.createDataFrame([(r.kind, r.text) for r in again], "kind string, text string"), "k").collect()
    assert all(r[f"n_{r.kind}"] == 1 for r in twice)


def test_values_beside_other_digits(spark):
    """(text, the value in it, kind): only the value changes."""
    cards = ["4111 1111 1111 1111", "378282246310005", "3782 822463 10005", "5500-0000-0000-0004"]
    beside = ["{} 123", "{} 12/25", "1 {}", "12 {} 123", "1234 {}", "{} exp 12/25 cvv 123"]
    rows = [(b.format(c), c, "card") for c in cards for b in beside]
    rows += [("born 25/12/2020.", "25/12/2020", "date"), ("born 31/01/1999.", "31/01/1999", "date"), ("call +44-20-7946-0958 now", "+44-20-7946-0958", "phone")]
    df = spark.createDataFrame(rows, "text string, value string, kind string").withColumn("given", F.col("text"))
    for r in pii.pseudonymise(df, "k").collect():
        assert r.value not in r.text and r[f"n_{r.kind}"] >= 1, r
        assert shape(r.text) == shape(r.given) or r.kind == "date", r
        if r.kind == "date":
            d, m, y = map(int, r.text[5:-1].split("/"))
            assert datetime.date(y, m, d).day > 12


def test_day_first_dates_stay_apart(spark):
    days = spark.sql("select explode(sequence(date'1800-01-01', date'2199-12-31', interval 7 days)) d").filter("day(d) > 12").select(F.date_format("d", "dd/MM/yyyy").alias("text"))
    got = [r.text for r in pii.pseudonymise(days, "k").filter("n_date = 1").collect()]
    assert len(got) == len(set(got)) == days.count()
    assert all(datetime.date(*map(int, t.split("/")[::-1])).day > 12 for t in got)


def test_all_days_and_numbers_stay_apart(spark):
    days = spark.sql("select explode(sequence(date'1800-01-01', date'1812-12-31')) d").select(F.col("d").cast("string").alias("text"))
    out = pii.pseudonymise(days, "k")
    assert out.agg(F.sum("n_date")).first()[0] == days.count()
    got = [r.text for r in out.collect()]
    assert len(set(got)) == len(got)


def test_documents(small):
    df, rows = small
    out = pii.pseudonymise(df, "k")
    assert out.columns == df.columns + [f"n_{k}" for k in pii.KINDS]
    changed = 0
    for r, (i, text, *_) in zip(sorted(out.collect(), key=lambda r: r.doc_id), sorted(rows)):
        values = re.findall(r"[\w.]+@[\w.]+|\+1 \(\d{3}\) \d{3}-\d{4}|(?<!\d)\d{16}(?!\d)|\d+\.\d+\.\d+\.\d+", text)
        values = [v for v in values if not v.isdigit() or luhn(v)]
        assert all(v not in r.text for v in values)
        assert (r.text != text) == bool(sum(r[f"n_{k}"] for k in pii.KINDS))
        changed += r.text != text
        if not values:
            assert r.text == text
    assert changed


def test_odd_rows(docs):
    rows = [r for r in ODD] + [(40, "a" * 100_000 + "@" + "b" * 100_000), (41, "1" * 50_000), (42, "1 " * 50_000), (43, "a@" * 20_000)]
    got = {(r.doc_id, r.text) for r in pii.pseudonymise(docs(rows), "k").collect()}
    assert got == set(rows)
    assert pii.pseudonymise(docs([]), "k").count() == 0


def rest_97(s):
    s = s.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97


def test_account_numbers(spark):
    """Country and form stay, the check digits are right again; capitals, digits and cards beside them change nothing."""
    values = ["DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "BE68 5390 0754 7034", "AT61 1904 3002 3457 3201"]
    beside = ["{} PAID IN", "{} 12", "TO {} ABCD EFGH", "{}, 4111 1111 1111 1111"]
    rows = [(b.format(v), v) for v in values for b in beside] + [("ID12 4111 1111 1111 1111", "")]
    out = pii.pseudonymise(spark.createDataFrame(rows, "text string, value string").withColumn("given", F.col("text")), "k").collect()
    new = {}
    for r in out:
        assert "4111 1111 1111 1111" not in r.text and r.n_iban == bool(r.value), r
        if r.value:
            at = r.given.index(r.value)
            got = r.text[at:at + len(r.value)]
            assert got != r.value and got[:2] == r.value[:2] and shape(got) == shape(r.value) and rest_97(got) == 1, r
            assert new.setdefault(r.value, got) == got
            assert r.text.startswith(r.given[:at]) and ("4111" in r.given or r.text[at + len(got):] == r.given[at + len(got):])
    given = [f"NO{98 - int(f'{i:011}232400') % 97:02}{i:011}" for i in range(0, 3000, 7)]
    assert all(rest_97(v) == 1 for v in given)
    got = [r.text for r in pii.pseudonymise(spark.createDataFrame([(v,) for v in given], "text string"), "k").collect()]
    assert len(set(got)) == len(given) and all(rest_97(v) == 1 and v[:2] == "NO" for v in got)


def test_dates_of_other_centuries(spark):
    """A date stays in its 400-year cycle, four digits in the year; days stay apart."""
    days = [f"{y:04}-{m:02}-{d:02}" for y in (200, 999, 1400, 1750, 2250, 9799) for m in (1, 2, 12) for d in (1, 13, 28)]
    forms = days + [f"{d[8:]}/{d[5:7]}/{d[:4]}" for d in days if d[8:] > "12"] + [f"{d[8:]}.{d[5:7]}.{d[:4]}" for d in days]
    out = pii.pseudonymise(spark.createDataFrame([(t, t) for t in forms], "text string, given string"), "k").collect()
    assert len({r.text for r in out}) == len(forms)
    for r in out:
        year = lambda t: int(t[:4] if t[4] == "-" else t[-4:])
        assert r.n_date == 1 and re.fullmatch(r"\d{4}-\d\d-\d\d|\d{1,2}([/.])\d{1,2}\1\d{4}", r.text), r
        assert (year(r.text) - 1800) // 400 == (year(r.given) - 1800) // 400


def test_domains_are_linked(spark):
    out = [r.text for r in pii.pseudonymise(spark.createDataFrame([("bob@smith-family.org ann@smith-family.org",), ("bob@example.co.uk",)], "text string"), "k").collect()]
    one, two = out[0].split()
    assert one.split("@")[1] == two.split("@")[1] != "smith-family.org" and one.endswith(".org") and shape(one) == "aaa@aaaaa-aaaaaa.aaa"
    assert "example" not in out[1] and out[1].endswith(".uk")
