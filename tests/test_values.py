import datetime
import decimal
import random
import re

import pytest
from pyspark.sql import functions as F

from propfold.functions import values as v


def evaluate(spark, texts, *columns):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
    return [tuple(r)[1:] for r in rows.select("i", *columns).orderBy("i").collect()]


def value():
    return F.col("v")


# Text, then whether it passes as integer, numeric, date.
TABLE = [
    (" 12 ", True, True, False),
    ("+7", True, True, False),
    ("-0", True, True, False),
    ("12.0", False, True, False),
    ("12.", False, True, False),
    (".5", False, True, False),
    (".", False, False, False),
    ("", False, False, False),
    (" ", False, False, False),
    ("1e3", False, True, False),
    ("1e99", False, False, False),
    ("0e99", False, True, False),
    ("-.0E77", False, True, False),
    ("1e-30", False, True, False),
    ("99999999999", False, True, False),
    ("1,5", False, True, False),
    ("1,234.5", False, False, False),
    ("nan", False, False, False),
    ("inf", False, False, False),
    ("1_000", False, False, False),
    ("$5", False, False, False),
    ("2024", True, True, False),
    ("2024-01", False, False, False),
    ("2024-1-5", False, False, False),
    ("20240131", True, True, False),
    ("2024-W05-1", False, False, False),
    ("2024-02-30", False, False, False),
    ("2024-02-29", False, False, True),
    ("2024-01-31T10:00:00", False, False, True),
    ("2024-01-31 10:00:00.123456+02:00", False, False, True),
    ("2024-01-31T25:00", False, False, False),
    ("2024-01-31T", False, False, False),
    ("2024-01-31Tnoon", False, False, False),
    ("0000-01-01", False, False, False),
    ("0001-01-01", False, False, True),
    ("12\n", True, True, False),
    (None, False, False, False),
]


def test_acceptance_table(spark):
    checks = [v.accepts(value(), t) for t in (v.INTEGER, v.NUMERIC, v.DATE)]
    found = evaluate(spark, [row[0] for row in TABLE], *checks)
    for row, result in zip(TABLE, found, strict=True):
        assert result == row[1:], row[0]


def test_varchar(spark):
    texts = ["", "x" * 255, "x" * 256, "word " * 20_000, None]
    assert evaluate(spark, texts, v.accepts(value(), v.VARCHAR)) == [(True,)] * 5
    assert evaluate(spark, texts, v.read_as(value(), v.VARCHAR)) == [(text,) for text in texts]


def test_unlisted_type_accepts_anything(spark):
    assert evaluate(spark, ["x", None], v.accepts(value(), "json")) == [(True,), (True,)]


def python_accepts(text: str, declared: str) -> bool:
    try:
        if declared == v.INTEGER:
            return -(2**31) <= int(text) < 2**31
        if declared == v.NUMERIC:
            float(text.replace(",", "."))
            return True
        datetime.datetime.fromisoformat(text)
        return True
    except ValueError:
        return False


def test_random_text_against_python(spark):
    pick = random.Random(7)
    texts = ["".join(pick.choice("0123456789+-.,e ") for _ in range(pick.randint(0, 7))) for _ in range(4000)]
    found = evaluate(spark, texts, v.accepts(value(), v.INTEGER), v.accepts(value(), v.NUMERIC))
    for text, (integer, numeric) in zip(texts, found, strict=True):
        assert integer == python_accepts(text, v.INTEGER), text
        if numeric != python_accepts(text, v.NUMERIC):
            # Only numbers beyond the stored precision may differ.
            assert not numeric and abs(decimal.Decimal(text.strip().replace(",", "."))) >= 10**20


def test_random_dates_against_python(spark):
    pick = random.Random(11)
    texts = []
    for _ in range(3000):
        day = f"{pick.randint(0, 2030):04d}-{pick.randint(0, 13):02d}-{pick.randint(0, 32):02d}"
        clock = pick.choice(["", " ", "T", "T10", "T24", " 09:59", "T09:60", "T09:30:15", "T09:30:15.25", "T09:30Z", " 09:30:15+02:00"])
        texts.append(day + clock)
    found = evaluate(spark, texts, v.accepts(value(), v.DATE), v.as_date(value()))
    for text, (accepted, date) in zip(texts, found, strict=True):
        assert accepted == python_accepts(text, v.DATE), text
        assert date == (datetime.date.fromisoformat(text[:10]) if accepted else None)


def test_refusals(spark):
    cases = [
        ("x" * 256, "varchar", None),
        ("x", "varchar", None),
        (None, "varchar", None),
        (None, "integer", "null_value"),
        ("a", "integer", "not_integer"),
        ("99999999999", "integer", "out_of_range"),
        ("12", "integer", None),
        ("a", "numeric", "not_numeric"),
        ("1e40", "numeric", "out_of_range"),
        ("1,5", "numeric", None),
        ("2024-02-30", "date", "not_date"),
        ("2024-02-28", "date", None),
        ("x", "json", None),
    ]
    rows = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, v string, t string, r string")
    for row in rows.withColumn("found", v.refusal(value(), F.col("t"))).collect():
        assert row["found"] == row["r"], row


@pytest.mark.parametrize(
    "text, whole",
    [
        ("12.5", "13"), ("-12.5", "-13"), ("12.7", "13"), ("12.4", "12"), (" 7.5 ", "8"),
        ("1e3", "1000"), ("abc", "abc"), ("1,5", "1,5"), ("", ""), (None, None),
        ("99999999999", "99999999999"), ("0e58", "0"),
    ],
)
def test_integer_text(spark, text, whole):
    assert evaluate(spark, [text], v.integer_text(value())) == [(whole,)]


def test_replace_text(spark):
    texts = ["a b c", "abc", " x", "x ", "", None]
    found = evaluate(
        spark, texts, v.replace_text(value(), " ", ""), v.replace_text(value(), " ", "", scope="first")
    )
    assert found == [("abc", "ab c"), ("abc", "abc"), ("x", "x"), ("x", "x"), ("", ""), (None, None)]
    assert evaluate(spark, ["$5$"], v.replace_text(value(), "$", "")) == [("5",)]
    assert evaluate(spark, ["xNew textNew text"], v.replace_text(value(), "New text", "-", "first")) == [
        ("x-New text",)
    ]
    with pytest.raises(ValueError):
        v.replace_text(value(), "a", "b", scope="last")


def test_email(spark):
    texts = ["a@b.c", "a@b.c@d", "@b.c", "a b@c.d", "a@b", "a@b.", "a@.c", "no mail here", "a\n@b.c"]
    rule = re.compile(r"[^@]+@[^@]+\.[^@]+")
    assert [r[0] for r in evaluate(spark, texts, v.is_email(value()))] == [
        bool(rule.match(t)) for t in texts
    ]
