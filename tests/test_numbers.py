"""Numbers of any size against Python's decimals."""

import decimal
import random

from pyspark.sql import functions as F

from propfold.functions import numbers
from propfold.functions import values as v
from propfold.plans import queries
from propfold.sources import given

WIDE = decimal.Context(prec=200, Emax=decimal.MAX_EMAX, Emin=decimal.MIN_EMIN)

# Text, exact text, held by the decimal column.
TABLE = [
    ("123456789012345678901", "1.23456789012345678901e20", False),
    ("12345678901234567890", "1.234567890123456789e19", True),
    ("1e-30", "1e-30", False),
    ("0.12345678901234567890", "1.234567890123456789e-1", False),
    ("0.1234567890123456780", "1.23456789012345678e-1", True),
    ("0.12345678901234567891", "1.2345678901234567891e-1", False),
    (" -1,50 ", "-1.5e0", True),
    ("+007.", "7e0", True),
    ("-.0E77", "0", True),
    ("0e99999999999999999999", "0", True),
    ("1e99999999999999999999", None, None),
    ("-1e+0099", "-1e99", False),
    ("", None, None),
    (".", None, None),
    ("1,234.5", None, None),
    ("12 km", None, None),
    (None, None, None),
]


def evaluate(spark, texts, *columns):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
    return [tuple(r)[1:] for r in rows.select("i", *columns).orderBy("i").collect()]


def random_numbers(pick, count):
    for _ in range(count):
        whole = "".join(pick.choice("0019") for _ in range(pick.randint(1, 24)))
        fraction = "".join(pick.choice("0058") for _ in range(pick.randint(0, 24)))
        power = pick.choice(["", "", f"e{pick.randint(-40, 40)}", f"E+{pick.randint(0, 9):03d}"])
        yield pick.choice(["", "-", "+"]) + whole + pick.choice([".", ","]) + fraction + power


def as_python(text):
    return WIDE.create_decimal(text.replace(",", "."))


def test_table(spark):
    value = F.col("v")
    found = evaluate(spark, [t for t, *_ in TABLE], numbers.exact_text(value), numbers.held_exactly(value))
    for row, result in zip(TABLE, found, strict=True):
        assert result == row[1:], row[0]


def test_exact_text_and_lost_digits_against_python(spark):
    texts = list(random_numbers(random.Random(5), 3000))
    value = F.col("v")
    columns = numbers.exact_text(value), numbers.held_exactly(value), v.as_numeric(value), numbers.lost_text(value)
    for text, (exact, held, stored, lost) in zip(texts, evaluate(spark, texts, *columns), strict=True):
        true = as_python(text)
        assert WIDE.create_decimal(exact) == true, text
        assert held == (stored is not None and stored == true), text
        assert lost == (None if held else exact), text


def test_order_key_sorts_as_the_numbers(spark):
    texts = list(random_numbers(random.Random(9), 2000))
    rows = spark.createDataFrame([(t,) for t in texts], "v string")
    ordered = [r["v"] for r in rows.orderBy(numbers.order_key(F.col("v")), "v").collect()]
    assert ordered == sorted(texts, key=lambda t: (as_python(t), t))


def test_what_fits_the_column_is_a_number(spark):
    texts = list(random_numbers(random.Random(2), 500)) + [t for t, *_ in TABLE] + ["1 2", "e5", "--1", "1e5.0"]
    found = evaluate(spark, texts, v.accepts(F.col("v"), v.NUMERIC), numbers.is_number(F.col("v")))
    assert all(number or not fits for fits, number in found)


def test_a_text_is_taken_apart_once(spark):
    value = F.col("v")
    rows = spark.createDataFrame([("1.5e3",)], "v string")
    for column in (numbers.exact_text, numbers.order_key, numbers.held_exactly, numbers.lost_text):
        plan = rows.select(column(value).alias("c"))._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("substring_index") <= 3 and plan.count("RLIKE") <= 3, column.__name__


def test_the_query_takes_a_text_apart_once(spark, tmp_path):
    for name in ("events", "orders", "documents"):
        spark.createDataFrame([], given.GIVEN[name]).write.parquet(str(tmp_path / f"{name}.parquet"))
    found = queries.registered()["exact_numbers"](spark, str(tmp_path))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # One reading in each of the three branches that event properties come from.
    assert 0 < plan.count("substring_index") <= 3 * 3
