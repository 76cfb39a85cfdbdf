"""Numbers of any size, beside the decimal column that holds most of them.

A number is taken apart into its sign, the exponent of its first digit, and its digits
without zeros at either end. Its exact text is written from these, and its order key sorts
as the number does, so numbers beyond the column's 38 digits can be kept, compared and
ordered without rounding. Everything is built-in text functions; no value meets Python.

``read`` takes a text apart once; ``text_of``, ``key_of`` and ``held_of`` say what follows
from that. Whoever wants more than one of them keeps ``read`` in a column of its own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from propfold.functions.values import NUMERIC_TEXT, SPACE, ZERO_TEXT, point

# The decimal column: digits before and after its point.
WHOLE_DIGITS, DECIMALS = 20, 18

# Exponents are added up as longs; texts with longer ones are refused, zeros excepted.
EXPONENT_DIGITS = 15
EXPONENT_TEXT = rf"[eE][+-]?0*[0-9]{{1,{EXPONENT_DIGITS}}}{SPACE}\z"

SPACES = " \t\n\r\f\x0b"


def is_number(value: Column) -> Column:
    """Is the text a number, of whatever size? NULL for NULL."""

    def judged(text: Column) -> Column:
        plain = ~(F.contains(text, F.lit("e")) | F.contains(text, F.lit("E")))
        short = plain | text.rlike(EXPONENT_TEXT) | text.rlike(ZERO_TEXT)
        return text.rlike(NUMERIC_TEXT) & short

    return once(point(value), judged)


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` worked out once a row however often it is used.

    An expression that names another one twice is planned with two copies of it, so copies
    double with each step that builds on the one before; a lambda's argument is one value.
    """
    return F.transform(F.array(value), use)[0]


def parts(body: Column) -> Column:
    """The exponent of the first digit and the digits (empty for zero) of a bare number."""

    def of_written(whole: Column, written: Column) -> Column:
        raised = F.contains(body, F.lit("e"))
        power = F.when(raised, F.substring_index(body, "e", -1).try_cast("long"))
        led = F.ltrim(written, F.lit("0"))
        zeros = F.length(written) - F.length(led)
        exponent = F.coalesce(power, F.lit(0).cast("long")) + F.length(whole) - 1 - zeros
        return F.struct(exponent.alias("exponent"), F.rtrim(led, F.lit("0")).alias("digits"))

    def of_mantissa(mantissa: Column) -> Column:
        whole = F.substring_index(mantissa, ".", 1)
        return of_written(whole, F.replace(mantissa, F.lit(".")))

    return once(F.substring_index(body, "e", 1), of_mantissa)


def read(value: Column) -> Column:
    """Is it ``negative``, the ``exponent`` of the first digit, the ``digits`` (empty for zero).

    NULL for text that is no number.
    """

    def of_text(text: Column) -> Column:
        return once(
            parts(F.ltrim(text, F.lit("+-"))),
            lambda found: F.struct(
                (F.startswith(text, F.lit("-")) & (found["digits"] != "")).alias("negative"),
                found["exponent"].alias("exponent"),
                found["digits"].alias("digits"),
            ),
        )

    return F.when(is_number(value), once(F.lower(F.btrim(point(value), F.lit(SPACES))), of_text))


def text_of(number: Column) -> Column:
    """The exact text of a number that was read."""
    digits = number["digits"]
    sign = F.when(number["negative"], "-").otherwise("")
    more = F.when(F.length(digits) > 1, F.concat(F.lit("."), F.substring(digits, 2, 2**31 - 1))).otherwise("")
    written = F.concat(sign, F.substring(digits, 1, 1), more, F.lit("e"), number["exponent"].cast("string"))
    return F.when(digits == "", "0").otherwise(written)


def key_of(number: Column) -> Column:
    """The order key of a number that was read."""
    negative, exponent, digits = number["negative"], number["exponent"], number["digits"]
    complement = F.concat(F.translate(digits, "0123456789", "9876543210"), F.lit("~"))
    zero = digits == ""
    key = F.struct(
        F.when(zero, 0).when(negative, -1).otherwise(1).alias("sign"),
        F.when(zero, F.lit(0).cast("long")).when(negative, -exponent).otherwise(exponent).alias("exponent"),
        F.when(negative, complement).otherwise(digits).alias("digits"),
    )
    return F.when(number.isNotNull(), key)


def held_of(number: Column) -> Column:
    """Does the decimal column hold the number that was read?"""
    exponent, digits = number["exponent"], number["digits"]
    fits = (exponent < WHOLE_DIGITS) & (F.length(digits) - 1 - exponent <= DECIMALS)
    return (digits == "") | fits


def exact_text(value: Column) -> Column:
    """The number as ``-1.25e21``; equal numbers have one text. NULL for other text."""
    return once(read(value), text_of)


def order_key(value: Column) -> Column:
    """A struct that sorts, compares and takes minimum and maximum as the number does.

    Of negative numbers the exponent is negated and the digits are complemented, with an
    end mark behind every digit, so that more digits come first.
    """
    return once(read(value), key_of)


def held_exactly(value: Column) -> Column:
    """Does the decimal column hold the number without loss? NULL for other text."""
    return once(read(value), held_of)


def lost_text(value: Column) -> Column:
    """The exact text of a number that the decimal column rounds or cannot hold, else NULL."""
    return once(read(value), lambda number: F.when(~held_of(number), text_of(number)))
