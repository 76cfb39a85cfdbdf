"""Raw text values against declared column types.

Each type has a pattern that must match before the cast is tried. The bare casts
accept forms such as ``2024-1-5`` or ``12.0`` for an integer; the patterns do not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The declared column types.
VARCHAR, NUMERIC, DATE, INTEGER = "varchar", "numeric", "date", "integer"

SPARK_TYPES = {
    VARCHAR: T.StringType(),
    NUMERIC: T.DecimalType(38, 18),
    DATE: T.DateType(),
    INTEGER: T.IntegerType(),
}

SPACE = r"[ \t\n\r\f\x0B]*"
INTEGER_TEXT = rf"^{SPACE}[+-]?[0-9]+{SPACE}\z"
NUMERIC_TEXT = rf"^{SPACE}[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?{SPACE}\z"
ZERO_TEXT = rf"^{SPACE}[+-]?[0.]+[eE]"
CLOCK = r"([01][0-9]|2[0-3])(:[0-5][0-9](:[0-5][0-9]([.,][0-9]+)?)?)?"
ZONE = r"(Z|[+-]([01][0-9]|2[0-3])(:?[0-5][0-9])?)?"
DATE_TEXT = rf"^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}([T ]{CLOCK}{ZONE})?\z"

# Fixed value: what counts as an e-mail address, tested from the start of the text.
EMAIL_TEXT = r"^[^@]+@[^@]+[.][^@]+"


def point(value: Column) -> Column:
    """Decimal comma to decimal point."""
    return F.replace(value, F.lit(","), F.lit("."))


def as_integer(value: Column) -> Column:
    return F.when(value.rlike(INTEGER_TEXT), value.try_cast("int"))


def number(value: Column) -> Column:
    """Decimal number; the cast alone refuses a zero with a large exponent."""
    zero = F.when(value.rlike(ZERO_TEXT), F.lit(0).cast("decimal(38,18)"))
    return F.when(
        value.rlike(NUMERIC_TEXT), F.coalesce(value.try_cast("decimal(38,18)"), zero)
    )


def as_numeric(value: Column) -> Column:
    return number(point(value))


def as_date(value: Column) -> Column:
    real = value.rlike(DATE_TEXT) & ~value.startswith("0000")
    return F.when(real, F.substring(value, 1, 10).try_cast("date"))


def as_varchar(value: Column) -> Column:
    """Text of any length."""
    return value


READERS = {VARCHAR: as_varchar, NUMERIC: as_numeric, DATE: as_date, INTEGER: as_integer}


def read_as(value: Column, declared: str) -> Column:
    """Typed value, NULL where the text does not fit the declared type."""
    return READERS.get(declared, lambda text: text)(value)


def spark_type(declared: str) -> T.DataType:
    return SPARK_TYPES.get(declared, T.StringType())


def accepts(value: Column, declared: str) -> Column:
    """Does the text fit the declared type? Never NULL.

    A missing value fits ``varchar`` only; a type not listed accepts anything.
    """
    if declared not in READERS:
        return F.lit(True)
    fits = READERS[declared](value).isNotNull()
    return value.isNull() | fits if declared == VARCHAR else fits


def refusal(value: Column, declared: Column) -> Column:
    """Why the text does not fit the type named in ``declared``; NULL if it does."""
    typed = declared.isin(NUMERIC, DATE, INTEGER)
    return (
        F.when(value.isNull() & typed, "null_value")
        .when((declared == INTEGER) & ~value.rlike(INTEGER_TEXT), "not_integer")
        .when((declared == NUMERIC) & ~point(value).rlike(NUMERIC_TEXT), "not_numeric")
        .when((declared == DATE) & ~accepts(value, DATE), "not_date")
        .when((declared == INTEGER) & ~accepts(value, INTEGER), "out_of_range")
        .when((declared == NUMERIC) & ~accepts(value, NUMERIC), "out_of_range")
    )


def is_email(value: Column) -> Column:
    return value.rlike(EMAIL_TEXT)


def truthy(value: Column) -> Column:
    """The value, NULL when it is empty."""
    return F.nullif(value, F.lit(""))


def replace_text(value: Column, old: str, new: str, scope: str = "all") -> Column:
    """Replace fixed text: every occurrence, or the ``first`` one only."""
    if scope == "all":
        return F.replace(value, F.lit(old), F.lit(new))
    if scope != "first":
        raise ValueError(f"scope must be 'all' or 'first', not {scope!r}")
    at = F.instr(value, old)
    swapped = F.concat(
        F.substring(value, F.lit(1), at - 1),
        F.lit(new),
        F.substring(value, at + len(old), F.length(value)),
    )
    return F.when(at > 0, swapped).otherwise(value)


def integer_text(value: Column) -> Column:
    """Number text rounded half away from zero; other text stays as it is."""
    whole = F.round(number(value)).try_cast("int")
    return F.coalesce(whole.cast("string"), value)
