"""Forgiving casts, validity predicates and display helpers.

Every function takes and returns Columns and stays inside generated code.
Missing numbers are NaN rather than NULL, so that text, NULL and NaN inputs are
dropped by the same predicate, :func:`is_finite`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NAN = float("nan")

# What is a number: digits, which single underscores may group, with an optional
# fraction and exponent. Looked up before the cast, because a cast that fails
# costs far more than the look (it raises and catches an error inside).
_DIGITS = r"\d++(?:_\d++)*+"
_NUMBER = (
    rf"^\s*+[+-]?(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?\s*+$"
)
_BLANKS = " \t\n\r\f\x0b"

# The words that stand for numbers, in lower case.
_PLUS_INFINITY = ("inf", "+inf", "infinity", "+infinity")
_MINUS_INFINITY = ("-inf", "-infinity")
_NOT_A_NUMBER = ("nan", "+nan", "-nan")


def safe_float(value: Column, default: float = NAN) -> Column:
    """Text to DOUBLE; whatever is not a number becomes ``default``.

    White space around the number and upper or lower case do not matter. Text
    that begins and ends like a plain number is cast at once; hexadecimal
    numbers, which the JVM would take, have an x.
    """
    plain = (
        value.between("+", "9~")
        & F.substring(value, -1, 1).between("0", "9")
        & ~F.contains(value, F.lit("x"))
        & ~F.contains(value, F.lit("X"))
    )
    word = F.lower(F.btrim(value, F.lit(_BLANKS)))
    number = F.replace(value, F.lit("_"), F.lit("")).try_cast("double")
    other = (
        F.when(F.rlike(value, F.lit(_NUMBER)), number)
        .when(word.isin(*_PLUS_INFINITY), F.lit(float("inf")))
        .when(word.isin(*_MINUS_INFINITY), F.lit(float("-inf")))
        .when(word.isin(*_NOT_A_NUMBER), F.lit(NAN))
        .otherwise(F.lit(default))
    )
    return F.coalesce(F.when(plain, value.try_cast("double")), other)


def cut_to_int(value: Column, default: int = 0) -> Column:
    """DOUBLE to INT, cut towards zero; missing and out of range give ``default``.

    The value is held to just outside the range, where NaN lands too, and what
    lies there is dropped, so that no cast fails.
    """
    below, above = -(2**31) - 1, 2**31
    held = F.least(F.greatest(value, F.lit(float(below))), F.lit(float(above))).cast("bigint")
    inside = F.nullif(F.nullif(held, F.lit(below)), F.lit(above))
    return F.coalesce(F.when(value.isNotNull(), inside.cast("int")), F.lit(default))


def safe_int(value: Column, default: int = 0) -> Column:
    """Text to INT by way of DOUBLE, cut towards zero; otherwise ``default``.

    Infinite values and values outside the INT range also give ``default``.
    """
    return cut_to_int(safe_float(value), default)


def number(df: DataFrame, name: str) -> Column:
    """The column as DOUBLE with NaN for missing, text and numeric types alike."""
    if isinstance(df.schema[name].dataType, T.NumericType):
        return F.coalesce(F.col(name).cast("double"), F.lit(NAN))
    return safe_float(F.col(name).cast("string"))


def whole_number(df: DataFrame, name: str) -> Column:
    """The column as INT with 0 for missing, text and numeric types alike."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType)):
        return F.coalesce(F.col(name).cast("int"), F.lit(0))
    if isinstance(dtype, T.NumericType):
        return cut_to_int(F.col(name).cast("double"))
    return safe_int(F.col(name).cast("string"))


def is_finite(value: Column) -> Column:
    """True for a real DOUBLE; false for NULL, NaN and both infinities.

    Spark orders NaN above infinity, so one comparison does and the value is
    worked out once.
    """
    return F.coalesce(F.abs(value) < float("inf"), F.lit(False))


def has_number(df: DataFrame, name: str) -> Column:
    """:func:`is_finite` of a column of any type.

    On a stored number these are plain comparisons, which reach the scan.
    """
    column = F.col(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return column.isNotNull() & (column > float("-inf")) & (column < float("inf"))
    if isinstance(df.schema[name].dataType, T.NumericType):
        return column.isNotNull()
    return is_finite(number(df, name))


def in_range(df: DataFrame, name: str, first: int, last: int) -> Column:
    """True if the column as whole number lies in the range, ends included.

    A missing number counts as 0. Pushable where the column is an integer.
    """
    if isinstance(df.schema[name].dataType, T.IntegralType):
        inside = F.col(name).between(first, last)
        return inside | F.col(name).isNull() if first <= 0 <= last else inside
    return whole_number(df, name).between(first, last)


def clean_utf8(raw: Column) -> Column:
    """BINARY to text; bytes that are not UTF-8 are dropped.

    A replacement character (U+FFFD) that the data itself holds is dropped too.
    """
    return F.replace(F.make_valid_utf8(raw.cast("string")), F.lit("�"), F.lit(""))


def as_text(value: Column, dtype: T.DataType) -> Column:
    """A value of type ``dtype`` as text, cleaned where it is BINARY."""
    return clean_utf8(value) if isinstance(dtype, T.BinaryType) else value.cast("string")


def contains_fragment(name: Column, fragment: str) -> Column:
    """True if ``name`` holds ``fragment``, upper and lower case being the same.

    The fragment is literal: ``%`` and ``_`` stand for themselves.
    """
    return F.contains(F.lower(name), F.lower(F.lit(fragment)))


def known_year(year: Column) -> Column:
    """The year, or NULL where it is 0, which stands for unknown."""
    return F.nullif(year, F.lit(0))
