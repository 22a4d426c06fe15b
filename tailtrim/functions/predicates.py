"""The predicates of a clean-up: name match, rows that go, rows that stay."""

from __future__ import annotations

import math
from decimal import ROUND_FLOOR, Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Every whole number below this is a double without rounding.
EXACT_IN_DOUBLE = 2**53

# Decimals of so many digits keep their order as doubles.
EXACT_DIGITS = 15

_WHOLE_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def key_type(df: DataFrame, key: str) -> T.NumericType:
    """Type of a key column; an error that names the column if it is absent or not a number."""
    for field in df.schema.fields:
        if field.name.lower() == key.lower():
            if not isinstance(field.dataType, T.NumericType):
                raise TypeError(
                    f"key column {key!r} must be numeric, it is {field.dataType.simpleString()}"
                )
            return field.dataType
    raise ValueError(f"key column {key!r} is missing; the table has {', '.join(df.columns)}")


def _bound(df: DataFrame, key: str, cutoff: float) -> Column:
    """The cutoff as a literal that Parquet can compare with the key.

    Cutoffs are doubles. Comparing a whole-number key with a double casts the key of every row and
    pushes nothing to the scan. ``key >= c`` and ``key >= ceil(c)`` hold for the same whole numbers as
    long as no value rounds, so below 2^53 the cutoff becomes a bigint. Beyond that the double
    comparison, with its rounding, is kept. Likewise a decimal of up to 15 digits is a double without
    loss of its digits, and the cutoff becomes the lowest decimal of the key's scale that is not below.
    """
    value = float(cutoff)
    if not math.isfinite(value):
        raise ValueError(f"cutoff for {key!r} must be a finite number, got {cutoff!r}")
    kind = key_type(df, key)
    if isinstance(kind, _WHOLE_NUMBERS) and abs(value) < EXACT_IN_DOUBLE:
        return F.lit(math.ceil(value)).cast("bigint")
    if isinstance(kind, T.DecimalType) and kind.precision <= EXACT_DIGITS and _fits(value, kind):
        return F.lit(_lowest_decimal(value, kind)).cast(kind)
    return F.lit(value)


def _fits(cutoff: float, kind: T.DecimalType) -> bool:
    """Whether the decimals around a cutoff are of the key's type; else its double is compared."""
    return abs(cutoff) < 10 ** (kind.precision - kind.scale) - 1


def _lowest_decimal(cutoff: float, kind: T.DecimalType) -> Decimal:
    """The lowest decimal of a type's scale whose double is at least the cutoff."""
    step = Decimal(1).scaleb(-kind.scale)
    near = Decimal(cutoff).quantize(step, ROUND_FLOOR) - step
    while float(near) < cutoff:
        near += step
    return near


def at_or_above(df: DataFrame, key: str, cutoff: float) -> Column:
    """True for the rows a purge removes. A missing key is never at or above anything."""
    return F.col(key) >= _bound(df, key, cutoff)


def below_or_missing(df: DataFrame, key: str, cutoff: float) -> Column:
    """True for the rows a purge keeps, rows without a key included.

    Written as ``<`` or ``IS NULL`` because this form reaches the Parquet scan; the negation of
    ``>=`` would lose missing keys, and a coalesce around it is not pushed down.
    """
    return (F.col(key) < _bound(df, key, cutoff)) | F.col(key).isNull()


def name_like(column: str, pattern: str, ignore_case: bool = False) -> Column:
    """SQL ``LIKE`` with ``%`` and ``_`` as wildcards and no escape character.

    Spark reads a backslash as an escape, so it is doubled to stand for itself.
    """
    literal_backslash = pattern.replace("\\", "\\\\")
    name = F.col(column)
    return name.ilike(literal_backslash) if ignore_case else name.like(literal_backslash)
