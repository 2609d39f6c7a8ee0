"""Scalar rules of the extraction, as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Exclusive upper sku bounds of image hosts "01" to "10"; anything above is "11".
BUCKET_BOUNDS = (
    14400000, 28800000, 43200000, 72000000, 100800000,
    106200000, 111600000, 117000000, 131400000, 160200000,
)
# Fixed value: letter that marks UTF-8 text decoded as Latin-1.
MOJIBAKE_MARK = "Ð"

_INT_RANGE = {"short": (-(2**15), 2**15 - 1), "int": (-(2**31), 2**31 - 1)}


def integer_like(text: Column) -> Column:
    """True for an optional sign and digits that fit 32 bits: no blanks, no decimals."""
    return text.rlike(r"\A[+-]?[0-9]+\z") & text.try_cast("int").isNotNull()


def exact_int(number: Column, kind: str = "int") -> Column:
    """Narrow without loss: null for a fraction or a value out of range."""
    low, high = _INT_RANGE[kind]
    return F.when((number % 1 == 0) & number.between(low, high), number.cast(kind))


def minor_to_major(amount: Column) -> Column:
    """Hundredths to whole units, truncating toward zero."""
    return _int_div(amount, 100)


def _int_div(x: Column, n: int) -> Column:
    return F.call_function("div", x, F.lit(n)).cast("int")


def sku_bucket(sku: Column) -> Column:
    """Two-digit image host of a sku."""
    label = F.when(sku < BUCKET_BOUNDS[0], "01")
    for i, bound in enumerate(BUCKET_BOUNDS[1:], start=2):
        label = label.when(sku < bound, f"{i:02d}")
    return label.otherwise(f"{len(BUCKET_BOUNDS) + 1:02d}")


def sku_volume(sku: Column) -> Column:
    return _int_div(sku, 100000)


def sku_part(sku: Column) -> Column:
    return _int_div(sku, 1000)


def first_non_empty(preferred: Column, fallback: Column) -> Column:
    """``preferred`` unless null or empty, else ``fallback``; null if both are empty."""
    return F.coalesce(F.nullif(preferred, F.lit("")), F.nullif(fallback, F.lit("")))


def repair_double_encoding(text: Column) -> Column:
    """Undo UTF-8 read as Latin-1, only where the marker letter occurs.

    Each character gives its low byte and the bytes are read as UTF-8, malformed parts becoming U+FFFD.
    """
    low_bytes = F.transform(
        F.split(text, ""), lambda c: F.lpad(F.hex(F.ascii(c).bitwiseAND(255)), 2, "0")
    )
    repaired = F.make_valid_utf8(F.unhex(F.array_join(low_bytes, "")).cast("string"))
    return F.when(text.contains(MOJIBAKE_MARK), repaired).otherwise(text)


def normalise_text(text: Column) -> Column:
    """Drop line breaks and tabs, as every stored text does."""
    return F.translate(text, "\n\r\t", "")
