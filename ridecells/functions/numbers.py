"""Columns over numbers."""

from pyspark.sql import functions as F


def round_half_up(value):
    return F.floor(F.col(value) + 0.5).cast("bigint")


def clean_number(text):
    """Double from text; null for a token that is no number."""
    return F.col(text).try_cast("double")


def within(a, b, tolerance):
    return F.abs(F.col(a) - F.col(b)) <= tolerance


def int_from_bytes(value):
    """Integer from four big-endian bytes."""
    number = F.conv(F.hex(value), 16, 10).cast("bigint")
    return F.when(number >= 2 ** 31, number - 2 ** 32).otherwise(number).cast("int")


def bytes_from_int(value):
    """Four big-endian bytes of an integer."""
    number = value.cast("bigint")
    unsigned = F.when(number < 0, number + 2 ** 32).otherwise(number)
    return F.unhex(F.lpad(F.hex(unsigned), 8, "0"))
