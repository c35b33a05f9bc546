"""Decoding of logs whose data are 32-byte words in hexadecimal."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def word(data: Column, index: int) -> Column:
    """The ``index``-th word (64 digits) of ``0x``-prefixed data."""
    return F.substring(data, 3 + 64 * index, 64)


def as_address(value: Column) -> Column:
    """The last 20 bytes of a word."""
    return F.concat(F.lit("0x"), F.lower(F.substring(value, 25, 40)))


def as_unsigned(value: Column) -> Column:
    """The number in a word, or null if it needs more than 126 bits."""
    part = lambda start: F.conv(F.substring(value, start, 8), 16, 10).cast("decimal(38,0)")
    total = part(33)
    for start in (41, 49, 57):
        total = (total * F.lit(1 << 32).cast("decimal(10,0)")).cast("decimal(38,0)") + part(start)
        total = total.cast("decimal(38,0)")
    fits = F.substring(value, 1, 32).rlike("^0*$") & (F.conv(F.substring(value, 33, 1), 16, 10).cast("int") < 4)
    return F.when(fits, total)


def encode_unsigned(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 64, "0")
