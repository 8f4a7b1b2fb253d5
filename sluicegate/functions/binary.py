"""Byte-level expressions on binary columns. Everything here is a built-in Spark expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def byte_hex(data: Column, pos: int) -> Column:
    """The byte at 1-based ``pos`` as two upper-case hex digits; empty when there is none."""
    return F.hex(F.substring(data, pos, 1))


def u16_be(data: Column, pos: int) -> Column:
    """Two bytes at 1-based ``pos`` read as an unsigned big-endian number."""
    return F.conv(F.hex(F.substring(data, pos, 2)), 16, 10).cast("int")


def utf8_text(data: Column) -> Column:
    """Bytes as text, or null when they are not valid UTF-8."""
    return F.try_validate_utf8(data.cast("string"))


def u16_be_bytes(number: Column) -> Column:
    """A number as two big-endian bytes."""
    return F.unhex(F.lpad(F.hex(number.cast("int")), 4, "0"))


def utf8_bytes(text: Column) -> Column:
    return F.encode(text, "UTF-8")
