"""Generation names and namespace paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def generation_number(name: Column) -> Column:
    """Number in ``active_<digits>``; 0 for the bare ``active``; null for any other name.

    The number is unsigned 64-bit, hence a decimal; a larger one is no generation name.
    """
    digits = F.regexp_extract(name, r"^active_\+?([0-9]+)$", 1)
    number = F.when(digits != "", digits.try_cast("decimal(38,0)"))
    return F.when(name == "active", F.lit(0).cast("decimal(20,0)")).when(
        number <= F.lit("18446744073709551615").cast("decimal(38,0)"), number.cast("decimal(20,0)")
    )


def namespace_path(parts: Column) -> Column:
    return F.array_join(parts, "/")
