"""Keep a filter from repeating the work below it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def filterable(rows: DataFrame, column: str, name: str) -> DataFrame:
    """``rows`` with a costly ``column`` renamed to ``name`` that later filters do not compute again.

    Catalyst moves a filter below a projection by copying the projected expression into it. A filter on
    a generator's output stays above the generator. The array is made inside the generator because
    Catalyst adds a size filter, copied just the same, for an array that is a column.
    """
    return rows.select("*", F.explode(F.array(column)).alias(name)).drop(column)
