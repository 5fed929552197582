"""Canonical text over any table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions.text import normalize_text


def normalize_table(table: DataFrame, column: str, into: str | None = None) -> DataFrame:
    """Replace ``column`` by its canonical text, or add it as ``into``."""
    return table.withColumn(into or column, normalize_text(F.col(column)))
