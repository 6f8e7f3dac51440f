"""How a figure is shown: rounding, colour class, unit, text for no data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NO_DATA = "No data"


def shown(value: Column, decimals: int = 2) -> Column:
    return F.round(value, decimals)


def plain_decimal(value: Column, scale: int = 8) -> Column:
    """A decimal as text without exponent; a cast writes ``0E-8`` outside ANSI mode."""
    return F.translate(F.format_number(value, scale), ",", "")


def change_class(value: Column) -> Column:
    """Red below zero, green from zero on, NULL stays NULL."""
    return F.when(value >= 0, "green").when(value < 0, "red")


def up_class(value: Column) -> Column:
    """Red from 0, green from 1."""
    return F.when(value >= 1, "green").when(value >= 0, "red")


def constant_class(colour: str) -> Column:
    return F.lit(colour)


def with_unit(value: Column, name: str, unit: str) -> Column:
    """Name a column and tag it with its unit."""
    return value.alias(name, metadata={"unit": unit})


def or_no_data(answer: DataFrame, column: str) -> DataFrame:
    """One row where ``answer`` has at most one: an empty one reads "No data".

    An aggregate without keys returns its row on empty input, too.
    """
    row = answer.agg(*[F.first(c).alias(c) for c in answer.columns])
    return row.withColumn(column, F.coalesce(F.col(column).cast("string"), F.lit(NO_DATA)))
