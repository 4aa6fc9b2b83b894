"""Helpers that several operators share."""

from __future__ import annotations

import sys
import types

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What separates words: the blank and the control characters 0x09 to 0x0D.
SPACE = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
A_TO_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed exactly once per row.

    The optimizer would otherwise copy an expression into each of its uses, also into lambdas,
    where it would run once per element. It does not look through a generator.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def packed(df: DataFrame, carry: list[str] | None = None, **keys: Column) -> DataFrame:
    """The rows (or the columns ``carry`` of them) as one struct ``row`` beside named keys.

    No column of the input can then clash with a name that an operator uses.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in carry or df.columns]).alias("row")
    return df.select(row, *[value.alias(name) for name, value in keys.items()])


def unpacked(columns: list[str]) -> list[Column]:
    """The columns of the rows that ``packed`` took in."""
    return [F.col("row").getField(c).alias(c) for c in columns]


def whole_text(column: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text: runs of characters that are no white space."""
    return F.array_remove(F.split(text, SPACE_RUN), "")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, A_TO_Z, A_TO_Z.lower())


def lower_bound(values: Column, x: Column) -> Column:
    """How many elements of a sorted array without nulls are below x, by binary search.

    ``values`` should be a column, not an expression: it is read in every step.
    """
    steps = F.sequence(F.lit(0), F.log2(F.size(values) + 1).cast("int"))
    middle = lambda a: F.shiftright(a["low"] + a["high"], 1)
    state = lambda low, high: F.struct(low.alias("low"), high.alias("high"))
    halve = lambda a, _: F.when(
        F.get(values, middle(a)) < x, state(middle(a) + 1, a["high"])
    ).otherwise(state(a["low"], middle(a)))
    return F.aggregate(steps, state(F.lit(0), F.size(values)), halve, lambda a: a["low"])


def is_among(values: Column, x: Column) -> Column:
    """Whether a sorted array column without nulls holds x; false if either is null.

    Time grows with the logarithm of the array, where ``array_contains`` reads all of it.
    """
    found = F.when(F.size(values) <= 8, F.array_contains(values, x)).otherwise(
        F.get(values, lower_bound(values, x)) == x
    )
    return F.coalesce(found, F.lit(False))


def worker_cache() -> dict:
    """A dictionary that lives as long as the Python worker.

    Functions are shipped by value, so their module's globals are new in every task; loaded
    vocabularies are kept here instead.
    """
    holder = sys.modules.setdefault("_reviewlab_worker", types.ModuleType("_reviewlab_worker"))
    return holder.__dict__.setdefault("kept", {})
