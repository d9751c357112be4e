"""Small building blocks of column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of the word contracts: space and the controls 9 to 13.
SPACE = "[\\x20\\x09-\\x0D]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """Runs of characters other than space and controls 9 to 13; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{SPACE}+"), "")


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def hash_fraction(value: Column, digits: int = 8) -> Column:
    """The first ``digits`` hex digits of the MD5 as a number: a hash that any SQL engine has."""
    return F.conv(F.substring(F.md5(value), 1, digits), 16, 10).cast("long")
