"""Tolerant number columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from crowdtide.functions.text import strip


def optional_int(value: Column) -> Column:
    """An integer, or NULL where the value is missing, empty or not a number.

    Whole and fractional spellings (``3``, ``3.0``) give the same integer.
    """
    text = strip(value.cast("string"))
    # a failing cast costs an exception, so junk is told by its look first
    whole = F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("bigint"))
    number = F.when(
        text.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), text.try_cast("double")
    )
    return F.coalesce(whole, number.try_cast("bigint"))


def int_or_zero(value: Column) -> Column:
    return F.coalesce(optional_int(value), F.lit(0).cast("bigint"))
