"""Concatenation of tables whose columns differ."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def concat(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames by column name; columns a frame lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
