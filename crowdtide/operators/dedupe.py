"""Exact content dedupe, within a batch and against earlier runs."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from crowdtide.fixed_values import BATCH_ROWS
from crowdtide.operators.ranking import batch_numbers

HASH = "content_hash"


def unseen(rows: DataFrame, seen: DataFrame) -> DataFrame:
    """Rows whose hash is not in the seen table. Rows may repeat hashes."""
    return rows.join(seen.select(HASH), HASH, "left_anti")


def already_seen(hashes: DataFrame, seen: DataFrame) -> DataFrame:
    """The set of given hashes the seen table has."""
    return hashes.select(HASH).distinct().join(seen.select(HASH), HASH, "left_semi")


def drop_seen(rows: DataFrame, seen: DataFrame) -> DataFrame:
    """Rows, one per hash, less those already seen: adaptive execution picks the side to send."""
    return rows.join(seen.select(HASH), HASH, "left_anti")


def mark_seen(
    seen: DataFrame | None, rows: DataFrame, now: datetime | Column | None = None
) -> DataFrame:
    """New rows of the seen table: hashes it lacks, once each, with the marking time.

    Without ``seen`` the rows are known to be unseen and are not checked again.
    """
    if now is None:
        now = F.current_timestamp()
    stamp = now if isinstance(now, Column) else F.lit(now).cast("timestamp")
    new = rows.select(HASH).filter(F.col(HASH).isNotNull()).distinct()
    if seen is not None:
        new = new.join(seen.select(HASH), HASH, "left_anti")
    return new.withColumn("seen_at", stamp)


def first_rows(rows: DataFrame, order_by: Sequence[str] = ("row_pos",)) -> DataFrame:
    """Hash and place of the first row of each hash: narrow, and reduced before the shuffle."""
    if len(order_by) == 1:
        return rows.groupBy(HASH).agg(F.min(order_by[0]).alias(order_by[0]))
    first = rows.groupBy(HASH).agg(F.min(F.struct(*order_by)).alias("_first"))
    return first.select(HASH, *[F.col("_first")[c].alias(c) for c in order_by])


def dedupe(
    rows: DataFrame,
    seen: DataFrame | None = None,
    order_by: Sequence[str] = ("row_pos",),
    intra_batch: str = "drop",
    batch_rows: int = BATCH_ROWS,
) -> DataFrame:
    """First post per content hash, less the hashes already seen.

    ``intra_batch='drop'`` keeps one row per hash, the first by ``order_by``, which has to
    tell rows of one hash apart. Which rows stay is settled on hashes and places alone, and
    the posts are then taken by both: no text is sorted or held in an aggregate. ``'keep'`` reproduces a
    lookup made once per batch: copies inside the first batch that has the hash
    all stay, and those in later batches go. It needs the unfiltered row order
    in ``batch_id``, see ``number_batches``.
    """
    if intra_batch == "drop":
        first = first_rows(rows, order_by)
        if seen is not None:
            first = first.join(seen.select(HASH), HASH, "left_anti")
        return rows.join(first, [HASH, *order_by], "left_semi")
    if intra_batch != "keep":
        raise ValueError(f"intra_batch has to be 'drop' or 'keep', not {intra_batch!r}")
    first = first_rows(rows, ["batch_id"])
    if seen is not None:
        first = first.join(seen.select(HASH), HASH, "left_anti")
    # on hash and batch together: a batch is small, so no key is hot however often a content is repeated
    return rows.join(first, [HASH, "batch_id"], "left_semi")


def number_batches(raw: DataFrame, order_by: str, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """Batch numbers over raw rows, before any of them is dropped."""
    return batch_numbers(raw, order_by, batch_rows)
