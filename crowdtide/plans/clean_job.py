"""Raw posts in, clean new posts out."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from crowdtide.fixed_values import BATCH_ROWS, POST_COLUMNS
from crowdtide.operators.clean import candidates, clean_posts
from crowdtide.operators.dedupe import HASH, dedupe, first_rows, number_batches, unseen
from crowdtide.operators.ranking import read_chunks
from crowdtide.operators.seen_state import SeenState, sent_if_small
from crowdtide.operators.summary import watch
from crowdtide.session import cut_lineage, use_utc
from crowdtide.sources.read import read_raw_posts
from crowdtide.sources.write import write_jsonl, write_stored_posts


def new_posts(
    raw: DataFrame,
    seen: DataFrame | None = None,
    order_by: str = "row_pos",
    intra_batch: str = "drop",
    batch_rows: int = BATCH_ROWS,
    now: datetime | None = None,
    repair: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Clean, first-seen posts of ``raw``.

    What stays is settled on hashes and places. Without copies of a batch to keep, a place
    is one row: the raw posts are then taken by it, and normalised once more only if kept.
    """
    if intra_batch != "drop":
        if "batch_id" not in raw.columns:
            raw = number_batches(raw, order_by, batch_rows)
        return clean_posts(dedupe(candidates(raw, repair=repair), seen, [order_by], intra_batch), now)
    first = first_rows(candidates(raw, repair=repair), [order_by])
    if seen is not None:
        first = unseen(first, seen)
    return clean_posts(candidates(raw.join(first, order_by), repair=repair), now)


def run_clean_job(
    spark: SparkSession,
    csv_path: str,
    parquet_root: str,
    jsonl_root: str,
    seen_root: str,
    intra_batch: str = "drop",
    batch_rows: int = BATCH_ROWS,
    compression: str = "snappy",
    now: datetime | None = None,
    multiline: bool = True,
    repair: Callable[[Column], Column] | None = None,
) -> dict[str, int]:
    """Write, write, mark: a crash in between repeats posts and loses none.

    Hashes and places say what is new; full posts are made and written once, after that.
    """
    use_utc(spark)
    now = now or datetime.now(timezone.utc)
    raw = read_raw_posts(spark, csv_path, multiline).withColumn(
        "row_pos", F.monotonically_increasing_id()
    )
    if raw.isEmpty():
        return {"rows_read": 0, "already_seen": 0, "cleaned": 0}
    raw, read = watch(raw, "clean_read", rows_read=F.count("*"))
    place = "row_pos"
    if intra_batch == "keep":
        raw, place = read_chunks(raw, batch_rows, "batch_id"), "batch_id"
    elif intra_batch != "drop":
        raise ValueError(f"intra_batch has to be 'drop' or 'keep', not {intra_batch!r}")
    rows = candidates(raw, repair=repair)
    state = SeenState(spark, seen_root)
    number = state.next_number()
    state.compact(number)
    first = cut_lineage(first_rows(rows, [place]))
    held = first.count()
    new = cut_lineage(state.unseen(first, number, held))
    fresh = new.count()
    cleaned = 0
    if fresh:
        # read by two writers
        new = sent_if_small(new, fresh)
        kept = candidates(raw.join(new, place), repair=repair) if place == "row_pos" else rows.join(new, [HASH, place], "left_semi")
        posts = cut_lineage(clean_posts(kept, now))
        cleaned = posts.count()
        write_stored_posts(posts, parquet_root, compression)
        write_jsonl(posts.select(*POST_COLUMNS), jsonl_root)
        state.record(new, number, now)
    return {"rows_read": read.get["rows_read"], "already_seen": held - fresh, "cleaned": cleaned}
