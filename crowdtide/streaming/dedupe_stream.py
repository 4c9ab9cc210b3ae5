"""Content dedupe across micro-batches."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from crowdtide.operators.clean import candidates, clean_posts
from crowdtide.operators.dedupe import HASH, first_rows
from crowdtide.operators.seen_state import SeenState, sent_if_small
from crowdtide.session import cut_lineage


def recent_first(posts: DataFrame, ts: str, delay: str, key: str = HASH) -> DataFrame:
    """The first post per hash within ``delay``; the state is bounded by it.

    The stateful operator cannot reduce before its shuffle: where one content may
    fill a batch, ``start_clean_stream``, which can, is the better choice.
    """
    return posts.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def start_clean_stream(
    raw: DataFrame,
    posts_root: str,
    seen_root: str,
    checkpoint: str,
    now: datetime | None = None,
    pause: str | None = None,
    **state_options,
) -> StreamingQuery:
    """Clean posts, each content once for ever: the seen state is the memory.

    Posts go to folders of the batch number. A replay reads the hashes of earlier
    batches only and overwrites what it wrote, so its result is the same, and
    nothing is doubled or lost. What is new is settled on hashes and places, then
    the batch's posts are taken once more from its files. Options are the state's.
    """

    def write(batch: DataFrame, number: int):
        state = SeenState(batch.sparkSession, seen_root, **state_options)
        state.compact(number)
        batch = batch.withColumn("row_pos", F.monotonically_increasing_id())
        first = cut_lineage(first_rows(candidates(batch)))
        held = first.count()
        new = cut_lineage(state.unseen(first, number, held))
        fresh = candidates(batch.join(sent_if_small(new, held), "row_pos"))
        (
            clean_posts(fresh, now).drop(HASH)
            .hint("rebalance", "event_date")
            .write.partitionBy("event_date")
            .mode("overwrite")
            .parquet(f"{posts_root}/batch_id={number}")
        )
        state.record(new, number)

    writer = raw.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": pause} if pause else {"availableNow": True}
    return writer.trigger(**trigger).start()
