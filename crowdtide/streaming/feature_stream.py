"""Features of post files as they arrive."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from crowdtide.fixed_values import INPUT_FILES
from crowdtide.plans.feature_job import feature_rows
from crowdtide.session import cut_lineage, use_utc
from crowdtide.sources.intake import bad_lines, good_lines, observed_lines

log = logging.getLogger(__name__)


def post_file_stream(
    spark: SparkSession,
    folder: str,
    pattern: str = INPUT_FILES,
    files_per_batch: int | None = 1,
    bytes_per_batch: str | None = None,
    archive: str | None = None,
    set_aside: bool = False,
) -> DataFrame:
    """JSON-lines posts of new files; finished files move to ``archive`` if given.

    With ``set_aside`` damaged and blank lines stay, marked in ``_line``, for
    ``start_feature_stream`` to put away; the stream's progress has their numbers in
    ``observedMetrics["intake"]``. Otherwise they go.

    A failed move is a warning, and the checkpoint, not the move, is what keeps a
    file from being read twice.
    """
    reader = (
        use_utc(spark).readStream.format("text")
        .option("pathGlobFilter", pattern)
        .option("ignoreCorruptFiles", True)
    )
    if bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    elif files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    lines = reader.load(folder).select("value", F.col("_metadata.file_path").alias("_file"))
    observed = observed_lines(lines, "intake", keep=("_file",))
    return observed if set_aside else good_lines(observed)


def start_feature_stream(
    posts: DataFrame,
    feature_root: str,
    checkpoint: str,
    make_encoder: Callable[[], Callable],
    pause: str | None = None,
    failed_root: str | None = None,
    quarantine_root: str | None = None,
    **options,
) -> StreamingQuery:
    """Append the features of each micro-batch; run once over what is there, or
    with ``pause`` keep polling.

    With one file per batch the batch is the file and so is the scope of the
    document frequencies. A batch is written to a folder of its number, so a
    replay after a crash overwrites and never doubles. With ``failed_root`` a
    batch that cannot be processed is put there as it came, to be run again, and
    the stream goes on; otherwise it stops the stream. Lines marked as damaged go to
    ``quarantine_root``, by the number of the batch too.
    """

    def write(batch: DataFrame, number: int):
        # read and counted once, whatever follows
        batch = cut_lineage(batch)
        if "_line" in batch.columns:
            if quarantine_root:
                bad_lines(batch).write.mode("overwrite").parquet(f"{quarantine_root}/batch_id={number}")
            batch = good_lines(batch)
        try:
            if not batch.isEmpty():
                rows = feature_rows(batch, make_encoder, drop_empty=False, aliases=False, **options)
                rows.write.mode("overwrite").parquet(f"{feature_root}/batch_id={number}")
        except Exception:
            if failed_root is None:
                raise
            log.exception("feature batch %s put aside", number)
            batch.write.mode("overwrite").parquet(f"{failed_root}/batch_id={number}")

    writer = posts.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": pause} if pause else {"availableNow": True}
    return writer.trigger(**trigger).start()
