"""Signal windows over a stream of scored posts."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from crowdtide.fixed_values import MIN_POSTS, THRESHOLD, WEIGHT_EMBEDDING, WEIGHT_LEXICAL, WINDOW
from crowdtide.functions.times import DAY_MICROS, frequency_micros
from crowdtide.operators.scoring import ScoreScaler, composite_score
from crowdtide.operators.windows import finish_signals, window_measures


def stream_signals(
    scored: DataFrame,
    scaler: ScoreScaler | DataFrame | None = None,
    ts: str = "ts",
    value: str = "composite",
    frequency: str = WINDOW,
    delay: str = "10 minutes",
    threshold: float = THRESHOLD,
    min_posts: int = MIN_POSTS,
    weight_emb: float = WEIGHT_EMBEDDING,
    weight_lex: float = WEIGHT_LEXICAL,
) -> DataFrame:
    """Closed signal windows of scored posts, for append mode.

    The scale is global and cannot be fitted on a stream: it is frozen, from a
    batch run. As a table of one row, see ``read_scale``, it is joined to the stream and
    read anew for each micro-batch; a ``ScoreScaler`` is part of the plan. Posts later
    than ``delay`` behind the newest are dropped; ``late_counts`` counts them.
    """
    length = frequency_micros(frequency)
    if DAY_MICROS % length:
        raise ValueError("a stream has no first day: the window length has to divide a day")
    if isinstance(scaler, DataFrame):
        scored = scored.crossJoin(F.broadcast(scaler))
        scored = scored.withColumn(value, composite_score(*map(F.col, scaler.columns), weight_emb, weight_lex))
    elif scaler is not None:
        scored = scored.withColumn(value, scaler.composite(weight_emb, weight_lex))
    # the watermark column cannot be zone-less
    timed = scored.select(F.col(ts).cast("timestamp").alias(ts), value)
    windows = (
        timed.withWatermark(ts, delay)
        .groupBy(F.window(ts, f"{length} microseconds").alias("w"))
        .agg(*window_measures(value))
        .withColumn("window_start", F.col("w.start"))
        .drop("w")
    )
    return finish_signals(windows, threshold, min_posts)


def late_counts(query: StreamingQuery) -> dict[str, int]:
    """From the progress a query still has: rows read, and late groups dropped.

    Spark sums the rows of a window before it looks at the watermark, so a late group is all
    late rows of one window in one micro-batch. Rows read less the rows of all closed and
    open windows are the late rows.
    """
    progress = [json.loads(p.json) if hasattr(p, "json") else p for p in query.recentProgress]
    return {
        "rows_read": sum(p["numInputRows"] for p in progress),
        "late_groups": sum(s["numRowsDroppedByWatermark"] for p in progress for s in p["stateOperators"]),
    }
