"""Event-time windows, their statistics and the series derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from crowdtide.fixed_values import (
    MIN_POSTS,
    PLOT_OFFSET_FLOOR,
    PLOT_OFFSET_SHARE,
    PLOT_POINTS,
    THRESHOLD,
    WINDOW,
)
from crowdtide.functions import stats
from crowdtide.functions.times import DAY_MICROS, frequency_micros, window_floor, window_iso
from crowdtide.operators.ranking import with_row_index

FILL_BLOCK = 10_000


def with_window(df: DataFrame, ts: str, frequency: str = WINDOW) -> DataFrame:
    """Add ``window_start``: left-closed windows counted from the first day's midnight.

    Lengths that divide a day fall on the same marks from any midnight and need
    no look at the data; for others the first day is one scalar subquery.
    """
    length = frequency_micros(frequency)
    origin = 0
    if DAY_MICROS % length:
        first = df.agg(F.unix_micros(F.min(ts))).scalar()
        origin = first - F.pmod(first, F.lit(DAY_MICROS))
    return df.withColumn("window_start", window_floor(F.col(ts), length, origin))


def window_measures(value: str) -> list[Column]:
    """Aggregates of a signal window; all of them combine before the shuffle."""
    v = F.col(value)
    return [
        F.count(F.lit(1)).alias("n"),
        F.count(v).alias("count"),
        F.avg(v).alias("mean_signal"),
        stats.standard_error(v).alias("sem"),
        stats.share_where(v > 0).alias("proportion_positive"),
        stats.share_where(v < 0).alias("proportion_negative"),
    ]


def fill_gaps(windows: DataFrame, frequency: str = WINDOW) -> DataFrame:
    """Add the empty windows between the first and the last, with zeros."""
    length = frequency_micros(frequency)
    ends = windows.agg(
        F.unix_micros(F.min("window_start")).alias("a"),
        F.unix_micros(F.max("window_start")).alias("b"),
    ).filter("a is not null")
    # blocks of windows, then the windows of a block: no array grows with the span
    block = length * FILL_BLOCK
    every = (
        ends.select("b", F.explode(F.sequence("a", "b", F.lit(block))).alias("from"))
        .repartition("from")  # the ends are one row: its windows are made in many tasks
        .select(
            F.explode(
                F.sequence("from", F.least("b", F.col("from") + (block - length)), F.lit(length))
            ).alias("start")
        )
        .select(F.timestamp_micros("start").alias("window_start"))
    )
    measured = [c for c in windows.columns if c != "window_start"]
    zeros = {c: F.lit(0).cast(windows.schema[c].dataType) for c in measured}
    return every.join(windows, "window_start", "left").select(
        "window_start", *[F.coalesce(c, zero).alias(c) for c, zero in zeros.items()]
    )


def finish_signals(
    windows: DataFrame, threshold: float = THRESHOLD, min_posts: int = MIN_POSTS
) -> DataFrame:
    """Confidence band, decision and label of measured windows with enough posts."""
    return (
        windows.filter(F.col("count") >= min_posts)
        .withColumn("ci95_half", stats.half_width(F.col("n"), F.col("sem")))
        .withColumn(
            "trade_action",
            stats.trade_action(
                F.col("proportion_positive"), F.col("proportion_negative"), threshold
            ),
        )
        .withColumn("window_start_iso", window_iso(F.col("window_start")))
        .select(
            "window_start", "n", "count", "mean_signal", "sem", "ci95_half",
            "proportion_positive", "proportion_negative", "trade_action", "window_start_iso",
        )
    )


def window_signals(
    df: DataFrame,
    ts: str,
    value: str,
    frequency: str = WINDOW,
    threshold: float = THRESHOLD,
    min_posts: int = MIN_POSTS,
) -> DataFrame:
    """Signal windows of a value column. Empty windows show only if none is required."""
    windows = (
        with_window(df.select(ts, value), ts, frequency)
        .groupBy("window_start")
        .agg(*window_measures(value))
    )
    if min_posts <= 0:
        windows = fill_gaps(windows, frequency)
    return finish_signals(windows, threshold, min_posts)


def lookup_measures(
    windows: DataFrame, measures: DataFrame, key: str = "window_start"
) -> DataFrame:
    """Attach separately computed measures to windows, 0 where there is none. Both have one
    row per window, so a plain join is balanced."""
    names = [c for c in measures.columns if c != key]
    return windows.join(measures, key, "left").fillna(0, subset=names)


def thin_out(windows: DataFrame, points: int = PLOT_POINTS) -> DataFrame:
    """Every k-th window in time order, k the least that leaves ``points`` at most."""
    total = windows.agg(F.count("*")).scalar()
    stride = F.greatest(F.ceil(total / points), F.lit(1))
    indexed = with_row_index(windows, "window_start", slice_by=F.to_date("window_start"))
    return indexed.filter(F.pmod(F.col("row_index"), stride) == 0).drop("row_index")


def plot_series(windows: DataFrame, points: int = PLOT_POINTS) -> DataFrame:
    """Band limits and marker heights of the thinned windows."""
    mean, offset = F.col("mean_signal"), F.greatest(
        F.lit(PLOT_OFFSET_FLOOR), F.abs("mean_signal") * F.lit(PLOT_OFFSET_SHARE)
    )
    marker = (
        F.when(F.col("trade_action") == "SHORT", mean + offset)
        .when(F.col("trade_action") == "LONG", mean - offset)
        .otherwise(mean)
    )
    return thin_out(windows, points).select(
        "window_start",
        "mean_signal",
        (mean - F.col("ci95_half")).alias("lower"),
        (mean + F.col("ci95_half")).alias("upper"),
        marker.alias("marker"),
        "trade_action",
        "count",
    )
