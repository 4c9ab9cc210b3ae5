"""Counts and run summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F


def rows_per_day(df: DataFrame, day: str = "event_date") -> DataFrame:
    return df.groupBy(day).agg(F.count("*").alias("rows"))


def action_histogram(signals: DataFrame) -> DataFrame:
    """One row: a map from action to its number of windows."""
    counts = signals.groupBy("trade_action").agg(F.count("*").alias("n"))
    return counts.agg(
        F.map_from_entries(
            F.array_sort(F.collect_list(F.struct("trade_action", "n")))
        ).alias("trade_action_summary")
    )


def run_summary(signals: DataFrame, posts_used: int | Column) -> DataFrame:
    """One row: windows, posts behind them before filtering, last window, actions."""
    used = posts_used if isinstance(posts_used, Column) else F.lit(posts_used)
    by_action = signals.groupBy("trade_action").agg(
        F.count("*").alias("n"), F.max("window_start_iso").alias("last")
    )
    entries = F.array_sort(F.collect_list(F.struct("trade_action", "n")))
    return by_action.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_windows"),
        F.max("last").alias("last_window"),
        F.map_from_entries(entries).alias("trade_action_summary"),
    ).select("total_windows", used.alias("total_posts_used"), "last_window", "trade_action_summary")


def tag_counts(df: DataFrame, tag: str, total: str = "TOTAL") -> DataFrame:
    """Rows per tag and, in the row named ``total``, of all tags."""
    name = F.when(F.grouping(tag) == 1, F.lit(total)).otherwise(F.col(tag))
    return df.rollup(tag).agg(name.alias("label"), F.count("*").alias("rows")).select(
        F.col("label").alias(tag), "rows"
    )


def counts_for_all(dimension: DataFrame, df: DataFrame, tag: str) -> DataFrame:
    """Rows per tag for every tag of the dimension, 0 where there are none."""
    counts = df.groupBy(tag).agg(F.count("*").alias("rows"))
    return dimension.join(counts, tag, "left").fillna(0, subset=["rows"])


def watch(df: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, Observation]:
    """Count while passing through: the numbers are there once an action has run."""
    observation = Observation(name)
    return df.observe(observation, *[m.alias(k) for k, m in measures.items()]), observation
