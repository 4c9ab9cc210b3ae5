"""Raw posts to clean posts."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from crowdtide.fixed_values import COUNT_COLUMNS, POST_COLUMNS
from crowdtide.functions.casts import int_or_zero, optional_int
from crowdtide.functions.text import content_hash, first_filled, has_text, normalize_text, strip
from crowdtide.functions.times import event_day, parse_time, post_iso, time_or_now


def column_or_null(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def candidates(
    df: DataFrame,
    drop_empty: bool = True,
    repair: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Add the normalised ``content`` and its hash, unless it is there; drop rows without content."""
    raw = first_filled(column_or_null(df, "content"), column_or_null(df, "text"))
    if drop_empty:
        # on the raw text: a filter on the result would normalise every text twice
        df = df.filter(has_text(raw))
    out = df.withColumn("content", normalize_text(raw, repair))
    if drop_empty and repair is not None:
        out = out.filter(F.col("content") != "")
    if "content_hash" not in df.columns:
        out = out.withColumn("content_hash", content_hash(F.col("content")))
    # the raw text has become the content and isn't carried beside it
    return out.drop("text")


def clean_posts(df: DataFrame, now: datetime | Column | None = None) -> DataFrame:
    """The twelve post columns of candidate rows, plus ``ts``, ``event_date`` and the hash."""
    date = first_filled(column_or_null(df, "date"), column_or_null(df, "ts"))
    timed = df.withColumn("_ts", time_or_now(parse_time(date), now))
    empty = F.lit("")
    columns = {
        "id": F.coalesce(F.nullif(column_or_null(df, "id"), empty), F.col("content_hash")),
        "username": strip(F.coalesce(column_or_null(df, "username"), empty)),
        "date": post_iso(F.col("_ts")),
        "content": F.col("content"),
    }
    for name in POST_COLUMNS:
        if name in COUNT_COLUMNS:
            columns[name] = optional_int(column_or_null(df, name))
        elif name not in columns:
            columns[name] = F.coalesce(column_or_null(df, name), empty)
    return timed.select(
        *[columns[name].alias(name) for name in POST_COLUMNS],
        F.col("_ts").alias("ts"),
        event_day(F.col("_ts")).alias("event_date"),
        "content_hash",
    )


def feature_meta(df: DataFrame, drop_empty: bool = True, aliases: bool = True) -> DataFrame:
    """Text and meta columns the feature job needs.

    With ``aliases`` the ``text``, ``ts`` and ``hashtags`` columns stand in for
    missing ``content``, ``date`` and ``source_hashtag``.
    """

    def pick(name, alias):
        columns = [column_or_null(df, name).cast("string")]
        if aliases:
            columns.append(column_or_null(df, alias).cast("string"))
        return first_filled(*columns)

    text = pick("content", "text")
    if drop_empty:
        df = df.filter(has_text(text))
    return df.select(
        F.coalesce(column_or_null(df, "id").cast("string"), F.lit("")).alias("id"),
        pick("date", "ts").alias("date"),
        int_or_zero(column_or_null(df, "likeCount")).alias("likeCount"),
        int_or_zero(column_or_null(df, "retweetCount")).alias("retweetCount"),
        pick("source_hashtag", "hashtags").alias("source_hashtag"),
        strip(text).alias("content"),
        *[c for c in df.columns if c.startswith("_")],
    )

def text_rows(df: DataFrame) -> DataFrame:
    """``id``, ``date`` and ``content`` of posts, for scoring."""
    date = first_filled(
        column_or_null(df, "date").cast("string"), column_or_null(df, "ts").cast("string")
    )
    content = first_filled(column_or_null(df, "content"), column_or_null(df, "text"))
    return df.select(
        F.coalesce(column_or_null(df, "id").cast("string"), F.lit("")).alias("id"),
        parse_time(date).alias("date"),
        strip(content).alias("content"),
    )
