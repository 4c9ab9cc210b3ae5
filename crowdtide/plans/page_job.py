"""Web pages to raw posts: first seen, in turn by keyword, capped."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from crowdtide.fixed_values import POST_COLUMNS, ROWS_PER_VISIT
from crowdtide.operators.pages import page_records
from crowdtide.operators.ranking import first_per_key, round_robin_cap
from crowdtide.operators.summary import counts_for_all
from crowdtide.session import cut_lineage
from crowdtide.sources.write import write_csv


def collect_posts(
    pages: DataFrame,
    source_hashtag: Column,
    dimension: DataFrame,
    order_by: str = "page_id",
    cap: int | None = None,
    per_visit: int = ROWS_PER_VISIT,
    now: datetime | None = None,
) -> DataFrame:
    """Records of keyword pages, one per key.

    With a ``cap`` that many are taken, ``per_visit`` of each keyword in turn; keywords
    outside the dimension come last in each turn.
    """
    records = page_records(pages, source_hashtag=source_hashtag, now=now)
    unique = first_per_key(records, ["id"], [order_by, "article_no"])
    if cap is None:
        return unique
    seq = unique.withColumn("_seq", F.struct(order_by, "article_no"))
    return round_robin_cap(
        seq.join(dimension, "source_hashtag", "left"), "source_hashtag", "_seq", "tag_index", per_visit, cap=cap
    )


def run_page_job(
    pages: DataFrame, source_hashtag: Column, dimension: DataFrame, csv_root: str, **options
) -> DataFrame:
    """Append the posts to the CSV data set; returns rows per keyword, zeros included."""
    posts = collect_posts(pages, source_hashtag, dimension, **options).select(*POST_COLUMNS)
    posts = cut_lineage(posts)
    write_csv(posts, csv_root)
    return counts_for_all(dimension.select("source_hashtag"), posts, "source_hashtag")
