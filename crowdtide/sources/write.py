"""Writers. Spark's commit protocol makes each of them all or nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from crowdtide.operators.dedupe import mark_seen


def write_stored_posts(df: DataFrame, root: str, compression: str = "snappy", mode="append"):
    """Parquet by day. Rows are brought together by day first, large days in parts,
    so that files are few and of one size."""
    (
        df.drop("content_hash")
        .hint("rebalance", "event_date")
        .write.partitionBy("event_date")
        .option("compression", compression)
        .mode(mode)
        .parquet(root)
    )


def write_jsonl(df: DataFrame, path: str, single_file: bool = False, mode: str = "append"):
    """One JSON object per line, UTF-8, NULLs written out."""
    if single_file:
        df = df.coalesce(1)
    df.write.option("ignoreNullFields", False).mode(mode).json(path)


def write_features(df: DataFrame, root: str, mode: str = "append"):
    """Feature table. A chunk number stays a column: a folder per 500 rows would
    outgrow any file system."""
    df.write.option("compression", "snappy").mode(mode).parquet(root)


def write_csv(df: DataFrame, path: str, mode: str = "append"):
    """CSV with a header per file; values are written as they are, blanks included."""
    (
        df.write.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .mode(mode)
        .csv(path)
    )


def write_signals_json(signals: DataFrame, path: str, document: bool = False, mode: str = "append"):
    """Signals without the raw window start, as JSON lines or as one JSON array.

    The array is streamed through one task in time order, line by line, and is
    never held as a whole.
    """
    rows = signals.drop("window_start")
    if not document:
        write_jsonl(rows, path, mode=mode)
        return
    last = signals.agg(F.max("window_start_iso")).scalar()
    body = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})
    lines = rows.select(
        F.col("window_start_iso").alias("k"),
        F.lit(1).alias("part"),
        F.concat(body, F.when(F.col("window_start_iso") == last, "").otherwise(",")).alias("value"),
    )
    ends = signals.sparkSession.createDataFrame(
        [("", 0, "["), ("~", 2, "]")], "k string, part int, value string"
    )
    (
        lines.unionByName(ends)
        .repartition(1)
        .sortWithinPartitions("part", "k")
        .select("value")
        .write.mode(mode)
        .text(path)
    )


def write_table_copy(df: DataFrame, path: str):
    """Unpartitioned Parquet copy; a table without rows writes nothing."""
    if not df.isEmpty():
        df.write.mode("append").parquet(path)


def append_seen(rows: DataFrame, root: str, now=None, seen: DataFrame | None = None):
    """Add the rows' hashes to the seen table; those in ``seen`` are left out."""
    mark_seen(seen, rows, now).write.mode("append").parquet(root)
