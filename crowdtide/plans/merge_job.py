"""Stored posts of all days to one JSON-lines data set."""

from __future__ import annotations

from pyspark.sql import SparkSession, functions as F, types as T

from crowdtide.operators.summary import watch
from crowdtide.schemas import STORED_POST
from crowdtide.session import cut_lineage, use_utc
from crowdtide.sources.intake import broken_files, probe_parquet
from crowdtide.sources.read import path_exists, read_csv_typed, read_stored_posts
from crowdtide.sources.write import write_jsonl, write_table_copy


def run_merge_job(
    spark: SparkSession,
    parquet_root: str,
    jsonl_root: str,
    schema: T.StructType | None = STORED_POST,
    single_file: bool = False,
    report_root: str | None = None,
    deep: bool = False,
) -> dict:
    """Rows merged, files seen and the files that were skipped as broken; empty if there is
    nothing to merge. ``report_root`` gets the state of every file, ``deep`` looks into them."""
    use_utc(spark)
    if not path_exists(spark, parquet_root):
        return {}
    probed = cut_lineage(probe_parquet(spark, parquet_root, deep))
    if report_root:
        probed.write.mode("append").parquet(report_root)
    rows, merged = watch(read_stored_posts(spark, parquet_root, schema), "merged", rows=F.count("*"))
    write_jsonl(rows, jsonl_root, single_file)
    return {"rows": merged.get["rows"], **broken_files(probed)}


def run_table_copy(spark: SparkSession, csv_path: str, parquet_path: str):
    """CSV with guessed types to plain Parquet."""
    write_table_copy(read_csv_typed(spark, csv_path), parquet_path)
