"""Readers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from crowdtide.fixed_values import INPUT_FILES, KEYWORDS
from crowdtide.functions.text import strip
from crowdtide.operators.scoring import row_ids
from crowdtide.schemas import FEATURE, JSON_POST, RAW_POST, SEEN_HASH, STORED_POST
from crowdtide.sources.csv_records import read_csv_records

CORRUPT = "_corrupt_record"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or pattern names anything, on whatever file system it is."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    found = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(
        hadoop_path
    )
    return found is not None and len(found) > 0


def read_raw_posts(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Post CSV, every value a string under its header; a missing file gives no rows.

    Values may hold line ends; files are split all the same, see ``csv_records``, at the
    cost of a second pass. Files of one line a record, which need none, can be read with
    ``multiline`` off.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], RAW_POST)
    if multiline:
        rows = read_csv_records(spark, path)
        return rows if rows.columns else spark.createDataFrame([], RAW_POST)
    rows = (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("enforceSchema", False)  # files whose headers differ are an error
        .csv(path)
    )
    return rows if rows.columns else spark.createDataFrame([], RAW_POST)


def read_csv_typed(spark: SparkSession, path: str) -> DataFrame:
    """CSV with header and types guessed from the data, which costs a second pass."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def parse_json_lines(
    lines: DataFrame, schema: T.StructType = JSON_POST, keep: Sequence[str] = ()
) -> DataFrame:
    """Lines in ``value`` to columns; what is not one JSON object keeps its text in
    ``_corrupt_record``. Blank lines go."""
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    text = strip(F.col("value"))
    # an array line would come back as a row of its first object
    parsed = F.from_json(F.when(text.startswith("{"), text), with_corrupt, options)
    return (
        lines.filter(text != "")
        .select(*keep, parsed.alias("_j"), "value")
        .select(
            *keep,
            *[F.col("_j")[f.name].alias(f.name) for f in schema.fields],
            F.when(F.col("_j").isNull(), F.col("value")).otherwise(F.col("_j")[CORRUPT]).alias(CORRUPT),
        )
    )


def read_jsonl(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = JSON_POST,
    quarantine: bool = False,
) -> DataFrame:
    """JSON lines, one object each; blank and malformed lines are skipped, or with
    ``quarantine`` kept with their text in ``_corrupt_record``."""
    rows = parse_json_lines(spark.read.text(path), schema)
    return rows if quarantine else rows.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def read_stored_posts(
    spark: SparkSession, root: str, schema: T.StructType | None = STORED_POST
) -> DataFrame:
    """Day-partitioned post files; unreadable files are skipped.

    With ``schema=None`` the files' own columns are merged, for unlike files.
    The day stays a string, also where every folder looks like a date.
    """
    reader = spark.read.option("ignoreCorruptFiles", True)
    if schema is not None:
        return reader.schema(schema).parquet(root)
    merged = reader.option("mergeSchema", True).parquet(root)
    return merged.withColumn("event_date", F.col("event_date").cast("string"))


def read_features(spark: SparkSession, root: str) -> DataFrame:
    """Feature rows; one without id is named after its file and its number in the file,
    which stay the same however the file is split.

    A table without ids and embeddings is refused.
    """
    table = spark.read.parquet(root)
    missing = {"id", "embedding"} - set(table.columns)
    if missing:
        raise ValueError(f"{root} lacks the feature columns {sorted(missing)}")
    known = [f for f in FEATURE.fields if f.name in table.columns]
    extra = [c for c in table.columns if c not in FEATURE.names]
    typed = table.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in known],
        *extra,
        F.col("_metadata.file_name").alias("_file"),
        F.col("_metadata.row_index").alias("_place"),
    )
    return row_ids(typed, F.col("_file"), F.col("_place")).drop("_file", "_place")


def read_seen(spark: SparkSession, root: str) -> DataFrame:
    if not path_exists(spark, root):
        return spark.createDataFrame([], SEEN_HASH)
    return spark.read.schema(SEEN_HASH).parquet(root)


def pending_files(spark: SparkSession, folder: str, pattern: str = INPUT_FILES) -> DataFrame:
    """Dry run: the input files a feature run would take, plain batches first."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .load(folder)
        .select(F.col("_metadata.file_path").alias("file_path"))
    )
    name = F.element_at(F.split("file_path", "/"), -1)
    return files.orderBy(F.when(name.startswith("batch_"), 0).otherwise(1), "file_path")


def keyword_dimension(spark: SparkSession, keywords: Sequence[str] = KEYWORDS) -> DataFrame:
    """Keywords with their place in the visiting order."""
    return spark.createDataFrame(
        [(tag, i) for i, tag in enumerate(keywords)], "source_hashtag string, tag_index int"
    )
