"""What was skipped: damaged lines set aside and counted, broken files named.

Counters are observed while the lines pass, in a batch as an ``Observation`` and in a stream
as ``observedMetrics`` of its progress. Damaged lines go to a quarantine table with the file
they stood in, so that they can be mended and read again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from crowdtide.functions.text import strip
from crowdtide.operators.summary import watch
from crowdtide.schemas import JSON_POST
from crowdtide.sources.read import CORRUPT, parse_json_lines

COUNTERS = ("lines_read", "blank_lines", "malformed_lines")
FILES_PER_TASK = 64
NAMED_FILES = 100  # of broken files in a job's result; the table has all


def line_counters() -> dict[str, Column]:
    """Counters over lines whose parsed form is in ``_line``; see :func:`observed_lines`."""
    blank = F.col("_line") == "blank"
    return dict(zip(COUNTERS, (F.count(F.lit(1)), F.count_if(blank), F.count_if(F.col("_line") == "bad"))))


def judged_lines(lines: DataFrame, schema: T.StructType = JSON_POST, keep=()) -> DataFrame:
    """Parsed lines with ``_line``: ``good``, ``bad`` or ``blank``. No line is dropped."""
    # parsing drops blank lines, so they pass as null objects that are told by their text
    blank = strip(F.col("value")) == ""
    marked = lines.withColumn("_blank", blank).withColumn("value", F.when(blank, F.lit("{}")).otherwise(F.col("value")))
    parsed = parse_json_lines(marked, schema, [*keep, "_blank"])
    kind = F.when(F.col("_blank"), "blank").when(F.col(CORRUPT).isNotNull(), "bad").otherwise("good")
    return parsed.withColumn("_line", kind).drop("_blank")


def observed_lines(lines: DataFrame, name: str, schema: T.StructType = JSON_POST, keep=()) -> DataFrame:
    """The same for a stream: the counters are in its progress under ``name``."""
    return judged_lines(lines, schema, keep).observe(name, *[c.alias(k) for k, c in line_counters().items()])


def good_lines(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("_line") == "good").drop("_line", CORRUPT)


def bad_lines(judged: DataFrame) -> DataFrame:
    """``value`` and ``file_path`` of damaged lines."""
    return judged.filter(F.col("_line") == "bad").select(F.col(CORRUPT).alias("value"), F.col("_file").alias("file_path"))


@dataclass(frozen=True)
class Intake:
    """Good rows of JSON-lines files, the counters of their lines and where the bad ones are."""

    posts: DataFrame
    counters: dict[str, int]
    quarantine: str


def read_jsonl_setting_aside(
    spark: SparkSession,
    path: str | list[str],
    quarantine: str,
    schema: T.StructType = JSON_POST,
    positions: bool = False,
) -> Intake:
    """JSON lines; the damaged ones are appended to the table ``quarantine``, one pass that
    counts as well. The good rows are read when they are used. With ``positions`` they
    have ``_file`` and ``_pos``, their file and their order in it."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_pos"))
    judged = judged_lines(lines, schema, ("_file", "_pos"))
    watched, counted = watch(judged, "intake", **line_counters())
    bad_lines(watched).withColumn("set_aside_at", F.current_timestamp()).write.mode("append").parquet(quarantine)
    posts = good_lines(judged)
    return Intake(posts if positions else posts.drop("_file", "_pos"), {k: counted.get[k] for k in COUNTERS}, quarantine)


def _probe(deep: bool):
    """Rows of each file by its footer, or what is wrong with it."""

    def run(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        for batch in batches:
            rows, problems = [], []
            for path in batch.column("file_path").to_pylist():
                count, problem = None, None
                try:
                    system, place = fs.FileSystem.from_uri(path)
                except (ValueError, OSError) as error:
                    system, problem = None, f"not probed: {error}"
                if system is not None:
                    try:
                        with system.open_input_file(place) as file:
                            table = pq.ParquetFile(file)
                            count = table.metadata.num_rows
                            if deep:
                                for _ in table.iter_batches():
                                    pass
                    except (pa.ArrowException, OSError) as error:
                        problem = f"unreadable: {str(error)[:200]}"
                rows.append(count)
                problems.append(problem)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rows, pa.int64()), pa.array(problems, pa.string())],
                ["file_path", "bytes", "rows", "problem"])

    return run


def probe_parquet(spark: SparkSession, root: str, deep: bool = False) -> DataFrame:
    """``file_path, bytes, rows, problem`` of every file a reader of ``root`` would take.

    Footers are read, in many tasks; with ``deep`` every page too, which finds files that are
    damaged inside. ``problem`` is null for a sound file.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
        .select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("bytes"))
    )
    tasks = max(1, -(-files.count() // FILES_PER_TASK))
    return files.repartition(tasks, "file_path").mapInArrow(_probe(deep), "file_path string, bytes long, rows long, problem string")


def broken_files(probed: DataFrame) -> dict:
    """What a job reports of a probe: files, those with a problem, and the first names of these."""
    problem = F.col("problem").isNotNull()
    counts = probed.agg(F.count(F.lit(1)).alias("files"), F.count_if(problem).alias("broken")).first()
    named = probed.filter(problem).orderBy("file_path").limit(NAMED_FILES).collect()
    return {"files": counts["files"], "broken_files": counts["broken"], "broken_names": [r["file_path"] for r in named]}
