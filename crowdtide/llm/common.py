"""Helpers of the operators in this folder."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The separators of every word contract: space, tab, line feed to carriage return.
SPACES = r"[\x20\x09-\x0D]+"
BITS = 1 << 21  # of a bitmap: 256 KB
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as ``spark.checkpoint.dir`` names it.

    Only where no folder is named, as in tests, ``/tmp/checkpoints`` of the default
    file system is used.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or "/tmp/checkpoints").rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read from there after.

    A lost executor then costs a read, and passes over the rows agree on what is in
    them. The files stay until the folder is cleared.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(df: DataFrame, rows: int = 1000) -> DataFrame:
    """``df``, with texts going to Python workers in batches of ``rows`` at most.

    A worker holds a batch of texts several times over, and there are several workers beside
    an executor's heap. The setting is the session's and stays.
    """
    key, conf = "spark.sql.execution.arrow.maxRecordsPerBatch", df.sparkSession.conf
    if not 0 < int(conf.get(key)) <= rows:
        conf.set(key, str(rows))
    return df


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no such column."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def release() -> None:
    """Gives back to the system what Arrow and malloc hold for later: a worker outlives its
    task, and would keep the most that it ever needed."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def lean(run):
    """A function over Arrow batches that leaves no memory behind when its task ends."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls into the fold that is kept from learning."""
    remainder = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds
    return remainder == fold


def plain_text(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def _slot(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BITS))


def bitmap(keys: DataFrame) -> Column:
    """A constant array of longs with the bits of all ``key`` values set; ``BITS`` in all."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(_slot(F.col("key")), F.lit(64)).cast("int"))
    rows = keys.groupBy(F.shiftright(_slot(F.col("key")), 6).cast("int").alias("i")).agg(F.bit_or(bit).alias("b")).collect()
    out = [0] * (BITS // 64)
    for row in rows:
        out[row["i"]] = row["b"]
    return F.from_json(F.lit(str(out)), "array<bigint>")


def maybe_in(bits: Column, key: Column) -> Column:
    """False only for keys that are surely not in the bitmap."""
    word = F.get(bits, F.shiftright(_slot(key), 6).cast("int"))
    bit = F.call_function("shiftright", word, F.pmod(_slot(key), F.lit(64)).cast("int"))
    return bit.bitwiseAND(F.lit(1).cast("long")) == 1
