"""Row numbers, first rows and capped round-robin, without a one-task sort."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from crowdtide.fixed_values import BATCH_ROWS, CHUNK_ROWS, ROWS_PER_VISIT
from crowdtide.session import cut_lineage

CAP_SALTS = 64
#: Rows that a task sorts, and bytes of them.
SLICE_ROWS = 1_000_000
SLICE_BYTES = 32 << 20
#: Chunk borders, of 8 bytes, that are sent to every task.
SENT_BORDERS = 1_000_000


def with_row_index(
    df: DataFrame,
    order_by: str,
    ties: Sequence[str] = (),
    name: str = "row_index",
    slices: int | None = None,
    slice_by: Column | None = None,
) -> DataFrame:
    """Number rows 0, 1, 2, ... in the order of a column, then of ``ties``.

    The rows are cut into sorted slices, see ``sorted_slices``, and each slice is shifted
    by the sizes of those before it. With ``slice_by``, any column that never falls as
    ``order_by`` rises, its values are the slices; they have to be small. Rows alike in
    all of the order are numbered in some order.
    """
    if slice_by is None:
        placed = sorted_slices(df, [order_by, *ties], slices)
        return _numbered(placed, name, ["_slice", "_part"]).drop("_slice", "_part")
    sliced = df.withColumn("_slice", slice_by)
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy("_slice")
        .agg(F.count("*").alias("_size"))
        .select("_slice", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy("_slice").orderBy(order_by, *ties)
    return (
        sliced.join(offsets, "_slice")
        .withColumn(name, F.col("_offset") + F.row_number().over(inside) - 1)
        .drop("_slice", "_offset")
    )


def row_bytes(df: DataFrame) -> Column:
    """About the bytes of a row: texts as they are, nested values as JSON, eight for any other."""
    size = F.lit(0).cast("long")
    for field in df.schema:
        kind, column = field.dataType.simpleString(), F.col(f"`{field.name}`")
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(column), F.lit(0))
        elif kind.startswith(("array", "map", "struct")):
            size = size + F.coalesce(F.octet_length(F.to_json(column)), F.lit(0))
        size = size + 8
    return size


def sorted_slices(
    df: DataFrame,
    order: Sequence[str],
    slices: int | None = None,
    slice_rows: int = SLICE_ROWS,
    slice_bytes: int | None = None,
) -> DataFrame:
    """``df`` in sorted partitions that follow each other, written; adds ``_slice`` and ``_part``.

    Spark draws the splitters from a sample of the whole order and, behind it, a hash of
    the row and its place: rows alike in the order can be told apart, so that a key with
    half of the rows is cut like any other. There are as many slices as the rows need,
    ``slice_rows`` each and ``slice_bytes`` (``SLICE_BYTES``) of wide ones. A slice that the
    sample left with over twice its share of rows or bytes is cut again, into the parts that
    it needs.
    """
    slice_bytes = slice_bytes or SLICE_BYTES
    total, size = df.agg(F.count("*"), F.coalesce(F.sum(row_bytes(df)), F.lit(0))).first()
    slices = slices or max(1, math.ceil(total / slice_rows), math.ceil(size / slice_bytes))
    share, share_bytes = max(1, math.ceil(total / slices)), max(slice_bytes, math.ceil(size / slices))
    told = ["_tie", "_at"]
    tied = df.withColumn("_tie", F.xxhash64(*df.columns)).withColumn("_at", F.monotonically_increasing_id())

    def cut(rows, n, by):
        return rows.repartitionByRange(n, *by, *told).sortWithinPartitions(*by, *told)

    placed = cut(tied, slices, order).withColumn("_slice", F.spark_partition_id()).withColumn("_part", F.lit(0))
    placed = cut_lineage(placed)
    sizes = placed.groupBy("_slice").agg(F.count("*").alias("_rows"), F.sum(row_bytes(df)).alias("_bytes"))
    sizes = sizes.filter((F.col("_rows") > 2 * share) | (F.col("_bytes") > 2 * share_bytes)).collect()  # not all of the slices
    if sizes:
        over = F.col("_slice").isin([r["_slice"] for r in sizes])
        parts = sum(max(math.ceil(r["_rows"] / share), math.ceil(r["_bytes"] / share_bytes)) for r in sizes)
        again = cut(placed.filter(over), parts, ["_slice", *order]).withColumn("_part", F.spark_partition_id())
        placed = placed.filter(~over).unionByName(cut_lineage(again))
    return placed.drop(*told)


def with_read_index(df: DataFrame, name: str = "row_index") -> DataFrame:
    """Number rows 0, 1, 2, ... in the order they are read, without moving them.

    A row's place in its task is known where it stands; what is added is the size
    of the tasks before, one number per input partition. ``df`` is read twice and
    has to come in the same pieces both times, as files and checkpoints do.
    """
    return _numbered(df, name, [])


def _numbered(df: DataFrame, name: str, order: Sequence[str]) -> DataFrame:
    """Rows numbered by task, tasks in the order of columns that are constant in each, then as read."""
    placed = df.withColumn("_mark", F.monotonically_increasing_id()).withColumn(
        "_piece", F.shiftright("_mark", 33)
    )
    before = Window.orderBy(*order, "_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(*order, "_piece")
        .agg(F.count("*").alias("_size"))
        .select("_piece", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    place = F.col("_mark").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.join(F.broadcast(offsets), "_piece")
        .withColumn(name, F.col("_offset") + place)
        .drop("_mark", "_piece", "_offset")
    )


def read_chunks(df: DataFrame, size: int = CHUNK_ROWS, name: str = "chunk_id") -> DataFrame:
    """Number consecutive groups of ``size`` rows from 1, in the order they are read."""
    return (
        with_read_index(df)
        .withColumn(name, F.floor(F.col("row_index") / size) + 1)
        .drop("row_index")
    )


def chunk_numbers(
    df: DataFrame,
    order_by: str,
    size: int = CHUNK_ROWS,
    name: str = "chunk_id",
    ties: Sequence[str] = (),
) -> DataFrame:
    """Number consecutive groups of ``size`` rows from 1."""
    indexed = with_row_index(df, order_by, ties)
    return indexed.withColumn(name, F.floor(F.col("row_index") / size) + 1).drop("row_index")


def with_chunks(
    df: DataFrame, key: str, size: int = CHUNK_ROWS, name: str = "chunk_id", sent_borders: int = SENT_BORDERS
) -> DataFrame:
    """Chunk numbers in the order of a unique numeric key, for wide rows.

    The keys are numbered alone. The first keys of the chunks, one in ``size``, are looked
    up in each row where it stands, so that nothing wide moves. Only where there are more
    than ``sent_borders``, or keys that a double does not hold, are the numbers joined back.
    """
    indexed = with_row_index(df.select(key), key)
    ends = indexed.agg(F.count("*").alias("n"), F.max(F.abs(key)).alias("most")).first()
    if ends["n"] > size * sent_borders or (ends["most"] or 0) >= 2**53:
        numbers = indexed.select(key, (F.floor(F.col("row_index") / size) + 1).alias(name))
        return df.join(numbers, key)
    firsts = indexed.filter((F.col("row_index") % size == 0) & (F.col("row_index") > 0)).select(key).collect()
    borders = [float("-inf"), *sorted(float(r[0]) for r in firsts), float("inf")]
    placed = Bucketizer(splits=borders if firsts else [float("-inf"), 0.0, float("inf")], inputCol=key, outputCol="_bucket").transform(df)
    chunk = (F.col("_bucket") + 1).cast("long") if firsts else F.lit(1).cast("long")
    return placed.withColumn(name, chunk).drop("_bucket")


def chunk_rows(df: DataFrame, chunk: str = "chunk_id", size: int = CHUNK_ROWS) -> Column:
    """Rows in a numbered chunk: ``size``, but for the last. Needs no grouping."""
    total = df.agg(F.count("*")).scalar()
    return F.least(F.lit(size), total - (F.col(chunk) - 1) * size)


def batch_numbers(df: DataFrame, order_by: str, size: int = BATCH_ROWS) -> DataFrame:
    return chunk_numbers(df, order_by, size, "batch_id")


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The first row of each key, as an aggregate.

    Unlike a window over the key this keeps one row per key and map task before
    the shuffle, so a key with most of the rows costs no more than another.
    """
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order_by)).alias("_first")
    return df.groupBy(*keys).agg(first).select(*[
        F.col(c) if c in keys else F.col("_first")[c].alias(c) for c in df.columns
    ])


def last_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The last row of each key, as an aggregate."""
    rest = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order_by)).alias("_last")
    return df.groupBy(*keys).agg(last).select(*[
        F.col(c) if c in keys else F.col("_last")[c].alias(c) for c in df.columns
    ])


def round_robin_cap(
    df: DataFrame,
    tag: str,
    order_by: str,
    tag_order: str | None = None,
    per_visit: int = ROWS_PER_VISIT,
    *,
    cap: int,
) -> DataFrame:
    """Take ``per_visit`` rows of each tag in turn until ``cap`` rows are taken.

    A row beyond its tag's first ``cap`` can never be reached, so tags are cut to
    that many first: in salted parts, then as a whole. The cap is the feature.
    """
    salt = F.pmod(F.xxhash64(order_by), F.lit(CAP_SALTS))
    part = Window.partitionBy(tag, "_salt").orderBy(order_by)
    whole = Window.partitionBy(tag).orderBy(order_by)
    ranked = (
        df.withColumn("_salt", salt)
        .withColumn("_rank", F.row_number().over(part))
        .filter(F.col("_rank") <= cap)
        .withColumn("tag_rank", F.row_number().over(whole))
        .filter(F.col("tag_rank") <= cap)
        .drop("_salt", "_rank")
        .withColumn("visit", F.ceil(F.col("tag_rank") / per_visit))
    )
    return ranked.orderBy("visit", F.col(tag_order or tag).asc_nulls_last(), tag, "tag_rank").limit(cap)
