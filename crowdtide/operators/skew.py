"""Equi-join that stays balanced when a few keys hold most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from crowdtide.session import cut_lineage

HOT_SHARE = 10_000
HOT_ROWS = 1_000_000


def heavy_keys(
    counts: DataFrame, count_col: str, share: int = HOT_SHARE, min_rows: int = HOT_ROWS
) -> DataFrame:
    """Keys holding more than ``1/share`` of all rows, and more than ``min_rows``.

    Fewer than ``share`` keys can do that, whatever the data, so the result is
    safe to broadcast; every other key is at most ``1/share`` of the rows.
    """
    total = counts.agg(F.sum(count_col)).scalar()
    limit = F.greatest(total / F.lit(share), F.lit(min_rows))
    return counts.filter(F.col(count_col) > limit)


def _salt(df: DataFrame, salts: Column) -> Column:
    # Depends on the row and on where it was read, not on the order of rows, so
    # a re-run task gives the same salts; equal copies differ by partition.
    return F.pmod(F.xxhash64(F.spark_partition_id(), *df.columns), salts).cast("int")


def heavy_cells(
    left: DataFrame, right: DataFrame | None, on: Sequence[str], share: int = HOT_SHARE, min_rows: int = HOT_ROWS
) -> DataFrame:
    """Keys heavy on either side, with the cells each side's rows are split into.

    One count over both sides, written: at most ``2 * share`` rows, null keys among them.
    Without ``right`` a key has one row there at most.
    """
    def counted(side, l_rows, r_rows):
        return side.select(*on, F.lit(l_rows).cast("long").alias("_left"), F.lit(r_rows).cast("long").alias("_right"))

    rows = counted(left, 1, 0)
    if right is not None:
        rows = rows.unionByName(counted(right, 0, 1))
    counts = rows.groupBy(*on).agg(F.sum("_left").alias("_left"), F.sum("_right").alias("_right"))
    totals = counts.agg(F.struct(F.sum("_left").alias("l"), F.sum("_right").alias("r"))).scalar()

    def limit(total):
        return F.greatest(total / F.lit(share), F.lit(min_rows))

    def cells(name):
        return F.greatest(F.ceil(F.col(name) / F.lit(max(min_rows, 1))), F.lit(1)).cast("int")

    heavy = counts.filter((F.col("_left") > limit(totals["l"])) | (F.col("_right") > limit(totals["r"])))
    return cut_lineage(heavy.select(*on, cells("_left").alias("_rows"), cells("_right").alias("_columns")))


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    share: int = HOT_SHARE,
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join by equality on ``on``: ``inner``, ``left``, ``left_semi`` or ``left_anti``.

    One join on the key and a cell. A key that is heavy on a side has that side's rows dealt
    into cells of about ``min_rows``, and the other side's rows copied to each: a grid, in
    which each pair of rows meets in exactly one cell. All other keys have one cell. For
    semi and anti the right side is its distinct keys, so that no left row is copied. Null
    keys match nothing; where their rows stay they are dealt like those of any heavy key.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type: {how}")
    on = list(on)
    has_key = F.lit(True)
    for name in on:
        has_key = has_key & F.col(name).isNotNull()
    right = right.filter(has_key)
    filtering = how in ("left_semi", "left_anti")
    if how in ("inner", "left_semi"):
        left = left.filter(has_key)
    if filtering:
        right = right.select(*on).distinct()
    heavy = heavy_cells(left, None if filtering else right, on, share, min_rows)
    sent = F.broadcast(heavy.withColumnsRenamed({name: f"_key_{i}" for i, name in enumerate(on)}))

    def placed(side):
        same = F.lit(True)
        for i, name in enumerate(on):
            same = same & side[name].eqNullSafe(sent[f"_key_{i}"])
        return side.join(sent, same, "left").drop(*[f"_key_{i}" for i in range(len(on))])

    def dealt(side, cells):
        return F.when(F.col(cells) > 1, _salt(side, F.col(cells))).otherwise(0)

    def copied(cells):
        return F.explode(F.sequence(F.lit(0), F.coalesce(F.col(cells), F.lit(1)) - 1))

    cell = [*on, "_row", "_column"]
    far = placed(right).withColumn("_row", copied("_rows")).withColumn("_column", dealt(right, "_columns"))
    near = placed(left).withColumn("_row", dealt(left, "_rows"))
    if filtering:
        near = near.withColumn("_column", F.lit(0))
        return near.select(*left.columns, "_row", "_column").join(far.select(*cell), cell, how).select(*left.columns)
    near = near.withColumn("_split", F.coalesce(F.col("_columns"), F.lit(1)) > 1).withColumn("_column", copied("_columns"))
    rest = [c for c in right.columns if c not in on]
    joined = near.select(*left.columns, "_split", "_row", "_column").join(
        far.select(*cell, *rest, F.lit(True).alias("_met")), cell, how)
    if how == "left":
        # a copy whose cell has no row of a key that other cells have
        joined = joined.filter(F.col("_met") | ~F.col("_split"))
    return joined.select(*on, *[c for c in left.columns if c not in on], *rest)
