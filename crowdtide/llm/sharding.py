"""Shards of near-equal bytes by sampled splitters.

Size-weighted samples of the key give quantile boundaries; records are assigned to the
ranges between them, ranges that hold too much are subdivided by boundaries of a second
sample, and runs of ranges make the shards. Inside the range that a shard's border
crosses, the border falls at a record: bytes before a record are the bytes of the ranges
before its own, plus a running sum in its range.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from crowdtide.llm.common import plain_text, stored, table

SHARDS = 40
RANGES_PER_SHARD = 64
SAMPLES_PER_RANGE = 16
ROWS_PER_RANGE = 1_000_000
OVERFULL = 2.0
ROUNDS = 4


def drawn(rows: DataFrame, rate, seed: int) -> DataFrame:
    """A sample in which a row stands with probability min(1, size * rate), by hash."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "key", "tie"), 11)).cast("double") / F.lit(float(1 << 53))
    return rows.filter(u < F.col("size") * rate)


def quantiles(sample: DataFrame, pieces: int) -> list:
    """``pieces - 1`` boundaries ``(key, tie)`` of a sample, whose size is bounded."""
    ordered = sample.select(F.row_number().over(Window.orderBy("key", "tie")).alias("i"), "key", "tie",
                            F.count(F.lit(1)).over(Window.partitionBy()).alias("n"))
    at = F.floor((F.col("i") - 1) * pieces / F.col("n"))
    before = F.floor((F.col("i") - 2) * pieces / F.col("n"))
    return [(r["key"], r["tie"]) for r in ordered.filter((F.col("i") > 1) & (at > before)).select("key", "tie").collect()]


def placed(rows: DataFrame, bounds: list) -> DataFrame:
    """Adds ``range``: how many boundaries are at or before the row, by binary search."""
    if not bounds:
        return rows.withColumn("range", F.lit(0))
    kind = rows.schema["key"].dataType.simpleString()
    # one constant, of bounded size, in the plan
    listed = F.from_json(F.lit(json.dumps([{"key": k, "tie": t} for k, t in bounds])), f"array<struct<key:{kind},tie:bigint>>")
    own = F.struct(F.col("key"), F.col("tie"))
    steps = [1 << b for b in reversed(range(len(bounds).bit_length()))]

    def search(found, step):
        here = F.get(listed, found + step - 1)
        return F.when(here.isNotNull() & (here <= own), found + step).otherwise(found)

    return rows.withColumn("range", F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), search))


def splitters(rows: DataFrame, n_shards: int) -> list:
    """Boundaries such that no range holds over ``OVERFULL`` times its share of bytes or
    rows, unless one record alone does. At most ``ROUNDS`` rounds; each boundary is a
    (key, tie) pair, so that rows of one hot key fall into several ranges.
    """
    total = rows.agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).first()
    if not total["n"]:
        return []
    n_ranges = max(n_shards * RANGES_PER_SHARD, -(-total["n"] // ROWS_PER_RANGE))
    rate = n_ranges * SAMPLES_PER_RANGE / total["size"]
    bounds = sorted(set(quantiles(drawn(rows, F.lit(rate), 0), n_ranges)))
    for round_ in range(1, ROUNDS):
        held = placed(rows, bounds).groupBy("range").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
        shares = F.greatest(F.col("bytes") * n_ranges / total["size"], F.col("n") * n_ranges / total["n"])
        over = held.filter((shares > OVERFULL) & (F.col("n") > 1)).select("range", "bytes", F.ceil(shares).alias("pieces"))
        # fewer than n_ranges ranges can hold over a share; their samples are as bounded
        crowded = placed(rows, bounds).join(F.broadcast(over), "range")
        rate = SAMPLES_PER_RANGE * F.col("pieces") / F.col("bytes")
        sample = drawn(crowded, rate, round_)
        at = Window.partitionBy("range").orderBy("key", "tie")
        i, n = F.row_number().over(at), F.count(F.lit(1)).over(Window.partitionBy("range"))
        cut = F.floor(i * F.col("pieces") / n) > F.floor((i - 1) * F.col("pieces") / n)
        more = {(r["key"], r["tie"]) for r in sample.select("key", "tie", cut.alias("cut")).filter("cut").select("key", "tie").collect()}
        if not more - set(bounds):
            break
        bounds = sorted(set(bounds) | more)
    return bounds


def shard(df: DataFrame, n_shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", key_col: str | None = None) -> DataFrame:
    """One row per row of ``df``: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    Records are in order of ``key_col`` (the id by default; a whole number or text); rows of one key are in order
    of a hash of id and text. Size is the UTF-8 bytes of the text, none if null, plus 16.
    Law ``bytes``: a record is in the shard in which its middle byte falls, so shards
    differ by less than two records. ``slot`` counts from 0 in each shard;
    ``grown_shard`` is null, as another count cuts anew. A null id or key is -1, the
    smallest. Rows alike in all read columns get slots in any order. With fewer bytes
    than shards some shards are empty; an empty table gives no rows.
    """
    text = plain_text(F.col(text_col)).cast("binary")
    rows = stored(df.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text).cast("long") + 16).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.coalesce(F.col(key_col or id_col), F.lit(-1).cast(df.schema[key_col or id_col].dataType)).alias("key"))
        .withColumn("tie", F.xxhash64("doc_id", "text_crc32", "size")), "keys")
    parts = stored(placed(rows, splitters(rows, n_shards)), "ranges")
    sums = parts.groupBy("range").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    run = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    sums = sums.select("range", F.coalesce(F.sum("bytes").over(run), F.lit(0)).alias("bytes_before"),
                       F.coalesce(F.sum("n").over(run), F.lit(0)).alias("rows_before"),
                       F.sum("bytes").over(Window.partitionBy()).alias("all_bytes"))
    inside = Window.partitionBy("range").orderBy("key", "tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = (parts.withColumn("upto", F.sum("size").over(inside)).withColumn("row", F.count(F.lit(1)).over(inside))
             .join(F.broadcast(sums), "range"))
    # the place of the middle byte, doubled to stay a whole number
    cut = F.expr(f"cast((2 * (bytes_before + upto) - size) * decimal({n_shards}) div (2 * all_bytes) as int)")
    parts = stored(parts.select("doc_id", "size", "text_crc32", cut.alias("shard"), (F.col("rows_before") + F.col("row") - 1).alias("place")), "placed")
    first = parts.groupBy("shard").agg(F.min("place").alias("first"))
    return parts.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("place") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))


# crc32 is not in DuckDB: its table comes from the rule, and the bytes are folded.
OP5_SQL = r"""
WITH crc AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS steps
  FROM (SELECT unnest(range(256)) AS i)),
d AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 16 AS size, regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS x FROM documents),
p AS (
  SELECT doc_id, size, xor(4294967295, list_reduce(
           list_prepend(4294967295, list_transform(x, lambda b: CAST('0x' || b AS BIGINT))),
           lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]))) AS text_crc32,
         CAST(sum(size) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto,
         CAST(sum(size) OVER () AS BIGINT) AS alls FROM d, crc),
s AS (SELECT *, CAST((2 * upto - size) * 40 // (2 * alls) AS INTEGER) AS shard FROM p)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM s
"""
