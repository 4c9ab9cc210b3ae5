"""Mixing sources to target weights by hash-threshold histograms.

A source that is to give T words out of S gives each document floor(T / S) times and
once more those documents whose hash lies under a threshold. The threshold is found by
histograms: words are summed by source and leading hash digit, the bucket in which the
running sum passes the budget is the boundary bucket, and only its documents are summed
again by the next digit. No level sorts or collects documents, a source of any size is
summed before the shuffle, and a smaller budget takes a part of what a larger one takes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from crowdtide.llm.common import WORD, plain_text, stored, table

BITS = 10  # of a digit: 1024 buckets for each source and level
LEVELS = 5  # 50 bits of hash
WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MOST = 2.0


def hash_point(doc_id):
    """50 bits from MD5 of the id as text."""
    hexed = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 13)
    return F.shiftright(F.conv(hexed, 16, 10).cast("long"), 2)


def word_count(text):
    return F.regexp_count(plain_text(text), F.lit(WORD)).cast("long")


def targets(sources: DataFrame, weights=WEIGHTS, budget: float = BUDGET, most: float = MOST) -> DataFrame:
    """Adds ``target`` to ``source, source_size``, one row per source.

    Sources in code point order, null last, get the weights in turn. Resharing what is
    above ``most`` times a source's size until none is above ends at
    target = min(most * size, level * weight) with one level for all sources: the sources
    are put in order of the level at which they fill up, and running sums give the level.
    The windows have no partition: they hold one row per source.
    """
    place = Window.orderBy(F.col("source").isNull(), F.col("source"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.row_number().over(place) - 1, F.lit(len(weights))) + 1)
    whole, fill = Window.partitionBy(), Window.orderBy("full_at", "place")
    up_to = fill.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = sources.withColumn("weight", weight).withColumn("place", F.row_number().over(place))
    t = (t.withColumn("room", F.col("source_size") * F.lit(float(most)))
         .withColumn("full_at", F.col("room") / F.col("weight"))
         .withColumn("all", F.least(F.sum("source_size").over(whole) * F.lit(float(budget)), F.sum("room").over(whole)))
         .withColumn("filled", F.sum("room").over(up_to) - F.col("room"))
         .withColumn("open", F.sum("weight").over(whole) - F.sum("weight").over(up_to) + F.col("weight"))
         .withColumn("level", (F.col("all") - F.col("filled")) / F.col("open")))
    # the first source, in that order, that does not fill up sets the level for the rest
    t = t.withColumn("level", F.max(F.when(F.col("full_at") > F.col("level"), F.col("level"))).over(whole))
    return t.select("source", "source_size", F.least("room", F.coalesce(F.col("level") * F.col("weight"), F.col("room"))).alias("target"))


def sized(df: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return stored(
        df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"),
                  word_count(F.col(text_col)).alias("size"), hash_point(F.col(id_col)).alias("point")), "sizes")


def thresholds(rows: DataFrame, weights=WEIGHTS, budget: float = BUDGET, most: float = MOST) -> DataFrame:
    """``source, source_size, target, times, cut`` for rows of ``source, size, point``.

    Every row of a source is taken ``times`` times, those with ``point < cut`` once more.
    """
    sources = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, budget, most)
    times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    goal = sources.withColumn("times", times.cast("long"))
    goal = goal.withColumn("rest", F.col("target") - F.col("times") * F.col("source_size"))
    goal = stored(goal.withColumn("prefix", F.lit(0).cast("long")), "goal")
    for level in range(1, LEVELS + 1):
        goal = stored(next_digit(rows, goal, level), "goal")
    return goal.select("source", "source_size", "target", "times", F.col("prefix").alias("cut"))


def copies(point, times, cut):
    return times + (point < cut).cast("long")


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """One row per row of ``df``: ``doc_id, source, size, source_size, target, taken``.

    ``taken`` is the words the mix takes from the row: its size times the number of times
    it is taken, which is at most ``most`` rounded up. A null or empty text has size 0; a
    source without words has target 0; a null source is a source, a null id hashes as the
    empty text. Rows with one hash (repeated ids) are taken or left together. The row at
    the threshold is taken if that brings the source nearer to its target. ``how``:
    ``weights, budget, most``. An empty table gives no rows.
    """
    rows = sized(df, id_col, text_col, source_col)
    goal = thresholds(rows, **how).withColumnRenamed("source", "s")
    return rows.join(goal, rows["source"].eqNullSafe(goal["s"])).select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("size") * copies(F.col("point"), F.col("times"), F.col("cut"))).alias("taken"))


def mixed_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The mix itself: the rows of ``df``, all columns, each as often as the mix takes it.

    Whether a row is taken depends on its source and its id's hash alone: one threshold
    for each source is joined to the wide rows, which are not shuffled for it. A row
    without words is taken like any other of its source.
    """
    goal = thresholds(sized(df, id_col, text_col, source_col), **how).select(
        F.col("source").alias("__source"), F.col("times").alias("__times"), F.col("cut").alias("__cut"))
    found = df.join(goal, df[source_col].eqNullSafe(goal["__source"]))
    number = copies(hash_point(F.col(id_col)), F.col("__times"), F.col("__cut")).cast("int")
    return found.select(*df.columns, F.explode(F.array_repeat(F.lit(0), number)).alias("__copy")).drop("__copy")


def next_digit(rows: DataFrame, goal: DataFrame, level: int) -> DataFrame:
    """The threshold of each source to ``level`` digits.

    ``prefix`` holds the leading digits of the boundary bucket, ``rest`` the budget left
    when all buckets below are taken. Only rows of the boundary bucket are summed. At the
    last level ``prefix`` becomes the threshold itself: points below it are taken.
    """
    shift, last = BITS * (LEVELS - level), level == LEVELS
    g = goal.select(F.col("source").alias("s"), "rest", "prefix")
    inside = rows.join(g, rows["source"].eqNullSafe(g["s"]) & (F.shiftright("point", shift + BITS) == F.col("prefix")))
    sums = inside.groupBy("source", F.shiftright("point", shift).alias("digit")).agg(
        F.sum("size").alias("words"), F.first("rest").alias("budget"))
    run = Window.partitionBy("source").orderBy("digit")
    sums = sums.withColumn("before", F.sum("words").over(run) - F.col("words"))
    if last:
        # of the bucket at the boundary, the nearer of leaving and taking it
        taken = F.col("before") + F.col("words") / 2.0 <= F.col("budget")
        cut = sums.groupBy("source").agg(
            F.max(F.when(taken & (F.col("words") > 0), F.col("digit") + 1)).alias("cut"), F.lit(0.0).alias("used"))
    else:
        # buckets that end within the budget are below the boundary
        below = F.col("before") + F.col("words") <= F.col("budget")
        cut = sums.groupBy("source").agg(
            F.min(F.when(~below, F.col("digit"))).alias("cut"),
            F.sum(F.when(below, F.col("words")).otherwise(0)).cast("double").alias("used"))
    # no bucket passes the budget: the boundary lies in an empty one behind the last
    none = F.shiftleft(F.col("prefix"), BITS) + (0 if last else (1 << BITS) - 1)
    cut = cut.withColumnRenamed("source", "s")
    return goal.join(cut, goal["source"].eqNullSafe(cut["s"]), "left").select(
        "source", "source_size", "target", "times",
        (F.col("rest") - F.coalesce("used", F.lit(0.0))).alias("rest"), F.coalesce("cut", none).alias("prefix"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 13) AS BIGINT) >> 2 AS point
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS place,
         CAST([5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight,
         source_size * 2.0::DOUBLE AS room
  FROM s),
f AS (
  SELECT *, room / weight AS full_at, least(sum(source_size) OVER () * 1.5::DOUBLE, sum(room) OVER ()) AS alls,
         sum(room) OVER o - room AS filled, sum(weight) OVER () - sum(weight) OVER o + weight AS open
  FROM w WINDOW o AS (ORDER BY room / weight, place ROWS UNBOUNDED PRECEDING)),
t AS (
  SELECT source, source_size,
         least(room, coalesce(max(CASE WHEN full_at > (alls - filled) / open THEN (alls - filled) / open END) OVER () * weight, room)) AS target
  FROM f),
r AS (
  SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS times,
         CAST(sum(size) OVER (PARTITION BY d.source ORDER BY point) AS BIGINT) AS upto, sum(size) OVER (PARTITION BY d.source, point) AS here
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (times + CASE WHEN upto - here / 2.0 <= target - times * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r
"""
