"""Exact deduplication against a persistent digest index.

The index is a Parquet table in a folder, bucketed and sorted by the SHA-256 digest of
the normalised text. New rows are grouped by digest, joined against the index by
sort-merge anti-join (the index side is read bucket by bucket, without a shuffle) and
the digests that are new are appended.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from crowdtide.llm.common import SPACES, plain_text, shared_folder, stored, table, unused

BUCKETS = 64


def digest(text):
    """SHA-256 of the text with each run of white space as one space; null is empty."""
    return F.unhex(F.sha2(F.regexp_replace(plain_text(text), SPACES, " ").cast("binary"), 256))


class DigestIndex:
    """Digests seen so far: ``digest binary, keep_id long, batch string``, one row per digest.

    ``path`` is a folder on shared storage; a later session opens the same folder and
    goes on. ``buckets`` is fixed when the folder is made and must be given alike later:
    choose it so that one bucket of digests (40 bytes each) sorts in a task's memory.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.buckets = spark, buckets
        self.name = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.name} (digest BINARY, keep_id BIGINT, batch STRING) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, groups: DataFrame, batch: str) -> None:
        """Each bucket is written by one task, as one sorted file. What an earlier try of the
        batch has put there stays as it is."""
        mine = self.rows().filter(F.col("batch") == batch)
        if not mine.isEmpty():
            groups = groups.join(mine.select("digest"), "digest", "left_anti")
        (groups.select("digest", "keep_id", F.lit(batch).alias("batch")).repartition(self.buckets, "digest")
         .write.mode("append").format("parquet")
         .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.name))
        self.spark.catalog.refreshTable(self.name)

    def deduplicate(self, df: DataFrame, id_col: str = "doc_id", text_col: str = "text", batch: str | None = None) -> DataFrame:
        """Add a batch; one row per row of ``df``: ``doc_id, keep_id, group_size, kept, digest``.

        ``keep_id`` is the id in the index if the text was there before, else the smallest
        id of the batch, ``group_size`` the rows of the batch with that text. ``kept`` is
        true for one row of each text that is new. Null text is the empty text; a null id
        counts as larger than any other; of rows that repeat id and text one is kept.
        Other columns are not read. An empty batch gives no rows. A batch run again under its
        name, as after a lost driver, is held against the other batches alone and gives the
        same answer; without a name each call is a batch of its own.
        """
        batch = batch or uuid.uuid4().hex
        earlier = self.rows().filter(F.col("batch") != batch)
        rows = stored(
            df.select(F.col(id_col).cast("long").alias("doc_id"), digest(F.col(text_col)).alias("digest"),
                      F.monotonically_increasing_id().alias("pos")), "digests")
        first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "pos"))
        groups = stored(
            rows.groupBy("digest").agg(first.alias("first"), F.count(F.lit(1)).alias("group_size")), "groups")
        groups = groups.select("digest", "group_size", F.col("first.doc_id").alias("keep_id"), F.col("first.pos").alias("first_pos"))
        fresh = groups.hint("merge").join(earlier.select("digest"), "digest", "left_anti")
        fresh = stored(fresh, "fresh")
        seen = groups.join(earlier.withColumnRenamed("keep_id", "seen_id"), "digest") \
            .select("digest", "group_size", F.col("seen_id").alias("keep_id"), F.lit(None).cast("long").alias("first_pos"))
        known = stored(fresh.unionByName(seen), "known")
        self.append(fresh, batch)
        # a text that a third of the rows repeat makes one large key here: adaptive
        # execution splits it, as both sides are shuffled for this join alone
        return rows.join(known, "digest").select(
            "doc_id", "keep_id", "group_size", F.coalesce(F.col("pos") == F.col("first_pos"), F.lit(False)).alias("kept"), "digest")


def drop_copies(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is new to the index, one for each text, all columns.

    Rows are found again by id and digest; only where a kept id and text stand in
    several rows are those rows reduced to one.
    """
    kept = index.deduplicate(docs, id_col, text_col)
    kept = kept.groupBy("doc_id", "digest").agg(
        F.max("kept").alias("kept"), F.count(F.lit(1)).alias("copies")).filter("kept")
    kept = stored(kept.select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"), "copies"), "kept")
    hashed = unused(docs, "__key")
    rows = docs.withColumn(hashed, digest(F.col(text_col)))

    def same(other):
        return rows[id_col].eqNullSafe(other["__id"]) & (rows[hashed] == other["__digest"])

    once = rows.join(kept, same(kept), "left_semi").drop(hashed)
    repeated = kept.filter("copies > 1")
    if repeated.isEmpty():
        return once
    single = kept.filter("copies = 1")
    once, again = (rows.join(side, same(side), "left_semi") for side in (single, repeated))
    return once.unionByName(again.dropDuplicates([id_col, hashed])).drop(hashed)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document against an index that starts empty."""
    index = DigestIndex(spark, f"{shared_folder(spark)}/digest-index-{uuid.uuid4().hex}")
    return index.deduplicate(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP3_SQL = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)
"""
