"""The memory of dedupe: hashes of all earlier batches, cut by prefix and compacted.

Under ``root``:

- ``base/slot=0`` and ``slot=1``: the hashes of all batches before some number, a folder and
  one sorted file for each hash prefix;
- ``marks``: how far a slot goes; a slot without a mark is being written, or was left so;
- ``recent/ring=r``: the hashes of one batch, sorted; ``r`` is its number modulo the ring.

Each ``every`` batches the valid base and the recent batches become the base in the other
slot. A batch so reads the prefixes it holds of one base, and fewer than ``2 * every``
recent batches, however many there have been. Nothing is read that is being written: a
replay of a batch finds the state as it was before the batch, and overwrites its own
hashes. The ring is long enough that the older slot can be compacted anew.

The state belongs to one sequence of batch numbers, as a stream's checkpoint does.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from crowdtide.sources.read import path_exists

HASH = "content_hash"
BASE = "content_hash string, seen_at timestamp, prefix string"
RECENT = "content_hash string, seen_at timestamp, batch_id long, ring int"
#: Rows of narrow keys that may be sent to every task: 60 bytes each.
SENT_ROWS = 500_000


def sent_if_small(df: DataFrame, rows: int) -> DataFrame:
    """A hint for a table of hashes whose rows have been counted."""
    return F.broadcast(df) if rows <= SENT_ROWS else df


class SeenState:
    """``digits`` hex digits cut the base into prefixes: choose them so that a prefix of it
    sorts in a task. They are fixed when a root is made, like ``every``."""

    def __init__(self, spark: SparkSession, root: str, digits: int = 2, every: int = 16):
        self.spark, self.root, self.digits, self.every, self.ring = spark, root, digits, every, 3 * every

    def prefix(self, key: Column) -> Column:
        return F.substring(key, 1, self.digits)

    def base(self, number: int) -> tuple[int | None, int]:
        """The slot to read before batch ``number``, and the first batch that is not in it."""
        marks = []
        if path_exists(self.spark, f"{self.root}/marks"):
            rows = self.spark.read.schema("upto long, slot int").parquet(f"{self.root}/marks").collect()
            marks = [(r["upto"], r["slot"]) for r in rows if r["upto"] <= number]
        return max(marks)[::-1] if marks else (None, 0)

    def rows(self, number: int | None = None, prefixes: Sequence[str] | None = None) -> DataFrame:
        """``content_hash, seen_at`` of all batches before ``number``, or of those prefixes of them."""
        number = self.next_number() if number is None else number
        slot, start = self.base(number)
        parts = [self.spark.createDataFrame([], "content_hash string, seen_at timestamp")]
        of = (lambda key: key.isin(list(prefixes))) if prefixes is not None else (lambda key: F.lit(True))
        if slot is not None:
            base = self.spark.read.schema(BASE).parquet(f"{self.root}/base/slot={slot}")
            parts.append(base.filter(of(F.col("prefix"))).drop("prefix"))
        if number > start and path_exists(self.spark, f"{self.root}/recent"):
            places = [n % self.ring for n in range(max(start, number - self.ring), number)]
            recent = self.spark.read.schema(RECENT).parquet(f"{self.root}/recent").filter(F.col("ring").isin(places))
            # a place of the ring may still hold an older batch
            recent = recent.filter(F.col("batch_id").between(start, number - 1) & of(self.prefix(F.col(HASH))))
            parts.append(recent.select(HASH, "seen_at"))
        out = parts[-1] if len(parts) == 2 else parts[0]
        return out if len(parts) < 3 else parts[1].unionByName(parts[2])

    def next_number(self) -> int:
        """The number after the last batch that had a new hash, for jobs that no stream numbers."""
        last = -1
        if path_exists(self.spark, f"{self.root}/recent"):
            recent = self.spark.read.schema(RECENT).parquet(f"{self.root}/recent")
            last = recent.agg(F.max("batch_id")).first()[0]
        return max((-1 if last is None else last) + 1, self.base(2**62)[1])

    def unseen(self, keys: DataFrame, number: int, rows: int) -> DataFrame:
        """The keys, one row a hash, whose hash no batch before ``number`` had; ``rows`` counts them.

        Only the prefixes that the keys hold are read. The state stays where it is if the
        keys are few; else both sides are shuffled.
        """
        held = keys.select(self.prefix(F.col(HASH)).alias("p")).distinct()
        prefixes = [r["p"] for r in held.collect()]  # 16 ** digits at most
        state = self.rows(number, prefixes if len(prefixes) < 16 ** self.digits else None)
        hits = state.select(HASH).join(sent_if_small(keys.select(HASH), rows), HASH, "left_semi")
        return keys.join(sent_if_small(hits, rows), HASH, "left_anti")

    def record(self, keys: DataFrame, number: int, now: datetime | Column | None = None):
        """Puts the hashes of batch ``number``; a second time replaces the first."""
        stamp = F.current_timestamp() if now is None else now if isinstance(now, Column) else F.lit(now).cast("timestamp")
        rows = keys.select(HASH, stamp.alias("seen_at"), F.lit(number).cast("long").alias("batch_id"))
        (rows.hint("rebalance").sortWithinPartitions(HASH)
         .write.mode("overwrite").parquet(f"{self.root}/recent/ring={number % self.ring}"))

    def compact(self, number: int) -> bool:
        """Before batch ``number``: makes a new base if ``every`` batches are not in one."""
        slot, start = self.base(number)
        if number - start < self.every:
            return False
        target = 0 if slot is None else 1 - slot
        self._mark(target, None)
        rows = self.rows(number).withColumn("prefix", self.prefix(F.col(HASH)))
        (rows.repartition(16 ** self.digits, "prefix").sortWithinPartitions("prefix", HASH)
         .write.partitionBy("prefix").mode("overwrite").parquet(f"{self.root}/base/slot={target}"))
        self._mark(target, number)
        return True

    def _mark(self, slot: int, upto: int | None):
        mark = self.spark.createDataFrame([(upto,)] if upto is not None else [], "upto long")
        mark.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/marks/slot={slot}")
