"""CSV whose quoted fields hold line ends, read in as many tasks as the files have splits.

Physical lines are read split by split, as text is. A line begins a record if the quotes
before it in its file are even in number. Two passes settle that without moving a line:

1. each split gives one row: whether its quotes are odd, and whether a line of it would
   begin a record if those before were odd;
2. with the running parity of the splits before it, a split puts its own lines together.

Only the records that go over the end of a split, one a split at most, are shuffled to be
joined. A quote inside an unquoted field, which the writers here never make, would be
counted too. Lines end in ``\\n`` or ``\\r\\n``.
"""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from crowdtide.session import cut_lineage

#: Splits whose parity is sent to every task, at 33 bytes each.
MOST_SPLITS = 4_000_000


def split_lines(spark: SparkSession, path) -> DataFrame:
    """``value, _file, _start``: lines with the file and the place where their split begins."""
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.xxhash64("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"))


def _runs(batch):
    """Slices of a batch whose lines are of one split, in order."""
    import numpy as np

    file, start = batch.column("_file").to_numpy(), batch.column("_start").to_numpy()
    cuts = np.flatnonzero((np.diff(file) != 0) | (np.diff(start) != 0)) + 1
    edges = [0, *cuts.tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            yield (int(file[a]), int(start[a])), batch.slice(a, b - a)


def _odd_before(values, odd: int):
    """Whether the quotes before each line are odd, and whether all of them are."""
    import numpy as np
    import pyarrow.compute as pc

    total = np.cumsum(pc.count_substring(values, '"').to_numpy(zero_copy_only=False)) + odd
    return np.concatenate([[odd], total[:-1]]) % 2, int(total[-1]) % 2


def _describe(batches):
    """One row a split: ``_file, _start, odd, turns, header``."""
    import pyarrow as pa

    out, now = [], None

    def row():
        (file, start), odd, turns, header, _ = now
        return file, start, odd, turns, "\n".join(header) if start == 0 else None

    for batch in batches:
        for key, run in _runs(batch):
            if now is None or now[0] != key:
                if now is not None:
                    out.append(row())
                now = [key, 0, False, [], key[1] > 0]
            values = run.column("value")
            before, odd = _odd_before(values, now[1])
            for i in range(0 if now[4] else len(values)):
                # the file's first record: up to the next line with even quotes before it
                if now[3] and not before[i]:
                    now[4] = True
                    break
                now[3].append(values[i].as_py())
            now[1], now[2] = odd, now[2] or bool(before.any())
    if now is not None:
        out.append(row())
    columns = list(zip(*out)) if out else [[]] * 5
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string())
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["_file", "_start", "odd", "turns", "header"])


def _join(batches):
    """Records of each split: ``record, part, _file, origin, _start, first``.

    ``part`` marks what began in an earlier split or goes on in the next; ``origin`` is the
    split where the record begins. ``first`` marks the first record of a file.
    """
    import numpy as np
    import pyarrow as pa

    names = ["record", "part", "_file", "origin", "_start", "first"]
    kinds = (pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())

    def made(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [[]] * 6, kinds)], names)

    def line(part):
        return part if isinstance(part, str) else "\n".join(part)

    class Split:
        def __init__(self, key, run):
            self.file, self.start = key
            if run.column("before")[0].as_py() is None:
                raise ValueError("the splits of the input changed between two passes over it")
            self.odd, self.origin = run.column("before")[0].as_py(), run.column("origin")[0].as_py()
            self.head = bool(self.odd)  # the record under way began in an earlier split
            self.held, self.count = [], 0

        def row(self, record, part):
            origin = self.origin if self.head else self.start
            first = self.start == 0 and self.count == 0
            self.head, self.count = False, self.count + 1
            return record, part, self.file, origin, self.start, first

        def take(self, values):
            before, self.odd = _odd_before(values, self.odd)
            texts, starts = values.to_pylist(), np.flatnonzero(before == 0).tolist()
            if not starts:
                self.held += texts
                return
            if self.held or starts[0]:
                yield self.row(line(self.held + texts[:starts[0]]), self.head)
            for a, b in zip(starts, starts[1:]):
                yield self.row(texts[a] if b == a + 1 else line(texts[a:b]), False)
            self.held = texts[starts[-1]:]

        def end(self):
            if self.held:
                yield self.row(line(self.held), self.head or bool(self.odd))

    split = None
    for batch in batches:
        rows = []
        for key, run in _runs(batch):
            if split is None or (split.file, split.start) != key:
                if split is not None:
                    rows += split.end()
                split = Split(key, run)
            rows += split.take(run.column("value"))
        yield made(rows)
    if split is not None:
        yield made(list(split.end()))


def _names(header: str) -> list[str]:
    """Column names as Spark's own reader makes them of a header."""
    raw = next(csv.reader([header.lstrip("﻿").removesuffix("\r")]), [])
    names = [n or f"_c{i}" for i, n in enumerate(raw)]
    low = [n.lower() for n in names]
    return [n if low.count(n.lower()) == 1 else f"{n}{i}" for i, n in enumerate(names)]


def csv_records(spark: SparkSession, path) -> tuple[str | None, DataFrame]:
    """The header all files share, and ``record, first``: the records as text.

    Files whose headers differ are an error; without any line the header is None.
    """
    lines = split_lines(spark, path)
    splits = cut_lineage(lines.mapInArrow(_describe, "_file long, _start long, odd long, turns boolean, header string"))
    headers = [r["header"] for r in splits.filter("header is not null").select("header").distinct().limit(2).collect()]
    if len(headers) > 1:
        raise ValueError(f"files with different headers: {headers}")
    if splits.count() > MOST_SPLITS:
        raise ValueError(f"over {MOST_SPLITS:,} splits: raise spark.sql.files.maxPartitionBytes")
    earlier = Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2
    splits = splits.withColumn("before", before).withColumn("begins", (F.col("before") == 0) | F.col("turns"))
    origin = F.last(F.when(F.col("begins"), F.col("_start")), ignorenulls=True).over(earlier)
    splits = cut_lineage(splits.withColumn("origin", origin).select("_file", "_start", "before", "origin"))
    # sent to every task: a shuffle would lose the order of the lines
    placed = lines.join(F.broadcast(splits), ["_file", "_start"], "left").select("value", "_file", "_start", "before", "origin")
    records = placed.mapInArrow(_join, "record string, part boolean, _file long, origin long, _start long, first boolean")
    pieces = F.array_sort(F.collect_list(F.struct("_start", "record")))
    over = (
        records.filter("part").groupBy("_file", "origin")
        .agg(F.array_join(F.transform(pieces, lambda p: p["record"]), "\n").alias("record"), F.max("first").alias("first"))
    )
    whole = records.filter("not part").select("record", "first").unionByName(over.select("record", "first"))
    return headers[0] if headers else None, whole.withColumn("record", F.regexp_replace("record", r"\r\z", ""))


def read_csv_records(spark: SparkSession, path) -> DataFrame:
    """Rows of CSV files with a header, every value a string; no columns if there is no line."""
    header, records = csv_records(spark, path)
    if header is None:
        return spark.createDataFrame([], T.StructType([]))
    schema = T.StructType([T.StructField(n, T.StringType()) for n in _names(header)])
    ddl = ", ".join(f"`{n.replace('`', '``')}` string" for n in schema.names)
    parsed = F.from_csv("record", ddl, {"escape": '"', "multiLine": "true", "maxCharsPerColumn": "-1"})
    rows = records.filter(~F.col("first") & (F.col("record") != "")).select(parsed.alias("_r"))
    return rows.select("_r.*")
