"""Nearest neighbours by a block matrix join.

Vectors are packed into tiles. A tile of queries meets a tile of candidates in one int8
matrix product, which with the lengths of what rounding left off bounds each inner
product from both sides. Only candidates whose upper bound reaches the k-th best lower
bound are computed again from the original doubles; each task keeps a heap for a query,
and the heaps are merged by rank. The bounds hold for every pair, so nothing is missed.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from crowdtide.llm.common import stored, table

TILE = 1024
QUERIES_PER_CELL = 100_000
PAIRS_PER_CELL = 1 << 27  # some seconds of work
TILES_PER_TASK = 16  # that a task builds at least
SURVIVORS = 1 << 16  # pairs that are computed again at once


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, vector``: one row an id, without null, zero and non-finite vectors."""
    vector = F.col(vector_col).cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector")).filter(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & finite & F.exists(vector, lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def tiles(rows: DataFrame, size: int = TILE) -> DataFrame:
    """``dim int, ids binary, vectors binary`` (int64 and doubles), up to ``size`` in each."""

    def build(batches):
        import numpy as np
        import pyarrow as pa

        waiting: dict[int, list] = {}

        def tile(dim):
            held = waiting.pop(dim)
            ids = np.asarray([i for i, _ in held], "<i8").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([ids], pa.binary()), pa.array([np.concatenate([v for _, v in held]).tobytes()], pa.binary())], ["dim", "ids", "vectors"])

        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                v = v.values.to_numpy(zero_copy_only=False).astype("<f8")
                waiting.setdefault(len(v), []).append((i, v))
                if len(waiting[len(v)]) == size:
                    yield tile(len(v))
        for dim in list(waiting):
            yield tile(dim)

    return rows.mapInArrow(build, "dim int, ids binary, vectors binary")


def rounded(x):
    """int8 values (as float32, whose products are exact here), scale, and the lengths of
    the rounded vectors and of what rounding left off."""
    import numpy as np

    scale = np.abs(x).max(axis=1) / 127.0
    q = np.rint(x / scale[:, None]).astype(np.int8)
    back = q * scale[:, None]
    return q.astype(np.float32), scale, np.sqrt((back * back).sum(axis=1)), np.sqrt(((x - back) ** 2).sum(axis=1))


def exact(x, y):
    """Inner products row by row, summed in order, the same wherever a pair stands."""
    import numpy as np

    return np.add.accumulate(x * y, axis=1)[:, -1]


def tile_best(qid, qx, cid, cx, k: int, floor):
    """For each query of a tile its candidates that may be among the ``k`` nearest, as
    lists of ``(-score, id)`` in order. ``floor``: a score that k others reach already."""
    import numpy as np

    qq, qs, ql, qe = rounded(qx)
    cq, cs, cl, ce = rounded(cx)
    out = []
    step = max(1, (1 << 18) // len(cid))
    for i in range(0, len(qid), step):
        s = slice(i, i + step)
        about = (qq[s] @ cq.T).astype(np.float64) * qs[s, None] * cs[None, :]
        off = qe[s, None] * cl[None, :] + ql[s, None] * ce[None, :] + qe[s, None] * ce[None, :]
        off += 1e-9 * (ql[s, None] + qe[s, None]) * (cl + ce)[None, :]  # for the rounding of doubles
        own = qid[s, None] == cid[None, :]
        low = np.where(own, -np.inf, about - off)
        cut = floor[s].copy()
        if low.shape[1] > k:
            cut = np.maximum(cut, np.partition(low, -k, axis=1)[:, -k])
        rows, cols = np.nonzero((about + off >= cut[:, None]) & ~own)
        score = np.empty(len(rows))
        for j in range(0, len(rows), SURVIVORS):
            t = slice(j, j + SURVIVORS)
            score[t] = exact(qx[s][rows[t]], cx[cols[t]])
        order = np.lexsort((cid[cols], -score, rows))
        rows, score, ids = rows[order], score[order], cid[cols[order]]
        ends = np.searchsorted(rows, np.arange(len(cut) + 1))
        out += [list(zip((-score[a:min(a + k, b)]).tolist(), ids[a:min(a + k, b)].tolist())) for a, b in zip(ends, ends[1:])]
    return out


def nearest(queries: DataFrame, candidates: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding", cells: int | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` candidates of largest inner
    product, ties to the smaller id, the query's own id left out; all if there are fewer.

    Null ids and vectors that are null, zero or hold a null or non-finite number take no
    part; vectors of different lengths don't meet; of rows that repeat an id the smallest
    vector counts. Extra columns are not read. The tiles of queries and candidates meet in
    the cells of a grid, each pair in one cell; a cell keeps ``k`` pairs for each of at
    most about ``QUERIES_PER_CELL`` queries. Without candidates there are no rows.
    """
    spark = candidates.sparkSession
    # few rows in many partitions would make many tiny tiles
    tasks = lambda df: max(1, math.ceil(df.count() / (TILES_PER_TASK * TILE)))
    q = stored(tiles(usable(queries, id_col, vector_col).coalesce(tasks(queries))), "queries")
    c = stored(tiles(usable(candidates, id_col, vector_col).coalesce(tasks(candidates))), "candidates")
    count = lambda t: t.agg(F.coalesce(F.sum(F.octet_length("ids") / 8), F.lit(0.0)).alias("n")).first()["n"]
    nq, nc = count(q), count(c)
    # each cell gives k pairs for a query: no more cells than the work needs
    cells = cells or max(1, min(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(nq * nc / PAIRS_PER_CELL)))
    across = max(1, round(math.sqrt(cells * nq / max(nc, 1))), math.ceil(nq / QUERIES_PER_CELL))
    down = max(1, cells // across)

    def spread(t, own, n, other, m):
        at = F.pmod(F.xxhash64("ids"), F.lit(n)).cast("int").alias(own)
        return t.select("*", at, F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias(other))

    q = spread(q, "a", across, "b", down).select("dim", "a", "b", F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"))
    c = spread(c, "b", down, "a", across)

    def meet(batches):
        import heapq

        import numpy as np
        import pyarrow as pa

        heaps: dict[int, list] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                dim, qi, qv, ci, cv = (batch.column(j)[row].as_py() for j in range(5))
                qid, cid = np.frombuffer(qi, "<i8"), np.frombuffer(ci, "<i8")
                qx, cx = (np.frombuffer(v, "<f8").reshape(-1, dim) for v in (qv, cv))
                floor = np.asarray([-h[k - 1][0] if len(h := heaps.get(i, ())) == k else -np.inf for i in qid.tolist()])
                for i, best in zip(qid.tolist(), tile_best(qid, qx, cid, cx, k, floor)):
                    if best:
                        heaps[i] = heapq.nsmallest(k, heapq.merge(heaps.get(i, ()), best))
        items = list(heaps.items())
        for j in range(0, len(items), 4096):
            rows = [(i, v, -s) for i, h in items[j:j + 4096] for s, v in h]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.float64()))], ["query_id", "vec_id", "score"])

    met = c.join(q, ["dim", "a", "b"]).select("dim", "q_ids", "q_vectors", "ids", "vectors")
    found = met.mapInArrow(meet, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return nearest(rows.filter(F.col("vec_id") % 20 == 0), rows, 20)


OP4_SQL = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.x, c.x) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
