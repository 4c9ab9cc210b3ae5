"""Vector codes: product quantisation, its codebooks fitted with adaptive distance bounds.

Vectors become integers and are cut into parts; each part position has a codebook whose
entries move to the mean of the parts that lie nearest. After each assignment a row keeps,
for every part, the ``b`` next-closest entries with ordered lower bounds of their
distances, and one outer bound for all other entries. When entries move, bounds shrink by
the way moved, and the distance to the entry assigned is computed anew. Where it is below
a bound, the entries from there on need no distance; where it is not, the entries before
that bound are computed in integers, and only below the outer bound fails too all of them.
``b`` is chosen again after each round from how many bounds the parts did test.

All sums, bounds and comparisons are whole numbers, so codes are those of a full search.
What a round leaves is a written table; a lost executor costs a read. The driver holds the
codebooks and their sums, ``parts * entries`` rows of fixed size, and no vector beyond the
first ones.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, ShortType, StructField, StructType

from crowdtide.llm.common import stored, table

SCALE = 256
CHUNK = 2048  # vectors that are compared at once
FAR = (1 << 31) - 1  # a bound where no entry is left; real ones are cut there, which keeps them below


def usable(df: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``vec_id, label, vector``, without vectors that are null or hold null or non-finite components."""
    vector = F.col(vector_col).cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), vector.alias("vector")).filter(
        F.col("vector").isNotNull() & finite)


def root(squares, up: bool = False):
    """The whole part of a square root, or the whole number above it."""
    import numpy as np

    r = np.sqrt(squares.astype(np.float64)).astype(np.int64)
    r -= r * r > squares
    r += (r + 1) * (r + 1) <= squares
    return r + (r * r < squares) if up else r


class Coder:
    """Assigns parts to entries; one for a round, sent to the tasks. ``books``: part, entry, component."""

    def __init__(self, books, old=None, held: int = 0, keep: int = 0):
        import numpy as np

        self.books, self.held, self.keep = books, held, keep
        if old is not None:
            self.moves = root(((books - old) ** 2).sum(2), up=True)
            self.most = self.moves.max(1) if books.shape[1] else np.zeros(len(books), np.int64)

    def squares(self, parts, at, entries):
        """Squared distances of ``parts`` (row, component) of part positions ``at`` to some entries of each."""
        import numpy as np

        out = np.zeros(entries.shape, np.int64)
        for j in range(parts.shape[1]):
            d = parts[:, j, None] - self.books[at[:, None], entries, j]
            out += d * d
        return out

    def search(self, parts, at):
        """Of each row all entries: code, its square, the ``keep`` next-closest, their bounds and the outer bound."""
        import numpy as np

        n, k = len(parts), self.books.shape[1]
        squares = np.empty((n, k), np.int64)
        for p in np.unique(at):
            rows, d = np.flatnonzero(at == p), 0
            for j in range(parts.shape[1]):
                e = parts[rows, j, None] - self.books[p, :, j]
                d = d + e * e
            squares[rows] = d
        order = np.argsort(squares, axis=1, kind="stable")  # equal distances: the lower index first
        ranked = np.take_along_axis(squares, order, 1)
        bounds = np.full((n, self.keep + 1), FAR, np.int64)
        known = np.minimum(root(ranked[:, 1:self.keep + 2]), FAR)
        bounds[:, :known.shape[1]] = known
        near = np.zeros((n, self.keep), np.int64)
        near[:, :max(min(self.keep, k - 1), 0)] = order[:, 1:self.keep + 1]
        return order[:, 0], ranked[:, 0], near, bounds

    def again(self, parts, at, code, near, bounds):
        """The same from what an earlier round left, and the number of bounds tested: ``held + 1`` is a full search."""
        import numpy as np

        b = self.held
        near, outer = near[:, :b], np.minimum.reduce(bounds[:, b:], axis=1)
        if b:
            low = np.concatenate([bounds[:, :b] - self.moves[at[:, None], near], (outer - self.most[at])[:, None]], axis=1)
        else:
            low = (outer - self.most[at])[:, None]
        low[:, -1][outer == FAR] = FAR
        low = np.maximum(low, 0)
        low = np.minimum.accumulate(low[:, ::-1], axis=1)[:, ::-1]
        best = self.squares(parts, at, code[:, None])[:, 0]
        tested = (low * low <= best[:, None]).sum(1)
        code, near, low = code.copy(), near.copy(), low.copy()

        some = np.flatnonzero((tested > 0) & (tested <= b))
        if len(some):
            wide = int(tested[some].max())
            own = np.concatenate([code[some, None], near[some, :wide]], axis=1)
            squares = self.squares(parts[some], at[some], own)
            out = np.arange(wide + 1) > tested[some, None]
            rank = np.where(out, np.iinfo(np.int64).max, squares * self.books.shape[1] + own)
            order = np.argsort(rank, axis=1, kind="stable")
            own, squares = np.take_along_axis(own, order, 1), np.take_along_axis(squares, order, 1)
            out = np.take_along_axis(out, order, 1)
            code[some], best[some] = own[:, 0], squares[:, 0]
            near[some, :wide] = np.where(out[:, 1:], near[some, :wide], own[:, 1:])
            low[some, :wide] = np.where(out[:, 1:], low[some, :wide], np.minimum(root(squares[:, 1:]), FAR))
        if self.keep < b:
            low = np.concatenate([low[:, :self.keep], low[:, self.keep:].min(1)[:, None]], axis=1)
            near = near[:, :self.keep]
        full = np.flatnonzero(tested > b)
        if len(full):
            code[full], best[full], near[full], low[full] = self.search(parts[full], at[full])
        return code, best, near, low, tested


def assigned(rows: DataFrame, coder: Coder, first: bool, scale: int, limit: int) -> DataFrame:
    """One assignment of every row: adds or renews ``code, near, bounds, tested, error``."""
    kinds = {"vector": IntegerType(), "code": ShortType(), "near": ShortType(), "bounds": IntegerType(), "tested": ShortType()}
    keep = [f for f in rows.schema if f.name in ("vec_id", "label")]
    schema = StructType([*keep, *[StructField(n, ArrayType(t)) for n, t in kinds.items()], StructField("error", LongType())])
    n_parts, _, width = coder.books.shape

    def run(batches):
        import numpy as np
        import pyarrow as pa

        arrow = {"vector": pa.int32(), "code": pa.int16(), "near": pa.int16(), "bounds": pa.int32(), "tested": pa.int16()}
        flat = lambda batch, name, n: batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(n, n_parts, -1)

        def lists(x, n, name):
            x = x.reshape(n, -1)
            return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * x.shape[1], pa.int32()), pa.array(x.ravel(), arrow[name]))

        for whole in batches:
            for start in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(start, CHUNK)
                n = batch.num_rows
                if first:
                    x = np.floor(np.vstack([v.values.to_numpy(zero_copy_only=False) for v in batch.column("vector")]) * scale)
                    if np.abs(x).max(initial=0) > limit:
                        raise ValueError(f"a component beyond {limit / scale:g} does not fit the sums of 64 bits")
                    x = np.pad(x.astype(np.int64), ((0, 0), (0, n_parts * width - x.shape[1])))
                else:
                    x = flat(batch, "vector", n).astype(np.int64)
                parts, at = x.reshape(n * n_parts, width), np.tile(np.arange(n_parts), n)
                if first:
                    code, best, near, bounds = coder.search(parts, at)
                    tested = np.full(len(at), coder.keep + 1)
                else:
                    code = flat(batch, "code", n).reshape(-1).astype(np.int64)
                    # with no slot an array is empty
                    near, bounds = (batch.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(at), -1) if len(batch.column(c).flatten()) else np.zeros((len(at), 0), np.int64) for c in ("near", "bounds"))
                    code, best, near, bounds, tested = coder.again(parts, at, code, near, bounds)
                made = {"vector": x, "code": code, "near": near, "bounds": bounds, "tested": tested}
                columns = [batch.column(f.name) for f in keep] + [lists(made[c], n, c) for c in kinds]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(best.reshape(n, n_parts).sum(1))], [f.name for f in schema])

    return rows.mapInArrow(run, schema)


def totals(rows: DataFrame, n_parts: int, n_entries: int, width: int, slots: int):
    """Sums and counts of the parts of each entry, and how many parts tested how many bounds."""
    import numpy as np

    def run(batches):
        import numpy as np
        import pyarrow as pa

        sums, tests = np.zeros((n_parts * n_entries, width + 1), np.int64), np.zeros(slots + 2, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            code = batch.column("code").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            slot = np.tile(np.arange(n_parts) * n_entries, batch.num_rows) + code
            parts = batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(len(slot), width)
            order = np.argsort(slot, kind="stable")
            starts = np.flatnonzero(np.diff(slot[order], prepend=-1))
            sums[slot[order][starts], :width] += np.add.reduceat(parts[order].astype(np.int64), starts) if width else 0
            sums[:, width] += np.bincount(slot, minlength=len(sums))
            tests += np.bincount(batch.column("tested").flatten().to_numpy(zero_copy_only=False), minlength=len(tests))
        flat = np.concatenate([sums.ravel(), tests])
        some = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(flat[some])], ["place", "total"])

    parted = rows.select("vector", "code", "tested").mapInArrow(run, "place long, total long")
    flat = np.zeros(n_parts * n_entries * (width + 1) + slots + 2, np.int64)
    for row in parted.groupBy("place").agg(F.sum("total").alias("total")).collect():
        flat[row["place"]] = row["total"]
    sums = flat[:len(flat) - slots - 2].reshape(n_parts, n_entries, width + 1)
    return sums[..., :width], sums[..., width:], flat[len(flat) - slots - 2:]


def fewer(tests, slots: int, n_entries: int) -> int:
    """The number of bounds that cost least: each a test for every part, and a full search where they don't do."""
    total = max(int(tests.sum()), 1)
    return min(range(1, slots + 1), key=lambda b: (b + n_entries * int(tests[b + 1:].sum()) / total, b)) if slots else 0


def fit(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = SCALE, slots: int | None = None,
):
    """``(rows, books)``: a stored table ``vec_id, label, code array<short>, error long``, and the codebooks.

    The codebooks start as the parts of the ``entries`` smallest ids (null ids last, equal ids
    by their vectors); if there are fewer rows, so are the entries. Rows whose vector is null,
    or holds null or non-finite components, take no part, nor do those whose vector is not as
    long as that of the smallest id. A length that ``parts`` does not divide is filled with
    zeros. Repeated rows count each time. ``error`` is the squared distance of a vector to its
    code. ``books`` is an array by part, entry and component; without rows it has no entries.
    Components beyond 65,536 (for 16 parts of 4 and 64 entries) don't fit the sums and raise
    an error. ``slots`` bounds are kept at first, a quarter of the entries if not named.
    """
    import numpy as np

    rows = usable(df, id_col, vector_col, label_col)
    first = lambda r: r.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    seeds = [r["vector"] for r in first(rows)]
    dim = len(seeds[0]) if seeds else 0
    rows = rows.filter(F.size("vector") == dim)
    if any(len(s) != dim for s in seeds):
        seeds = [r["vector"] for r in first(rows)]
    width = -(-dim // parts)
    limit = math.isqrt((1 << 62) // max(entries * parts * width, 1)) // 2
    start = np.zeros((len(seeds), parts * width), np.int64)
    start[:, :dim] = np.clip(np.floor(np.array(seeds, np.float64).reshape(len(seeds), dim) * scale), -limit, limit)
    books = start.reshape(len(seeds), parts, width).transpose(1, 0, 2).copy()
    if not seeds:
        none = StructType([*rows.schema.fields[:2], StructField("code", ArrayType(ShortType())), StructField("error", LongType())])
        return df.sparkSession.createDataFrame([], none), books
    held = max(1, len(seeds) // 4) if slots is None else slots
    state = stored(assigned(rows, Coder(books, keep=held), True, scale, limit), "codes")
    for i in range(rounds):
        sums, counts, tests = totals(state, parts, len(seeds), width, held)
        keep = fewer(tests, held, len(seeds)) if i else held
        old, books = books, np.where(counts > 0, sums // np.maximum(counts, 1), books)
        last = i == rounds - 1
        state = stored(assigned(state, Coder(books, old, keep, 0 if last else keep), False, scale, limit), "codes")
        held = keep
    return state.select("vec_id", "label", "code", "error"), books


def books_digest(books) -> str:
    """SHA-256 of all components as decimal text by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def vector_codes(df: DataFrame, **options) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256``; options as of :func:`fit`.

    ``code`` has two hex digits for each part, ``label_error`` is the error of all rows with
    an equal label, null labels together. A label may hold any share of the rows: errors are
    summed before they move, and the sums are a written table of known size, sent to the rows
    if small, else joined with both sides shuffled, where adaptive execution splits hot labels.
    """
    rows, books = fit(df, **options)
    sums = stored(rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "label-errors")
    code = F.array_join(F.transform("code", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    return rows.select("vec_id", "label", code.alias("code"), "error").join(sums, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(table(spark, sf_dir, "embeddings"))


def _round(i: int) -> str:
    """A part's distances to all entries of codebook ``i``, the nearest, and codebook ``i + 1``."""
    return rf"""
a{i} AS MATERIALIZED (
  SELECT vec_id, p, min({{'d': d, 'e': e}}) AS best FROM (
    SELECT x.vec_id, x.p, b.e, list_sum(list_transform(list_zip(x.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
    FROM parts x JOIN b{i} b USING (p)) GROUP BY vec_id, p),
m{i} AS (
  SELECT p, e, list(s ORDER BY j) AS v FROM (
    SELECT a.p, a.best.e AS e, j, CAST(floor(CAST(sum(x.v[j + 1]) AS DOUBLE) / count(*)) AS BIGINT) AS s
    FROM a{i} a JOIN parts x USING (vec_id, p), (SELECT unnest(range(4)) AS j) GROUP BY ALL) GROUP BY p, e),
b{i + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM b{i} b LEFT JOIN m{i} m USING (p, e)),"""


# for 64 components, as in the table
OP12_SQL = rf"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT vec_id, p, v[4 * p + 1 : 4 * p + 4] AS v FROM kept, (SELECT unnest(range(16)) AS p)),
b0 AS MATERIALIZED (
  SELECT p, e, v FROM parts JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT 64) USING (vec_id)),
{_round(0)}{_round(1)}
a2 AS MATERIALIZED (
  SELECT vec_id, p, min({{'d': d, 'e': e}}) AS best FROM (
    SELECT x.vec_id, x.p, b.e, list_sum(list_transform(list_zip(x.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
    FROM parts x JOIN b2 b USING (p)) GROUP BY vec_id, p),
coded AS (
  SELECT vec_id, string_agg(printf('%02x', CAST(best.e AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM a2 GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) FROM b2) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)
"""
