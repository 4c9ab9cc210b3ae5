"""Hashed and term-level TF-IDF, sparse rows, batched embedding."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.ml.feature import ElementwiseProduct, HashingTF, Normalizer
from pyspark.ml.functions import predict_batch_udf
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from crowdtide.fixed_values import EMBED_BATCH, HASH_WIDTH
from crowdtide.functions.text import terms
from crowdtide.operators.skew import HOT_ROWS, HOT_SHARE
from crowdtide.session import cut_lineage, small_batches, written_once

#: Texts whose terms a task counts.
TEXT_BYTES = 16 << 20
#: Terms whose frequency is sent to every task, at 60 bytes each.
SENT_TERMS = 200_000


def hashing_tf(df: DataFrame, text: str, width: int = HASH_WIDTH, name: str = "tf") -> DataFrame:
    """Unsigned, unscaled term counts in ``width`` buckets, as a sparse vector. No shuffle."""
    tokens = df.withColumn("_terms", terms(F.coalesce(F.col(text), F.lit(""))))
    hashed = HashingTF(inputCol="_terms", outputCol=name, numFeatures=width).transform(tokens)
    return hashed.drop("_terms")


def hashed_tfidf(
    df: DataFrame, text: str, width: int = HASH_WIDTH, name: str = "tfidf"
) -> DataFrame:
    """Hashed TF-IDF with the smoothed idf plus one, rows of unit length.

    Document frequencies are counted by bucket before the shuffle; the model is ``width``
    numbers, whatever the data, and is applied to each row where it stands. Without rows
    there is nothing to weigh, and the result is empty.
    """
    counted = hashing_tf(df, text, width, "_tf")
    held = counted.select(F.unwrap_udt("_tf")["indices"].alias("_held"))
    # one more bucket, which every row has, counts the rows
    buckets = held.select(F.explode(F.concat("_held", F.array(F.lit(width)))).alias("bucket"))
    frequency = {r["bucket"]: r["count"] for r in buckets.groupBy("bucket").count().collect()}
    rows = frequency.get(width, 0)
    weights = [math.log((1 + rows) / (1 + frequency.get(b, 0))) + 1.0 for b in range(width)]
    scale = ElementwiseProduct(inputCol="_tf", outputCol="_scaled", scalingVec=Vectors.dense(weights))
    unit = Normalizer(inputCol="_scaled", outputCol=name, p=2.0)
    return unit.transform(scale.transform(counted)).drop("_tf", "_scaled")


def sparse_arrays(df: DataFrame, vector: str, prefix: str = "tf") -> DataFrame:
    """A sparse vector column as ``<prefix>_indices``, ``_values`` and ``_width``."""
    inner = F.unwrap_udt(vector)
    return df.withColumns(
        {
            f"{prefix}_indices": inner["indices"],
            f"{prefix}_values": inner["values"].cast("array<float>"),
            f"{prefix}_width": inner["size"],
        }
    ).drop(vector)


def by_document(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """Texts brought together by document, about ``TEXT_BYTES`` in a task.

    Terms are then counted, and whatever else is grouped by document is made, where the text
    is: a text moves once, and not as a row for each of its terms, which is many times as much.
    """
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    tasks = max(docs.sparkSession.sparkContext.defaultParallelism, math.ceil(size / TEXT_BYTES))
    return docs.repartition(tasks, doc)


def term_counts(
    docs: DataFrame, doc: str, text: str, scope: Sequence[str] = ()
) -> DataFrame:
    """Occurrences of each term in each document (``doc`` has to be unique)."""
    return (
        docs.select(*scope, doc, F.explode(terms(F.col(text))).alias("term"))
        .groupBy(*scope, doc, "term")
        .agg(F.count("*").alias("tf"))
    )


def bucket_counts(
    docs: DataFrame, doc: str, text: str, scope: Sequence[str] = (), width: int = HASH_WIDTH
) -> DataFrame:
    """The same, by hash bucket: a scope's vocabulary is then at most ``width``."""
    hashed = F.unwrap_udt("_tf")
    return (
        hashing_tf(docs, text, width, "_tf")
        .select(*scope, doc, F.explode(F.arrays_zip(hashed["indices"], hashed["values"])).alias("x"))
        .select(*scope, doc, F.col("x.indices").alias("term"), F.col("x.values").cast("bigint").alias("tf"))
    )


def document_frequency(counts: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Documents per term. Rows of ``counts`` are distinct by document and term."""
    return counts.groupBy(*scope, "term").agg(F.count("*").alias("df"))


def smooth_idf(n_docs: Column, df: Column) -> Column:
    return F.log((n_docs + 1).cast("double") / (df + 1).cast("double")) + 1.0


def least_sent(frequency: DataFrame, most: int) -> int:
    """The frequency that fewer than ``most`` terms exceed, and as many as can; 0 if all do."""
    # distinct frequencies: the root of the rows at most
    above = Window.orderBy(F.col("df").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = frequency.groupBy("df").agg(F.count("*").alias("_terms"))
    return sizes.withColumn("_above", F.sum("_terms").over(above)).filter(F.col("_above") > most).agg(F.max("df")).first()[0] or 0


def tfidf(
    docs: DataFrame,
    doc: str,
    counts: DataFrame,
    scope: Sequence[str] = (),
    share: int = HOT_SHARE,
    min_rows: int = HOT_ROWS,
    sent: int = SENT_TERMS,
) -> DataFrame:
    """Unit-length TF-IDF weights, one row per document and term.

    Frequencies are taken over the whole input or per ``scope``. The vocabulary
    grows with the data, but most rows are of its ``sent`` most frequent terms, which are
    broadcast. The other rows are joined by shuffle; a term so common that one task would get
    too many rows (``share`` and ``min_rows``, see ``heavy_keys``) is never among them.
    Rows go to their document with whole numbers alone, and are weighed there.
    """
    scope = list(scope)
    key = [*scope, "term"]
    # three passes follow; reading the counts back beats splitting texts three times
    counts = written_once(counts, "term-counts")
    frequency = document_frequency(counts, scope)
    if scope:
        sizes = docs.groupBy(*scope).agg(F.count("*").alias("n_docs"))
        frequency, n_docs = frequency.join(sizes, scope), F.col("n_docs")
    else:
        n_docs = F.lit(docs.count())
    frequency = cut_lineage(frequency)

    least = least_sent(frequency, sent)
    if least:
        total = frequency.agg(F.sum("df")).scalar()
        limit = F.least(F.lit(least), F.greatest(total / F.lit(share), F.lit(min_rows)))
        common = frequency.filter(F.col("df") > limit)
        placed_here = counts.join(F.broadcast(common), key)
        rare = counts.join(F.broadcast(common.select(*key)), key, "left_anti")
        found = placed_here.unionByName(rare.join(frequency, key))
    else:
        found = counts.join(F.broadcast(frequency), key)
    weighted = found.repartition(*scope, doc).withColumn("weight", F.col("tf") * smooth_idf(n_docs, F.col("df")))
    length = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy(*scope, doc)))
    return weighted.withColumn("weight", F.col("weight") / length).select(
        *scope, doc, "term", "tf", "df", "weight"
    )


def tfidf_in_small_scopes(
    counts: DataFrame, doc: str, scope: Sequence[str], n_docs: Column
) -> DataFrame:
    """The same weights where a scope is a bounded number of documents.

    ``counts`` are placed by scope (``repartition(*scope)``): both windows then work
    where they are, so no text moves and nothing is joined or written in between.
    """
    scope = list(scope)
    # the column that differs most comes first, as a number: sorting then hardly compares rows
    in_term = Window.partitionBy("_key", *scope, "term")
    in_doc = Window.partitionBy(doc, *scope)
    raw = F.col("tf") * smooth_idf(n_docs, F.col("df"))
    length = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(in_doc))
    return (
        counts.withColumn("_key", F.xxhash64(*scope, "term"))
        .withColumn("df", F.count("*").over(in_term))
        .withColumn("weight", raw)
        .withColumn("weight", F.col("weight") / length)
        .select(*scope, doc, "term", "tf", "df", "weight")
    )


def pack_sparse(
    entries: DataFrame, doc: Sequence[str], index: str, value: str, prefix: str = "tf"
) -> DataFrame:
    """Entry rows to one row per document with index and value arrays, by index."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(index).alias("i"), F.col(value).alias("v"))))
    return (
        entries.groupBy(*doc)
        .agg(pairs.alias("_pairs"))
        .select(
            *doc,
            F.col("_pairs.i").alias(f"{prefix}_indices"),
            F.col("_pairs.v").alias(f"{prefix}_values"),
        )
    )


def unpack_sparse(
    rows: DataFrame, doc: Sequence[str], index: str, value: str, prefix: str = "tf"
) -> DataFrame:
    pairs = F.arrays_zip(
        F.col(f"{prefix}_indices").alias("i"), F.col(f"{prefix}_values").alias("v")
    )
    return rows.select(*doc, F.explode(pairs).alias("x")).select(
        *doc, F.col("x.i").alias(index), F.col("x.v").alias(value)
    )


def embed(
    df: DataFrame,
    text: str,
    make_encoder: Callable[[], Callable],
    batch: int = EMBED_BATCH,
    name: str = "embedding",
) -> DataFrame:
    """Encode texts in batches. ``make_encoder`` runs once per Python worker and
    returns a function from an array of texts to a float matrix. What comes to a worker at
    once is bounded in bytes, see ``small_batches``: texts may be long."""
    small_batches(df.sparkSession)
    encode = predict_batch_udf(
        make_encoder, return_type=T.ArrayType(T.FloatType()), batch_size=batch
    )
    return df.withColumn(name, encode(F.coalesce(F.col(text), F.lit(""))))


def hash_projection_encoder(dimensions: int = 64) -> Callable[[], Callable]:
    """A stand-in encoder for tests and offline runs: signed word hashing into
    ``dimensions`` numbers, unit length. It is not a language model."""

    def make():
        import re
        from collections import Counter
        from zlib import crc32

        import numpy as np

        word = re.compile(r"\w+")

        def encode(texts):
            out = np.zeros((len(texts), dimensions), dtype="float32")
            for row, text in zip(out, texts):
                for token, count in Counter(word.findall(text.lower())).items():
                    code = crc32(token.encode())
                    row[(code >> 1) % dimensions] += count if code & 1 else -count
            lengths = np.linalg.norm(out, axis=1, keepdims=True)
            return np.divide(out, lengths, out=out, where=lengths != 0)

        return encode

    return make
