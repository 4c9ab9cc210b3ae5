"""Post texts to feature rows."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from crowdtide.fixed_values import CHUNK_ROWS, EMBED_BATCH, HASH_WIDTH
from crowdtide.operators import features as fx
from crowdtide.operators.clean import feature_meta
from crowdtide.operators.ranking import chunk_rows, read_chunks
from crowdtide.operators.summary import watch
from crowdtide.schemas import FEATURE
from crowdtide.session import cut_lineage, use_utc
from crowdtide.sources.intake import read_jsonl_setting_aside
from crowdtide.sources.write import write_features


def feature_rows(
    posts: DataFrame,
    make_encoder: Callable[[], Callable],
    scope: str = "corpus",
    chunk_size: int = CHUNK_ROWS,
    embed_batch: int = EMBED_BATCH,
    width: int = HASH_WIDTH,
    run_ts: datetime | None = None,
    drop_empty: bool = True,
    aliases: bool = True,
) -> DataFrame:
    """Meta, embedding and sparse TF-IDF of posts.

    ``scope`` says over what document frequencies are taken: all posts (rows
    then never move), ``'chunk'`` (of rows as read; needs ``_pos``, unique) or ``'file'``
    (needs ``_pos`` and ``_file``).
    """
    rows = feature_meta(posts, drop_empty, aliases)
    run_ts = run_ts or datetime.now(timezone.utc)
    if scope == "corpus":
        rows = fx.sparse_arrays(fx.hashed_tfidf(rows, "content", width, "tf"), "tf")
    elif scope in ("chunk", "file"):
        rows = _scoped_tfidf(rows, scope, chunk_size, width)
    else:
        raise ValueError(f"unknown scope: {scope!r}")
    rows = fx.embed(rows, "content", make_encoder, embed_batch)
    extra = ["chunk_id"] if scope == "chunk" else []
    rows = rows.withColumn("run_ts", F.lit(run_ts).cast("timestamp"))
    return rows.select(*FEATURE.names, *extra)


def _scoped_tfidf(rows: DataFrame, scope: str, size: int, width: int) -> DataFrame:
    rows = cut_lineage(rows)  # positions have to be the same in every use below
    if scope == "chunk":
        rows = read_chunks(rows, size)
        n_docs = chunk_rows(rows, "chunk_id", size)
        # counted where the texts are
        counts = fx.bucket_counts(rows, "_pos", "content", ["chunk_id"], width).repartition("chunk_id")
        weights = fx.tfidf_in_small_scopes(counts, "_pos", ["chunk_id"], n_docs)
    else:
        counts = fx.bucket_counts(rows, "_pos", "content", ["_file"], width)
        weights = fx.tfidf(rows, "_pos", counts, ["_file"])
    packed = fx.pack_sparse(
        weights.select(
            "_pos", F.col("term").cast("int").alias("term"), F.col("weight").cast("float").alias("weight")
        ),
        ["_pos"], "term", "weight",
    )
    return (
        rows.join(packed, "_pos", "left")
        .withColumn("tf_indices", F.coalesce("tf_indices", F.array().cast("array<int>")))
        .withColumn("tf_values", F.coalesce("tf_values", F.array().cast("array<float>")))
        .withColumn("tf_width", F.lit(width))
    )


def run_feature_job(
    spark: SparkSession,
    jsonl_path: str | list[str],
    feature_root: str,
    make_encoder: Callable[[], Callable],
    quarantine_root: str | None = None,
    **options,
) -> dict[str, int]:
    """Append features of all posts; returns rows written and lines read, blank and malformed.

    Malformed lines are appended to ``quarantine_root``, by default beside the features.
    """
    use_utc(spark)
    quarantine = quarantine_root or f"{feature_root.rstrip('/')}_set_aside"
    intake = read_jsonl_setting_aside(spark, jsonl_path, quarantine, positions=True)
    rows = feature_rows(intake.posts, make_encoder, **options)
    rows, written = watch(rows, "features_written", rows=F.count("*"))
    write_features(rows, feature_root)
    return {"rows_written": written.get["rows"], **intake.counters}
