"""Features and texts to trade signals."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from crowdtide.fixed_values import (
    MIN_POSTS,
    NEGATIVE_WORDS,
    POSITIVE_WORDS,
    THRESHOLD,
    WEIGHT_EMBEDDING,
    WEIGHT_LEXICAL,
    WINDOW,
)
from crowdtide.functions.times import parse_time
from crowdtide.operators.clean import text_rows
from crowdtide.operators.scoring import (
    ContrastModel,
    ScoreScaler,
    join_scores,
    score_features,
    score_texts,
)
from crowdtide.operators.summary import run_summary
from crowdtide.operators.windows import plot_series, window_signals
from crowdtide.schemas import TEXT_POST
from crowdtide.session import cut_lineage, use_utc
from crowdtide.sources.intake import read_jsonl_setting_aside
from crowdtide.sources.read import read_features
from crowdtide.sources.write import write_csv, write_signals_json


def scored_posts(
    features: DataFrame,
    texts: DataFrame,
    model: ContrastModel,
    positive: Sequence[str] = POSITIVE_WORDS,
    negative: Sequence[str] = NEGATIVE_WORDS,
    now: datetime | None = None,
    dedupe_keys: bool = True,
) -> DataFrame:
    """``id``, ``ts`` and the two raw scores of every feature row."""
    return join_scores(
        score_features(features, model), score_texts(texts, positive, negative), now, dedupe_keys
    )


def signals_of(
    scored: DataFrame,
    scaler: ScoreScaler,
    frequency: str = WINDOW,
    min_posts: int = MIN_POSTS,
    weight_emb: float = WEIGHT_EMBEDDING,
    weight_lex: float = WEIGHT_LEXICAL,
    threshold: float = THRESHOLD,
) -> DataFrame:
    composite = scored.withColumn("composite", scaler.composite(weight_emb, weight_lex))
    return window_signals(composite, "ts", "composite", frequency, threshold, min_posts)


def trade_signals(
    features: DataFrame,
    texts: DataFrame,
    model: ContrastModel,
    positive: Sequence[str] = POSITIVE_WORDS,
    negative: Sequence[str] = NEGATIVE_WORDS,
    now: datetime | None = None,
    dedupe_keys: bool = True,
    **window_options,
) -> DataFrame:
    """Signals of feature and text rows.

    Scores are needed twice, to fit the scale and to use it, and are three
    numbers a row by then: they are written once and the join is not repeated.
    """
    scored = cut_lineage(
        scored_posts(features, texts, model, positive, negative, now, dedupe_keys)
        .select("ts", "emb_score", "lex_score")
    )
    return signals_of(scored, ScoreScaler.fit(scored), **window_options)


def run_signal_job(
    spark: SparkSession,
    feature_root: str,
    jsonl_path: str | list[str],
    out_root: str,
    model: ContrastModel,
    now: datetime | None = None,
    dedupe_keys: bool = True,
    json_document: bool = False,
    quarantine_root: str | None = None,
    run_id: str | None = None,
    **window_options,
) -> dict:
    """Write signals as CSV and JSON and the plot series; return the run summary, with the
    lines of the texts that were read, blank and malformed.

    Each run writes folders of its own under ``out_root``, named by ``run_id`` (the time, if
    not given); a run repeated with its id replaces what it wrote.
    """
    use_utc(spark)
    now = now or datetime.now(timezone.utc)
    run_id = run_id or datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%fZ")
    place = {part: f"{out_root}/{part}/run_id={run_id}" for part in ("csv", "json", "plot")}
    features = read_features(spark, feature_root).withColumn("date", parse_time(F.col("date")))
    intake = read_jsonl_setting_aside(spark, jsonl_path, quarantine_root or f"{out_root}/set_aside", TEXT_POST)
    texts = text_rows(intake.posts)
    scored = cut_lineage(
        scored_posts(features, texts, model, now=now, dedupe_keys=dedupe_keys)
        .select("ts", "emb_score", "lex_score")
    )
    scaler = ScoreScaler.fit(scored)
    signals = cut_lineage(signals_of(scored, scaler, **window_options))
    write_csv(signals.orderBy("window_start"), place["csv"], "overwrite")
    write_signals_json(signals, place["json"], json_document, "overwrite")
    plot_series(signals).write.mode("overwrite").parquet(place["plot"])
    posts = scored.agg(F.count("*")).scalar()
    return {**run_summary(signals, posts).first().asDict(), "run_id": run_id, **intake.counters}
