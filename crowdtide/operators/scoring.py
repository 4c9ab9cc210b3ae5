"""Feature and text rows to one standardised composite score per post."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import astuple, dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from crowdtide.fixed_values import (
    NEGATIVE_WORDS,
    POSITIVE_WORDS,
    WEIGHT_EMBEDDING,
    WEIGHT_LEXICAL,
)
from crowdtide.functions.text import lexical_score
from crowdtide.functions.times import time_or_now
from crowdtide.functions.vectors import contrast_score
from crowdtide.operators.ranking import last_per_key
from crowdtide.operators.skew import skew_join


def centroids(df: DataFrame, side: str, vector: str) -> DataFrame:
    """Element-wise mean of the vectors of each side, one row per side and position."""
    return (
        df.select(side, F.posexplode(vector).alias("position", "value"))
        .groupBy(side, "position")
        .agg(F.avg(F.col("value").cast("double")).alias("value"))
    )


@dataclass(frozen=True)
class ContrastModel:
    """Two seed centroids: a model of fixed size, like any fitted estimator."""

    positive: tuple[float, ...]
    negative: tuple[float, ...]

    @classmethod
    def fit(cls, seeds: DataFrame, positive: Column, negative: Column, vector: str):
        """Average the seed vectors of each side where Spark holds them."""
        side = F.when(positive, F.lit("positive")).when(negative, F.lit("negative"))
        rows = centroids(seeds.withColumn("_side", side).filter("_side is not null"), "_side", vector)
        found = {"positive": {}, "negative": {}}
        for row in rows.collect():
            found[row["_side"]][row["position"]] = row["value"]
        if not found["positive"] or not found["negative"]:
            raise ValueError("both sides need at least one seed vector")
        return cls(*[tuple(found[s][i] for i in sorted(found[s])) for s in found])

    @classmethod
    def from_words(
        cls,
        make_encoder,
        positive: Sequence[str] = POSITIVE_WORDS,
        negative: Sequence[str] = NEGATIVE_WORDS,
    ):
        """Average the encoded lexicon words."""
        import numpy as np

        encode = make_encoder()
        sides = [np.asarray(encode(np.array(words, dtype=object))) for words in (positive, negative)]
        return cls(*[tuple(float(x) for x in side.mean(axis=0)) for side in sides])

    def score(self, vector: Column) -> Column:
        return contrast_score(self.positive, self.negative)(vector)


@dataclass(frozen=True)
class ScoreScaler:
    """Means and population deviations of the two scores."""

    emb_mean: float
    emb_std: float
    lex_mean: float
    lex_std: float

    @classmethod
    def fit(cls, scored: DataFrame):
        row = scored.agg(*_moments("emb_score"), *_moments("lex_score")).first()
        if row["emb_score_mean"] is None:
            raise ValueError("no joined records: there is no row with an embedding")
        return cls(*[float(x) for x in row])

    def composite(
        self,
        weight_emb: float = WEIGHT_EMBEDDING,
        weight_lex: float = WEIGHT_LEXICAL,
    ) -> Column:
        return composite_score(*map(F.lit, astuple(self)), weight_emb, weight_lex)

    def save(self, spark: SparkSession, path: str):
        """Freezes the scale as a table of one row, for streams and later runs."""
        row = spark.createDataFrame([astuple(self)], SCALE)
        row.coalesce(1).write.mode("overwrite").parquet(path)


SCALE = "emb_mean double, emb_std double, lex_mean double, lex_std double"


def read_scale(spark: SparkSession, path: str) -> DataFrame:
    """The stored scale; a table that has not exactly one row is refused."""
    scale = spark.read.schema(SCALE).parquet(path)
    if len(scale.limit(2).collect()) != 1:
        raise ValueError(f"{path} is no scale of one row")
    return scale


def composite_score(
    emb_mean: Column, emb_std: Column, lex_mean: Column, lex_std: Column,
    weight_emb: float = WEIGHT_EMBEDDING, weight_lex: float = WEIGHT_LEXICAL,
) -> Column:
    """Weighted sum of the two scores on their scales; a deviation of zero divides by one."""
    def z(score, mean, std):
        return (F.col(score) - mean) / F.coalesce(F.nullif(std, F.lit(0.0)), F.lit(1.0))

    return F.lit(weight_emb) * z("emb_score", emb_mean, emb_std) + F.lit(weight_lex) * z("lex_score", lex_mean, lex_std)


def _moments(name: str) -> list[Column]:
    value = F.col(name)
    return [F.avg(value).alias(f"{name}_mean"), F.stddev_pop(value).alias(f"{name}_std")]


def standardize(df: DataFrame, names: Sequence[str], suffix: str = "_z") -> DataFrame:
    """Add z-scores by population deviation; a constant column gives zeros.

    The statistics are one scalar subquery: no join, and the rows stay in place.
    """
    moments = df.agg(
        F.struct(*[m for name in names for m in _moments(name)]).alias("m")
    ).scalar()
    spread = {n: F.coalesce(F.nullif(moments[f"{n}_std"], F.lit(0.0)), F.lit(1.0)) for n in names}
    return df.withColumns(
        {f"{n}{suffix}": (F.col(n) - moments[f"{n}_mean"]) / spread[n] for n in names}
    )


def row_ids(features: DataFrame, file_name: Column, position: Column) -> DataFrame:
    """Rows without an id get one from their file and position."""
    made = F.concat_ws("_", F.lit("row"), file_name, position.cast("string"))
    return features.withColumn("id", F.coalesce(F.nullif(F.col("id"), F.lit("")), made))


def score_features(features: DataFrame, model: ContrastModel) -> DataFrame:
    """Feature rows with an embedding, reduced to what the signal needs of them."""
    keep = [c for c in ("run_ts",) if c in features.columns]
    return features.filter(F.col("embedding").isNotNull()).select(
        "id", "date", model.score(F.col("embedding")).alias("emb_score"), *keep
    )


def score_texts(
    texts: DataFrame,
    positive: Sequence[str] = POSITIVE_WORDS,
    negative: Sequence[str] = NEGATIVE_WORDS,
) -> DataFrame:
    return texts.select(
        "id", "date", lexical_score(F.col("content"), positive, negative).alias("lex_score")
    )


def join_scores(
    features: DataFrame,
    texts: DataFrame,
    now: datetime | Column | None = None,
    dedupe_keys: bool = True,
) -> DataFrame:
    """Left join of scored features to scored texts, one row per post.

    Vectors and texts are scored before the join, so the shuffle carries numbers.
    With ``dedupe_keys`` each id counts once on either side: the latest feature
    run and the latest text. Without, repeated ids multiply, hot ones split.
    """
    texts = texts.withColumnRenamed("date", "text_date")
    if dedupe_keys:
        by = ["run_ts", "date", "emb_score"] if "run_ts" in features.columns else ["date", "emb_score"]
        features = last_per_key(features, ["id"], by)
        texts = last_per_key(texts, ["id"], ["text_date", "lex_score"])
        joined = features.join(texts, "id", "left")
    else:
        joined = skew_join(features, texts, ["id"], "left")
    return joined.select(
        "id",
        time_or_now(F.coalesce("date", "text_date"), now).alias("ts"),
        "emb_score",
        F.coalesce("lex_score", F.lit(0.0)).alias("lex_score"),
    )


def join_texts(
    features: DataFrame, texts: DataFrame, now: datetime | Column | None = None
) -> DataFrame:
    """The same join carrying the text itself: every feature column, ``content``, ``ts``."""
    texts = texts.withColumnRenamed("date", "text_date")
    joined = skew_join(features, texts, ["id"], "left")
    return joined.select(
        *[c for c in features.columns if c != "date"],
        F.coalesce("content", F.lit("")).alias("content"),
        time_or_now(F.coalesce("date", "text_date"), now).alias("ts"),
    )
