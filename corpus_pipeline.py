"""From raw documents to packed training sequences, in five stages.

Each stage is one operator of ``crowdtide.llm`` on all that the stage before kept. Stages
hand on the columns of ``documents``; the last gives pieces of token ids.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from crowdtide.llm.common import shared_folder, stored, table
from crowdtide.llm.exact_dedup import DigestIndex, drop_copies
from crowdtide.llm.jaccard_join import one_of_each
from crowdtide.llm.language_id import UNKNOWN, LanguageModel
from crowdtide.llm.mixing import mixed_documents
from crowdtide.llm.packing import pack


#: Texts further from every profile are in no language that was learned. Of 51,282 documents
#: the furthest scores 0.40; letters at random score 0.0 to 0.2, other scripts 0.
LEAST_SCORE = 0.2


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters (null and empty texts too) and those whose nearest
    profile is too far. Profiles come from the rows that name a language; where none does,
    every document with letters stays."""
    model = LanguageModel.learn(docs)
    if not model.langs:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    found = model.predict(F.col("text"))
    return docs.filter((found["lang"] != UNKNOWN) & (found["score"] >= LEAST_SCORE))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each text, against an index that starts empty: the smallest id,
    null last. Null and empty texts are one text."""
    return drop_copies(docs, DigestIndex(spark, f"{shared_folder(spark)}/pipeline-index-{uuid.uuid4().hex}"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies: five words, similarity 0.8. Rows that
    share an id are judged by their own texts; texts without words all stay."""
    return one_of_each(docs, 5, 80)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each source to its target; a document that is taken twice is two rows. A null
    source is a source; rows that share an id are taken or left together within a source."""
    return mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids of power-of-two length; a null or empty text is one piece."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language),
    ("exact_dedup", exact),
    ("jaccard_join", near),
    ("mixing", mixture),
    ("packing", packed),
]

# Profiles, connected components and token ids are beyond SQL; the tests hold run()
# against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
