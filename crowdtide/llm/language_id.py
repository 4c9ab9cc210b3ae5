"""Language identification by rank-order profiles.

A language's profile is the list of its most frequent character n-grams (one to three
code points, a word's edge counts as one) over all training texts. A document gets the
language to whose profile its own list has the least out-of-place distance: the sum, over
the document's n-grams, of how far the ranks differ, ``profile_size`` for one that the
profile lacks.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from crowdtide.llm.common import held_out, lean, plain_text, release, small_batches, table

PROFILE_SIZE = 400
UNKNOWN = "und"
EDGE = 32
CHUNK = 1 << 18  # code points that are counted at once


@functools.cache
def _tables():
    """For each code point: its lower case (if that is one code point), and whether it is a letter."""
    import numpy as np

    letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    lower = np.arange(0x110000, dtype=np.int32)
    for i in np.flatnonzero(letter).tolist():
        low = chr(i).lower()
        if len(low) == 1:
            lower[i] = ord(low)
    return lower, letter


def grams(text: str):
    """The n-grams of a text as numbers, 21 bits for a code point, with repeats."""
    import numpy as np

    lower, letter = _tables()
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    word = letter[points]
    a = np.where(word, lower[points], EDGE).astype(np.int64)
    edge = np.concatenate(([True], ~word, [True]))
    a = np.concatenate(([EDGE], a, [EDGE]))
    keep = ~(edge[1:] & edge[:-1])  # a run of edges is one
    a, edge = a[1:][keep], edge[1:][keep]
    if not len(a):
        return a
    a, edge = np.concatenate(([EDGE], a)), np.concatenate(([True], edge))
    two = a[:-1] << 21 | a[1:]
    three = two[:-1] << 21 | a[2:]
    return np.concatenate((a[~edge], two, three[~edge[1:-1]]))


def ranked(text: str, size: int):
    """The ``size`` most frequent n-grams of a text, most frequent first, ties by number."""
    import numpy as np

    # long texts are counted in pieces, so that memory follows the distinct n-grams
    parts = [np.unique(grams(text[i:i + CHUNK]), return_counts=True) for i in range(0, len(text), CHUNK)]
    if len(parts) > 1:
        found, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        counts = np.bincount(where, np.concatenate([p[1] for p in parts])).astype(np.int64)
    else:
        found, counts = parts[0] if parts else (np.empty(0, np.int64), np.empty(0, np.int64))
    return found[np.lexsort((found, -counts))[:size]]


def profiles(df: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = PROFILE_SIZE) -> DataFrame:
    """``lang, gram, rank`` from all rows with a language; rank 0 is the most frequent."""

    def count(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            langs = np.asarray(batch.column(0).to_pylist(), object)
            for lang in sorted(set(langs)):
                texts, waiting, n = batch.column(1), [], 0
                rows = np.flatnonzero(langs == lang)
                for i in rows:
                    text = texts[int(i)].as_py()
                    for j in range(0, len(text), CHUNK):
                        waiting.append(grams(text[j:j + CHUNK]))
                        n += len(waiting[-1])
                    if waiting and (n > 8 * CHUNK or i == rows[-1]):
                        found, counts = np.unique(np.concatenate(waiting), return_counts=True)
                        waiting, n = [], 0
                        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array(found, pa.int64()), pa.array(counts, pa.int64())], ["lang", "gram", "n"])

    learned = small_batches(df).filter(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), plain_text(F.col(text_col)).alias("text"))
    counts = learned.mapInArrow(lean(count), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    return counts.withColumn("rank", F.row_number().over(best) - 1).filter(F.col("rank") < size).select("lang", "gram", "rank")


class LanguageModel:
    """Profiles in the driver: ``size`` numbers for each language, broadcast to workers."""

    def __init__(self, rows: list, size: int = PROFILE_SIZE):
        import numpy as np

        self.size = size
        self.langs = sorted({r["lang"] for r in rows})
        self.grams = np.asarray(sorted({r["gram"] for r in rows}), np.int64)
        self.ranks = np.full((len(self.langs), len(self.grams) + 1), -1, np.int32)  # the last column: in no profile
        at = {lang: i for i, lang in enumerate(self.langs)}
        for r in rows:
            self.ranks[at[r["lang"]], np.searchsorted(self.grams, r["gram"])] = r["rank"]

    @classmethod
    def learn(cls, df: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = PROFILE_SIZE) -> LanguageModel:
        return cls(profiles(df, text_col, lang_col, size).collect(), size)

    def guess(self, text: str) -> tuple[str, float]:
        import numpy as np

        own = ranked(text, self.size)
        if not len(own) or not self.langs:
            return UNKNOWN, 0.0
        at = np.searchsorted(self.grams, own)
        at[at == len(self.grams)] = 0
        ranks = self.ranks[:, np.where(self.grams[at] == own, at, len(self.grams))]
        apart = np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(own)))).sum(axis=1)
        best = int(apart.argmin())  # ties: the smallest language
        return self.langs[best], 1.0 - float(apart[best]) / (self.size * len(own))

    def predict(self, text: Column) -> Column:
        """``struct<lang string, score double>``; ``und`` and 0 for a text without letters.

        The score is 1 less the distance as a part of the largest possible. Texts are read
        whole; null is a text without letters; without training rows all are ``und``.
        """
        shared = SparkSession.active().sparkContext.broadcast(self)

        @F.pandas_udf("lang string, score double")
        def guess(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            model = shared.value
            for texts in batches:
                yield pd.DataFrame([model.guess(t) for t in texts], columns=["lang", "score"])
            release()

        return guess(plain_text(text))


def identify(docs: DataFrame, train: DataFrame | None = None, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs``, all columns, with ``__language`` (struct lang, score) as learned from ``train``."""
    model = LanguageModel.learn(docs if train is None else train, text_col, lang_col)
    return docs.withColumn("__language", model.predict(F.col(text_col)))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out(F.col("doc_id"), 3, 1))
    found = identify(docs.select("doc_id", "text", "held_out"), docs.filter(~F.col("held_out")))
    return found.select("doc_id", "held_out", F.col("__language.lang").alias("lang_pred"), F.col("__language.score").alias("score"))
