"""Toxicity by compression distance with zstandard dictionaries.

One dictionary is trained on ordinary text, one on the toxic passages of toxic text. A
window of a few words is compressed with the ordinary dictionary and with the toxic one
in front of it: what it is shorter by, in bytes, is what toxic text explains of the window
beyond ordinary text. Thresholds on these gains are calibrated on documents that the
dictionaries have not seen.

A label is of a whole document, of which toxic passages are a small part. They are found
as the words with letter sequences that toxic documents hold many times as often as
ordinary ones.
"""

from __future__ import annotations

import math
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from crowdtide.llm.common import held_out, plain_text, table

SAMPLE_ROWS = (2000, 4000)  # at most so many toxic and ordinary documents are learned from
SAMPLE_CHARS = (12_000_000, 16_000_000)  # and so many characters of them
TOXIC_BYTES, ORDINARY_BYTES = 4096, 65536  # trained; toxic words that are left out are added
WINDOW = 6  # words
SEQUENCE = 5  # letters; a word's start counts as one
SPREAD = 0.03  # of toxic documents hold a sequence, or it is in so many that chance is ruled out
CHANCE = 0.001  # probability that any of all sequences is taken by chance
RATIO = 12.0  # times as many as of the ordinary ones
THRESHOLD = 0.7
LONG = 64  # a document gives at most this part of the characters, in PIECES from all over it
PIECES = 16
LETTERS = re.compile(r"[^\W\d_]+")


def sequences(word: str):
    word = " " + word
    return {word[i:i + SEQUENCE] for i in range(max(1, len(word) - SEQUENCE + 1))}


def significant(n: int, others: int, part: float, tested: int) -> bool:
    """Whether ``n`` toxic beside ``others`` ordinary documents are more than chance gives where
    ``part`` of all are toxic, by Chernoff's bound over ``tested`` sequences."""
    k, share = n + others, n / (n + others)
    if not 0 < part < share:
        return False
    rest = (1 - share) * math.log((1 - share) / (1 - part)) if share < 1 else 0.0
    return k * (share * math.log(share / part) + rest) >= math.log(tested / CHANCE)


def dictionary(samples: list[bytes], size: int) -> bytes:
    """Trained content; the samples themselves where there is too little to train on."""
    import zstandard

    whole = b"".join(samples)
    if len(whole) <= 4 * size or len(samples) < 16:
        return whole[-size:]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return whole[-size:]


class ToxicityModel:
    """Two dictionaries and five calibrated numbers; workers get under 100 KB and the toxic words."""

    def __init__(self, toxic: bytes, ordinary: bytes, weights: list[float]):
        self.toxic, self.ordinary, self.weights = toxic, ordinary, weights

    def __getstate__(self):
        return self.toxic, self.ordinary, self.weights

    def __setstate__(self, state):
        self.toxic, self.ordinary, self.weights = state

    def _compressor(self, content: bytes):
        import zstandard as z

        # only matches of six bytes or more count: shorter ones are in any text
        log = max(17, (len(content) + 4096).bit_length())
        how = z.ZstdCompressionParameters.from_level(
            6, source_size=100, dict_size=len(content), strategy=z.STRATEGY_LAZY2, min_match=6, search_log=8,
            hash_log=log, chain_log=log, window_log=log, write_content_size=False, write_dict_id=False)
        if len(content) < 8:
            return z.ZstdCompressor(compression_params=how)
        return z.ZstdCompressor(dict_data=z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT), compression_params=how)

    def gains(self, text: str) -> tuple[int, int, int]:
        """Windows, windows with a gain, and the sum of gains."""
        if not hasattr(self, "pair"):
            self.pair = self._compressor(self.ordinary), self._compressor(self.toxic + self.ordinary)
        plain, both = self.pair
        windows = hits = total = 0
        words = text.lower().split()
        for i in range(0, len(words), WINDOW):
            # each word stands twice: zstandard then never leaves so short a window as it
            # is, which would hide what the toxic dictionary saves
            window = f" {' '.join(w for w in words[i:i + WINDOW] for _ in (0, 1))} ".encode("utf-8", "surrogatepass")
            gain = len(plain.compress(window)) - len(both.compress(window))
            windows += 1
            if gain > 0:
                hits += 1
                total += gain
        return windows, hits, total

    @staticmethod
    def features(windows: int, hits: int, total: int) -> list[float]:
        return [1.0, math.log1p(total), math.log1p(hits), math.log1p(windows), min(total / max(windows, 1), 3.0)]

    def score(self, text: str) -> float:
        if not self.weights:
            return 0.0
        at = sum(w * x for w, x in zip(self.weights, self.features(*self.gains(text))))
        return 1.0 / (1.0 + math.exp(-max(-40.0, min(40.0, at))))

    @classmethod
    def fit(cls, toxic: list[str], ordinary: list[str], prior: float) -> ToxicityModel:
        """From texts in the order given; ``prior`` is the part of toxic rows among all labelled."""
        import collections

        import numpy as np

        toxic, ordinary = list(dict.fromkeys(toxic)), list(dict.fromkeys(ordinary))
        if not toxic:
            return cls(b"", b"", [])
        train = [t.lower() for t in toxic[:max(1, 2 * len(toxic) // 3)]], [t.lower() for t in ordinary[:2 * len(ordinary) // 3]]
        seen = [collections.Counter(), collections.Counter()]
        for texts, counter in zip(train, seen):
            for text in texts:
                counter.update(set().union(*map(sequences, set(LETTERS.findall(text)))))
        part = len(train[0]) / (len(train[0]) + len(train[1]))
        marks = {s for s, n in seen[0].items() if n / len(train[0]) >= RATIO * (seen[1][s] + 0.5) / (len(train[1]) + 1)
                 and (n >= max(3, SPREAD * len(train[0])) or significant(n, seen[1][s], part, len(seen[0])))}
        words = [[w for w in LETTERS.findall(t) if not marks.isdisjoint(sequences(w))] for t in train[0]]
        passages = [f" {' '.join(found)} " for found in words if found]
        bad = dictionary([p.encode() for p in passages if len(p) > 8], TOXIC_BYTES)
        left = [w for w in dict.fromkeys(w for found in words for w in found) if f" {w} ".encode() not in bad]
        if left:
            bad = f" {' '.join(left)} ".encode() + bad
        model = cls(bad, dictionary([t.encode("utf-8", "surrogatepass") for t in train[1] if t], ORDINARY_BYTES), [])
        rest = [(t, 1) for t in toxic[len(train[0]):] or toxic] + [(t, 0) for t in ordinary[len(train[1]):] or ordinary]
        x = np.asarray([cls.features(*model.gains(t)) for t, _ in rest])
        y = np.asarray([label for _, label in rest], float)
        # logistic regression by Newton steps, each class with the weight it has among all rows
        weight = np.where(y == 1, prior / y.mean(), (1 - prior) / max(1e-9, 1 - y.mean())) * len(y)
        weight /= weight.sum() / len(y)
        w = np.zeros(x.shape[1])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            grad = x.T @ (weight * (y - p)) - 0.1 * w
            hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
            w = w + np.linalg.solve(hess, grad)
        return cls(model.toxic, model.ordinary, w.tolist())


def passages(text: Column, chars: int) -> Column:
    """The text, or where it is longer than ``chars``, pieces of it at even distances."""
    size = chars // PIECES
    pieces = F.concat_ws(" ", *[F.substring(text, (F.floor((F.length(text) - size) * i / (PIECES - 1)) + 1).cast("int"), F.lit(size)) for i in range(PIECES)])
    return F.when(F.length(text) <= chars, text).otherwise(pieces)


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> ToxicityModel:
    """A model from labelled documents.

    Rows without id or label are left out, a document with several labels is toxic if one
    says so. The sample, bounded by ``SAMPLE_ROWS`` and ``SAMPLE_CHARS``, is drawn by hash
    of the id over all labelled rows, and is joined by broadcast, as its size is bounded.
    """
    spark = docs.sparkSession
    marked = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()) \
        .groupBy(F.col(id_col).alias("__id")).agg((F.max(label_col) > 0).alias("__toxic"))
    prior = marked.agg(F.coalesce(F.avg(F.col("__toxic").cast("double")), F.lit(0.0)).alias("p")).first()["p"]
    order, texts = F.xxhash64(F.lit(2), "__id"), {}
    for toxic, rows, chars in zip((True, False), SAMPLE_ROWS, SAMPLE_CHARS):
        ids = marked.filter(F.col("__toxic") == toxic).orderBy(order, "__id").limit(rows)
        found = docs.join(F.broadcast(ids), docs[id_col] == ids["__id"]).select(order.alias("o"), passages(plain_text(F.col(text_col)), chars // LONG).alias("t"))
        texts[toxic], size = [], 0
        for row in found.orderBy("o", "t").toLocalIterator():
            # one that doesn't fit is passed over, the next may fit
            if size + len(row["t"]) <= chars:
                size += len(row["t"])
                texts[toxic].append(row["t"])
    return ToxicityModel.fit(texts[True], texts[False], prior)


def toxicity(text: Column, model: ToxicityModel) -> Column:
    """Score from 0 to 1 of the whole text; null is the empty text; 0 without a toxic row
    to learn from. Long texts are compressed window by window."""
    shared = SparkSession.active().sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.score(t) for t in texts], dtype="float64")

    return score(plain_text(text))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = held_out(F.col("doc_id"), 3, 1)
    model = learn(docs.filter(~out), labels.filter(~out))
    scored = docs.select("doc_id", out.alias("held_out"), toxicity(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
