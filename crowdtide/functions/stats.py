"""Window statistics and the trade decision."""

from __future__ import annotations

import math
from functools import lru_cache
from statistics import NormalDist

from pyspark.sql import Column, functions as F

from crowdtide.fixed_values import CONFIDENCE, THRESHOLD

T_TABLE_SIZE = 200


def _t_central_probability(t: float, df: int) -> float:
    """P(|T| <= t) for whole df: the finite trigonometric series of
    Abramowitz and Stegun, 26.7.3 (odd) and 26.7.4 (even)."""
    angle = math.atan(t / math.sqrt(df))
    sine, cosine = math.sin(angle), math.cos(angle)
    odd = df % 2
    term, total = (cosine if odd else 1.0), 0.0
    for k in range(1, (df - odd) // 2 + 1):
        total += term
        term *= cosine * cosine * ((2 * k) / (2 * k + 1) if odd else (2 * k - 1) / (2 * k))
    return 2 / math.pi * (angle + sine * total) if odd else sine * total


@lru_cache(maxsize=None)
def t_quantiles(confidence: float = CONFIDENCE, size: int = T_TABLE_SIZE) -> tuple[float, ...]:
    """Two-sided Student-t critical values for df = 1..size, by bisection."""
    out = []
    for df in range(1, size + 1):
        low, high = 0.0, 1.0
        while _t_central_probability(high, df) < confidence:
            high *= 2
        for _ in range(70):
            middle = (low + high) / 2
            if _t_central_probability(middle, df) < confidence:
                low = middle
            else:
                high = middle
        out.append((low + high) / 2)
    return tuple(out)


def t_expansion_terms(confidence: float = CONFIDENCE) -> tuple[float, ...]:
    """z and the coefficients of 1/df .. 1/df^4 in the Cornish-Fisher expansion."""
    z = NormalDist().inv_cdf((1 + confidence) / 2)
    return (
        z,
        (z**3 + z) / 4,
        (5 * z**5 + 16 * z**3 + 3 * z) / 96,
        (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384,
        (79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / 92160,
    )


def t_critical(df: Column, confidence: float = CONFIDENCE) -> Column:
    """Critical value for whole df >= 1: the table as a literal, then the expansion."""
    table = F.lit(list(t_quantiles(confidence)))
    inverse = F.lit(1.0) / df.cast("double")
    series = F.lit(0.0)
    for coefficient in reversed(t_expansion_terms(confidence)):
        series = series * inverse + F.lit(coefficient)
    return F.when(df <= T_TABLE_SIZE, F.get(table, (df - 1).cast("int"))).otherwise(series)


def standard_error(value: Column) -> Column:
    """Aggregate: sample deviation over the root of the row count; 0 for one row."""
    spread = F.stddev_samp(value) / F.sqrt(F.count(F.lit(1)).cast("double"))
    return F.coalesce(spread, F.lit(0.0))


def half_width(n: Column, sem: Column, confidence: float = CONFIDENCE) -> Column:
    """Half the confidence interval of a window mean; 0 below two rows."""
    return F.when(n > 1, t_critical(n - 1, confidence) * sem).otherwise(F.lit(0.0))


def share_where(condition: Column) -> Column:
    """Aggregate: fraction of rows where the condition holds, NULL counting as no.

    Averaged as double; a decimal average would round before the threshold.
    """
    return F.avg(F.coalesce(condition, F.lit(False)).cast("int").cast("double"))


def trade_action(positive: Column, negative: Column, threshold: float = THRESHOLD) -> Column:
    """Mostly bullish means SHORT, mostly bearish means LONG, else HOLD."""
    limit = F.lit(float(threshold))
    return (
        F.when((positive >= limit) & (positive > negative), F.lit("SHORT"))
        .when((negative >= limit) & (negative > positive), F.lit("LONG"))
        .otherwise(F.lit("HOLD"))
    )
