"""Numeric column expressions used by several models."""

from __future__ import annotations

from pyspark.sql import Column, Window, functions as F

LOW, HIGH = 1.0, 5.0


def clip(x: Column, low: float = LOW, high: float = HIGH) -> Column:
    """``x`` within the scale; null stays null, which ``greatest`` alone would turn into ``low``."""
    return F.when(x.isNotNull(), F.least(F.lit(high), F.greatest(F.lit(low), x)))


def half_even(x: Column, digits: int) -> Column:
    """Rounds half to even; noise beyond nine digits does not decide a tie."""
    scale = float(10**digits)
    return F.rint(F.round(x, 9) * scale) / scale


def popularity(n: Column) -> Column:
    return F.log1p(n)


def quality(avg: Column, n: Column) -> Column:
    return avg * F.log1p(n)


def reliability(std: Column) -> Column:
    return 1 / (1 + std)


def engagement(users: Column, n: Column) -> Column:
    return users / F.greatest(n, F.lit(1))


def temporal_weight(year: Column, first: Column, last: Column) -> Column:
    return 0.5 + 0.5 * (year - first) / (last - first)


def linear_rating(sim: Column) -> Column:
    return 1 + 4 * sim


def sigmoid_rating(sim: Column) -> Column:
    return 1 + 4 / (1 + F.exp(-5 * (sim - 0.5)))


def offset_rating(sim: Column) -> Column:
    return 3 + 2 * sim


def top_n(df, keys, n: int, *order: Column, rank: str = "rank"):
    """The first ``n`` rows per key.

    A ``row_number() <= n`` filter lets Spark cut every map partition to ``n``
    rows per key before the shuffle, so a hot key never reaches one task whole.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def by_score(score: str, tie: str) -> list[Column]:
    """Score descending, id ascending; rounding keeps mathematical ties tied."""
    return [F.round(F.col(score), 9).desc(), F.col(tie).asc()]
