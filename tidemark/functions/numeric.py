"""Guarded arithmetic, reproducible rounding and binning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed import OUT_OF_RANGE


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Division that yields null, not an error or infinity, on a zero divisor."""
    return F.try_divide(col(numerator).cast("double"), col(denominator).cast("double"))


def round_half_up(c: Column | str, digits: int = 2) -> Column:
    """SQL rounding, once: ties away from zero on the shortest decimal form of a double."""
    return F.round(col(c), digits)


def round_half_even(c: Column | str, digits: int = 2) -> Column:
    """Round ties to the even digit in plain double arithmetic, which stays in generated code."""
    unit = float(10**digits)
    return F.rint(col(c) * unit) / unit


def pct(numerator: Column | str, denominator: Column | str) -> Column:
    return ratio(numerator, denominator) * 100


def rank_in(c: Column | str, ordered: Sequence[str]) -> Column:
    """1-based position of the value in a short fixed list, null when absent."""
    first, *rest = list(enumerate(ordered, start=1))
    out = F.when(col(c) == first[1], first[0])
    for rank, value in rest:
        out = out.when(col(c) == value, rank)
    return out


def cut(c: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins ``(edge[i], edge[i+1]]``; everything else gets the out-of-range label."""
    value = col(c)
    out = F.when(value.isNull() | (value <= edges[0]) | F.isnan(value.cast("double")), OUT_OF_RANGE)
    for edge, label in zip(edges[1:], labels):
        out = out.when(value <= edge, label)
    return out.otherwise(OUT_OF_RANGE)


def quantile_label(c: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label by inner quantile edges, right-closed; on duplicate edges the first label wins."""
    value = col(c)
    out = F.when(value.isNull() | F.isnan(value.cast("double")), OUT_OF_RANGE)
    for edge, label in zip(edges, labels):
        out = out.when(value <= F.lit(float(edge)), label)
    return out.otherwise(labels[-1])


def finite_or_zero(c: Column | str) -> Column:
    value = col(c).cast("double")
    bad = F.isnan(value) | (F.abs(value) == F.lit(float("inf")))
    return F.coalesce(F.when(~bad, value), F.lit(0.0))


def sigmoid(z: Column | str, bound: float = 35.0) -> Column:
    clipped = F.greatest(F.lit(-bound), F.least(F.lit(bound), col(z)))
    return 1 / (1 + F.exp(-clipped))


def ape(actual: Column | str, predicted: Column | str) -> Column:
    """Absolute percentage error with a floor under the divisor."""
    a, p = col(actual), col(predicted)
    return F.abs(p - a) / F.greatest(F.abs(a), F.lit(1e-12))


def symmetric_ape(actual: Column | str, predicted: Column | str) -> Column:
    a, p = col(actual), col(predicted)
    return F.abs(p - a) / F.greatest((F.abs(a) + F.abs(p)) / 2, F.lit(1e-12))


def count_if(condition: Column) -> Column:
    """Number of rows where the condition holds; 0, not null, on empty input."""
    return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).cast("bigint")
