"""Arithmetic shared by the analytics questions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def round_to(c: Column, digits: int = 2) -> Column:
    """Half-up rounding spelled out on doubles, so that engines agree bit for bit."""
    scale = float(10**digits)
    return F.floor(c * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)


def pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """Percentage as double; NULL when the whole is zero."""
    return round_to(F.lit(100.0) * part / F.when(whole != 0, whole.cast("double")), digits)


def mean(c: Column, digits: int = 2) -> Column:
    return round_to(F.avg(c), digits)


def rates_by(
    df: DataFrame,
    keys: list[str],
    counts: dict[str, Column],
    rates: dict[str, tuple[str, str]] | None = None,
    total: str = "total",
    min_n: int = 0,
    extra: list[Column] | None = None,
) -> DataFrame:
    """Group, count rows and conditions, keep groups of at least ``min_n``, add percentages.

    ``rates`` maps an output name to ``(part, whole)`` count names. One shuffle with
    map-side partial counts, so a heavy key costs one row per task.
    """
    aggs = [F.count(F.lit(1)).alias(total)]
    aggs += [F.count_if(cond).alias(name) for name, cond in counts.items()]
    out = df.groupBy(*keys).agg(*aggs, *(extra or []))
    if min_n:
        out = out.filter(F.col(total) >= min_n)
    for name, (part, whole) in (rates or {}).items():
        out = out.withColumn(name, pct(F.col(part), F.col(whole)))
    return out


def share_of_total(
    df: DataFrame, keys: list[str], count: str = "n", share: str = "percentage", by: list[str] | None = None
) -> DataFrame:
    """Counts per key with the share of the whole (or of the ``by`` group).

    The whole is a scalar subquery; a window over the aggregated groups serves ``by``.
    """
    grouped = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count))
    whole = F.sum(count).over(Window.partitionBy(*by)) if by else grouped.agg(F.sum(count)).scalar()
    return grouped.withColumn(share, pct(F.col(count), whole))


def top_k(df: DataFrame, order: list[Column], k: int | None) -> DataFrame:
    """Ordered rows, the first ``k`` when given (TakeOrdered, no global sort)."""
    out = df.orderBy(*order)
    return out if k is None else out.limit(k)


def top_n_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """First ``n`` rows per group. Spark drops surplus rows before the shuffle (group limit)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)


def desc(*names: str) -> list[Column]:
    return [F.col(n).desc_nulls_last() for n in names]


def asc(*names: str) -> list[Column]:
    return [F.col(n).asc_nulls_last() for n in names]
