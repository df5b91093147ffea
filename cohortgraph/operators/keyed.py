"""One row per key: first wins, last wins, batch rules and keyed upserts.

All of them are aggregates with map-side partial results, so a key that holds a large
part of the table reaches its reducer as one row per task. Each value column is its own
aggregate: columns a query does not use are pruned before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _values(df: DataFrame, keys: list[str], cols: list[str] | None) -> list[str]:
    return [c for c in (cols or df.columns) if c not in keys]


def last_by(df: DataFrame, keys: list[str], order: Column | str, cols: list[str] | None = None, whole: bool = False) -> DataFrame:
    """Last row per key in ``order``; a NULL in that row stays NULL. ``whole``: all columns are asked for, so they are one aggregate."""
    order = F.col(order) if isinstance(order, str) else order
    if whole:
        values = _values(df, keys, cols)
        return df.groupBy(*keys).agg(F.max_by(F.struct(*values), order).alias("_last")).select(*keys, *[F.col(f"_last.{c}").alias(c) for c in values])
    return df.groupBy(*keys).agg(*[F.max_by(c, order).alias(c) for c in _values(df, keys, cols)])


def first_by(df: DataFrame, keys: list[str], order: Column | str, cols: list[str] | None = None) -> DataFrame:
    """First row per key in ``order``."""
    order = F.col(order) if isinstance(order, str) else order
    return df.groupBy(*keys).agg(*[F.min_by(c, order).alias(c) for c in _values(df, keys, cols)])


def dedup_first(df: DataFrame, key: str, order: str) -> DataFrame:
    """First row wins over the whole data set."""
    return first_by(df, [key], order)


def dedup_batched(df: DataFrame, key: str, order: str, batch: str) -> DataFrame:
    """First row wins inside a batch, the last batch wins overall."""
    inside = first_by(df, [key, batch], order)
    return last_by(inside, [key], batch)


def upsert(target: DataFrame, updates: DataFrame, keys: list[str], order: Column | str) -> DataFrame:
    """Insert or overwrite all columns of the updates, last update wins.

    Target rows rank below every update; a NULL in an update removes the value.
    """
    columns = target.columns
    order = F.col(order) if isinstance(order, str) else order
    old = target.withColumn("_rank", F.lit(0)).withColumn("_order", F.lit(None).cast(updates.select(order.alias("o")).schema["o"].dataType))
    new = updates.withColumn("_order", order).withColumn("_rank", F.lit(1)).select(*columns, "_rank", "_order")
    merged = old.unionByName(new)
    return last_by(merged, keys, F.struct("_rank", "_order"), columns).select(*columns)


def upsert_edges(
    edges: DataFrame,
    updates: DataFrame,
    ends: tuple[tuple[str, DataFrame, str], tuple[str, DataFrame, str]],
    order: Column | str,
) -> DataFrame:
    """Keyed edge upsert; an update counts only when both end points exist.

    ``ends`` gives (edge column, node table, node key) for source and destination.
    """
    kept = updates
    for column, nodes, key in ends:
        kept = kept.join(nodes.select(F.col(key).alias(column)), column, "left_semi")
    return upsert(edges, kept, [ends[0][0], ends[1][0]], order)
