"""Equi-joins that survive hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 0.01


def hot_keys(counted: DataFrame, key: str, count: str = "count", share: float = HOT_SHARE) -> list:
    """Keys that hold more than ``share`` of all rows: at most 1/share of them, whatever the size of the data."""
    total = counted.agg(F.sum(count)).first()[0] or 0
    return [r[0] for r in counted.where((F.col(count) > max(1.0, total * share)) & F.col(key).isNotNull()).select(key).collect()]


def lookup(rows: DataFrame, mapping: DataFrame, key: str, hot: list, how: str = "inner") -> DataFrame:
    """Join with a mapping of one row a key. The hot keys' entries, at most as many as ``hot``, are broadcast and their rows
    stay where they are; all others shuffle."""
    if not hot:
        return rows.join(mapping, key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    return (
        rows.where(is_hot)
        .join(F.broadcast(mapping.where(is_hot)), key, how)
        .unionByName(rows.where(~is_hot).join(mapping.where(~is_hot), key, how))
    )
