"""Counts, extremes, profiles and per-group standardising."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Row count per distinct combination, nulls left out, most frequent first."""
    return (
        df.dropna(subset=list(columns)).groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), *columns)
    )


def column_max(df: DataFrame) -> DataFrame:
    """Largest value of every column, in one pass."""
    return df.agg(*[F.max(c).alias(c) for c in df.columns])


def profile(df: DataFrame) -> DataFrame:
    """(column, type, non_null, total) per column, from one aggregate."""
    counts = df.agg(F.count(F.lit(1)).alias("_total"), *[F.count(c).alias(c) for c in df.columns])
    rows = [
        F.struct(
            F.lit(name).alias("column"),
            F.lit(kind).alias("type"),
            F.col(name).alias("non_null"),
            F.col("_total").alias("total"),
        )
        for name, kind in df.dtypes
    ]
    return counts.select(F.inline(F.array(*rows)))


def zscore_by(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    groups: Sequence[tuple],
    name: str | None = None,
) -> DataFrame:
    """(value - mean) / population deviation within each listed group; null where the deviation is 0;
    rows of other groups are dropped. There is one row of statistics per listed group, so they are
    broadcast: the aggregate is combined before its shuffle and the rows themselves stay in place."""
    wanted = F.struct(*keys).isin([F.struct(*map(F.lit, g)) for g in groups])
    kept = df.where(wanted)
    stats = kept.groupBy(*keys).agg(
        F.avg(value).alias("_mean"), F.stddev_pop(value).alias("_sd")
    )
    z = (F.col(value) - F.col("_mean")) / F.nullif(F.col("_sd"), F.lit(0.0))
    return (
        kept.join(F.broadcast(stats), list(keys))
        .withColumn(name or f"{value}_z", z)
        .drop("_mean", "_sd")
    )
