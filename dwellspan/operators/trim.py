"""Sequential quantile trimming, fitted on one table and applied to any."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwellspan.operators.ordered import WINDOW_ROWS, ranked_values
from dwellspan.session import small_table

# The trimming steps, each over the rows that the steps before it left.
STEPS = (("area", 0.95, "<"), ("area", 0.05, ">"), ("price", 0.95, "<"), ("price", 0.05, ">"))


def _keep(df: DataFrame, column: str, op: str, threshold: float | None) -> Column:
    """The comparison, with a literal of the column's own type, so that it reaches the scan."""
    kind = df.schema[column].dataType
    if threshold is None:
        return F.lit(False)
    if isinstance(kind, T.IntegralType):
        limit = F.lit(math.ceil(threshold) if op == "<" else math.floor(threshold)).cast(kind)
    else:
        limit = F.lit(threshold).cast("double")
    return F.col(column) < limit if op == "<" else F.col(column) > limit


def fit_trim(
    df: DataFrame, steps: Sequence[tuple[str, float, str]] = STEPS, window_rows: int = WINDOW_ROWS
) -> DataFrame:
    """Thresholds as a table (step, column, q, op, threshold). Steps on the same column share one
    ranked histogram, so the table is scanned once per column rather than once per step."""
    rows, number = [], 0
    for column, chain in groupby(steps, key=lambda s: s[0]):
        ranked = ranked_values(df, column, window_rows)
        for _, q, op in chain:
            threshold = ranked.quantile_filter(q, op)
            rows.append((number, column, float(q), op, threshold))
            df = df.where(_keep(df, column, op, threshold))
            number += 1
    return small_table(df.sparkSession, rows, "step int, column string, q double, op string, threshold double")


def apply_trim(df: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Filter by saved thresholds (one row per step); they become literals and reach the scan."""
    for row in sorted(thresholds.collect(), key=lambda r: r["step"]):
        df = df.where(_keep(df, row["column"], row["op"], row["threshold"]))
    return df


def trim_outliers(df: DataFrame, steps: Sequence[tuple[str, float, str]] = STEPS) -> DataFrame:
    return apply_trim(df, fit_trim(df, steps))
