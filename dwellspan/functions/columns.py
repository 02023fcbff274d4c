"""Column expressions shared by the operators; all stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_year_month(df: DataFrame, source: str = "published_at", name: str = "y_m") -> DataFrame:
    return df.withColumn(name, F.date_format(source, "yyyy-MM"))


def weekday(name: str) -> Column:
    """Monday = 0."""
    return F.weekday(name)


def recode(df: DataFrame, name: str, mapping: Mapping[str, str]) -> DataFrame:
    return df.replace(dict(mapping), subset=[name])


def onehot(df: DataFrame, name: str, categories: Iterable[str]) -> DataFrame:
    """One 0/1 column per given category, taken from the row itself; unknown or null: all zeros."""
    return df.withColumns(
        {c: F.coalesce(F.col(name) == F.lit(c), F.lit(False)).cast("int") for c in categories}
    )


def case_when(branches: Sequence[tuple[Column, Column]], default: Column | int = 0) -> Column:
    """First matching branch wins."""
    column = F.when(*branches[0])
    for condition, value in branches[1:]:
        column = column.when(condition, value)
    return column.otherwise(default)


def key_hash(key: str, seed: int | str) -> Column:
    """Hex digest of key and seed: the same for a row under any partitioning."""
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")))


def hash_bucket(key: str, seed: int | str) -> Column:
    """First 32 bits of the digest as a number."""
    return F.conv(F.substring(key_hash(key, seed), 1, 8), 16, 10).cast("bigint")


def hash_uniform(key: str, seed: int | str) -> Column:
    return hash_bucket(key, seed) / F.lit(4294967296.0)


def logcosh_quantile(y: Column, yhat: Column, alpha: float) -> tuple[Column, Column]:
    """Gradient and hessian of the log-cosh quantile loss. The inner weight is left out of both
    (no chain-rule factor): that is what the objective is defined to do."""
    error = yhat - y
    scaled = F.when(error < 0, error * F.lit(float(alpha))).otherwise(error * F.lit(1.0 - alpha))
    return F.tanh(scaled), F.lit(1.0) / (F.cosh(scaled) * F.cosh(scaled))


def interval_length(lower: str = "lower_bound", upper: str = "upper_bound") -> Column:
    return F.col(upper) - F.col(lower)


def within_interval(y: str = "true_dom", lower: str = "lower_bound", upper: str = "upper_bound") -> Column:
    return F.col(y).between(F.col(lower), F.col(upper))


def interval_miss(y: str = "true_dom", lower: str = "lower_bound", upper: str = "upper_bound") -> Column:
    """0 inside the interval, else the distance to the violated bound; below-lower is tested first."""
    return case_when(
        [
            (F.col(y) < F.col(lower), F.abs(F.col(lower) - F.col(y))),
            (F.col(y) > F.col(upper), F.abs(F.col(upper) - F.col(y))),
        ],
        F.lit(0.0),
    )


def interval_cols(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "interval_length": interval_length(),
            "within_interval": within_interval(),
            "diff": interval_miss(),
        }
    )
