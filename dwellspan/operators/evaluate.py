"""Regression and interval reports, computed per split in grouped aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellspan.operators.ordered import quantiles
from dwellspan.operators.sampling import head_by

# Smallest denominator of the percentage error, and the miss quantiles reported.
EPSILON = 2.220446049250313e-16
MISS_QUANTILES = (0.05, 0.15, 0.25, 0.5, 0.75, 0.85, 0.90, 0.95)


def regression_report(
    df: DataFrame,
    y: str = "dom",
    yhat: str = "prediction",
    by: Sequence[str] = ("split",),
    features: int | None = None,
    digits: int | None = 5,
) -> DataFrame:
    """r2, mae, mse, rmse, median_ae, mape and (given the feature count) adjusted_r2 per group."""
    by = list(by)
    error = F.col(yhat) - F.col(y)
    scored = df.select(
        *by,
        F.col(y).cast("double").alias("y"),
        F.abs(error).cast("double").alias("abs_error"),
        (error * error).cast("double").alias("sq_error"),
    )
    n = F.count("y")
    spread = F.var_pop("y") * n
    moments = scored.groupBy(*by).agg(
        n.alias("n"),
        (1 - F.sum("sq_error") / F.nullif(spread, F.lit(0.0))).alias("r2"),
        F.avg("abs_error").alias("mae"),
        F.avg("sq_error").alias("mse"),
        F.sqrt(F.avg("sq_error")).alias("rmse"),
        F.avg(F.col("abs_error") / F.greatest(F.abs("y"), F.lit(EPSILON))).alias("mape"),
    )
    if features is not None:
        spare = F.nullif((F.col("n") - features - 1).cast("double"), F.lit(0.0))
        moments = moments.withColumn("adjusted_r2", 1 - (1 - F.col("r2")) * (F.col("n") - 1) / spare)
    medians = quantiles(scored, "abs_error", [0.5], by).select(*by, F.col("value").alias("median_ae"))
    report = moments.join(medians, by) if by else moments.withColumn("median_ae", medians.select("median_ae").scalar())
    if digits is None:
        return report
    shown = [c for c in report.columns if c not in by and c not in ("n", "mape")]
    return report.withColumns({c: F.round(c, digits) for c in shown})


def interval_report(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Coverage, mean length, counts by flag and median miss of rows carrying the interval columns."""
    by = list(by)
    share = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("within_interval").alias("inside"),
        F.avg(F.col("within_interval").cast("double")).alias("coverage"),
        F.avg("interval_length").alias("mean_length"),
    )
    medians = quantiles(df, "diff", [0.5], by).select(*by, F.col("value").alias("median_miss"))
    if by:
        return share.join(medians, by)
    return share.withColumn("median_miss", medians.select("median_miss").scalar())


def miss_quantiles(df: DataFrame, qs: Sequence[float] = MISS_QUANTILES) -> DataFrame:
    return quantiles(df, "diff", qs)


def residuals(df: DataFrame, y: str = "dom", yhat: str = "prediction", split: str = "split") -> DataFrame:
    """(split, y, prediction, residual): the data behind the residual and prediction-error charts."""
    return df.select(
        split,
        F.col(y).alias("y"),
        F.col(yhat).alias("prediction"),
        (F.col(yhat) - F.col(y)).alias("residual"),
    )


def interval_frame(df: DataFrame, n: int = 100, key: str = "listing_id") -> DataFrame:
    """First n rows by key with a running index: the data behind the interval chart."""
    head = head_by(df, [key], n)
    ordered = head.agg(F.sort_array(F.collect_list(F.struct(key, "true_dom", "lower_bound", "upper_bound"))).alias("rows"))
    return ordered.select(F.posexplode("rows").alias("index", "row")).select("index", "row.*")
