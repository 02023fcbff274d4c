"""Parameters of the registered queries, and frames that several of them start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellspan.functions.columns import interval_cols
from dwellspan.operators.sampling import split3
from dwellspan.sources.listings import listings_view, staged_listings

# 14 months and 8 quarters covered by the given order tables.
DATA_MONTHS = (
    "1995-01", "1995-02", "1995-03", "1995-04", "1995-05", "1995-06", "1995-07",
    "1995-08", "1995-09", "1995-10", "1995-11", "1995-12", "1996-01", "1996-02",
)
DATA_QUARTERS = (
    (1999, 4), (2000, 1), (2000, 2), (2000, 3), (2000, 4), (2001, 1), (2001, 2), (2001, 3),
)
FRACTIONS = (0.7, 0.15, 0.15)
SPLIT_SEED = 50


def splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split3(listings_view(spark, sf_dir), FRACTIONS, SPLIT_SEED)


def staged_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split3(staged_listings(spark, sf_dir), FRACTIONS, SPLIT_SEED)


def baseline_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings with a split and, as the simplest model, the mean of their type group's training rows."""
    rows = staged_splits(spark, sf_dir)
    means = rows.where(F.col("split") == "train").groupBy("type_group_id").agg(
        F.round(F.avg("dom"), 3).alias("prediction"),
        F.round(F.stddev_pop("dom") * 0.8, 3).alias("half"),
    )
    return rows.join(means, "type_group_id")


def baseline_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows with bounds around the baseline prediction and the interval columns."""
    rows = baseline_predictions(spark, sf_dir).where(F.col("split") == "test")
    return interval_cols(
        rows.select(
            "listing_id",
            (F.col("prediction") - F.col("half")).alias("lower_bound"),
            F.col("dom").alias("true_dom"),
            (F.col("prediction") + F.col("half")).alias("upper_bound"),
        )
    )
