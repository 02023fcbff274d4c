"""Batch scoring: features under the fitted state, then the model, keeping the listing key."""

from __future__ import annotations

from pyspark.sql import DataFrame

from dwellspan.learning.boosting import IntervalModel
from dwellspan.learning.trees import TreeModel
from dwellspan.operators.features import FeatureModel, build_features
from dwellspan.schema import KEY


def score(
    df: DataFrame, features: FeatureModel, model: TreeModel, refit: bool = False, key: str = KEY
) -> DataFrame:
    """(key, prediction) for every listing. `refit` learns thresholds and city scores from the batch
    itself and drops its outliers, as the older scoring jobs did."""
    if refit:
        ready = build_features(df, features.name, months=features.months, countries=features.countries)
    else:
        ready = features.transform(df)
    return model.transform(ready).select(key, "prediction")


def score_interval(df: DataFrame, features: FeatureModel, model: IntervalModel, key: str = KEY) -> DataFrame:
    return model.transform(features.transform(df)).select(key, "lower_bound", "upper_bound")
