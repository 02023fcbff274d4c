"""Linear, forest, fast boosted and stacked regressors on `pyspark.ml`, and the learning curve."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellspan.functions.columns import hash_uniform
from dwellspan.learning.boosting import BoostParams
from dwellspan.learning.vectors import assemble
from dwellspan.operators.ordered import quantiles
from dwellspan.operators.sampling import with_fold
from dwellspan.session import materialise


# Fixed value: the deepest tree of pyspark.ml.
MAX_DEPTH = 30


def linear(label: str = "dom", **options) -> LinearRegression:
    """Ordinary least squares by the normal equations: one pass, state of features squared."""
    return LinearRegression(labelCol=label, regParam=0.0, solver="normal", **options)


def forest(label: str = "dom", numTrees: int = 100, maxDepth: int = MAX_DEPTH, seed: int = 0, **options) -> RandomForestRegressor:
    """Random forest; all features are tried at each split and trees grow as deep as `pyspark.ml` can, as the
    usual regression default has no limit."""
    return RandomForestRegressor(
        labelCol=label, numTrees=numTrees, maxDepth=maxDepth, seed=seed, featureSubsetStrategy="all", **options
    )


def fast_boosted(params: BoostParams, label: str = "dom", validation: str | None = None, **options) -> GBTRegressor:
    """Boosted trees of `pyspark.ml` for the squared error.

    Mapped: n_estimators, eta, max_depth, subsample, colsample_bylevel (per node there), min_child_weight (as
    whole rows), gamma (another scale), max_bins, seed. What it can't honour is an error: it starts from the mean,
    has no penalties on leaves and no column sample per tree, and stops by tolerance (`validation`), not patience."""
    unmet = {
        "objective": params.objective == "squared", "base_score": params.base_score == "mean",
        "reg_lambda": params.reg_lambda == 0, "reg_alpha": params.reg_alpha == 0,
        "colsample_bytree": params.colsample_bytree == 1, "patience": params.patience is None,
        "max_depth": params.max_depth <= MAX_DEPTH,
    }
    if wrong := [f"{name}={getattr(params, name)!r}" for name, met in unmet.items() if not met]:
        raise ValueError(f"the fast lane can't honour {', '.join(wrong)}; use fit_boosted")
    settings = dict(
        labelCol=label,
        maxIter=params.n_estimators,
        stepSize=params.eta,
        maxDepth=params.max_depth,
        subsamplingRate=params.subsample,
        featureSubsetStrategy=str(params.colsample_bylevel) if params.colsample_bylevel < 1 else "all",
        minInstancesPerNode=max(1, math.ceil(params.min_child_weight)),
        minInfoGain=params.gamma,
        maxBins=params.max_bins,
        seed=params.seed,
        **options,
    )
    if validation:
        settings["validationIndicatorCol"] = validation
    return GBTRegressor(**settings)


@dataclass
class StackedModel:
    features: tuple[str, ...]
    level0: list
    level1: object
    names: tuple[str, ...]
    passthrough: bool

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        rows = _predict(self.level0, assemble(df, self.features))
        inputs = [*self.names, *(self.features if self.passthrough else ())]
        rows = assemble(rows.drop("features"), inputs)
        return self.level1.copy().setPredictionCol(output).transform(rows).drop("features", *self.names)


def _predict(models: Sequence, df: DataFrame) -> DataFrame:
    for model in models:
        df = model.transform(df)
    return df


@dataclass
class Stacking:
    """Level-1 regressor over out-of-fold predictions of the level-0 estimators, with the original
    features next to them if `passthrough` is set."""

    features: Sequence[str]
    level0: dict[str, object]
    level1: object = None
    folds: int = 5
    passthrough: bool = True
    label: str = "dom"
    key: str = "listing_id"
    seed: int = 50
    _names: tuple[str, ...] = field(init=False, default=())

    def fit(self, df: DataFrame) -> StackedModel:
        names = tuple(f"_{n}" for n in self.level0)
        estimators = [e.copy().setPredictionCol(n) for e, n in zip(self.level0.values(), names)]
        needed = df.select(self.key, self.label, *[F.col(f"`{c}`") for c in self.features])
        rows = materialise(assemble(with_fold(needed, self.folds, self.seed, self.key), self.features), "folds")
        parts = None
        for fold in range(self.folds):
            rest, own = rows.where(F.col("fold") != fold), rows.where(F.col("fold") == fold)
            scored = _predict([e.fit(rest) for e in estimators], own)
            parts = scored if parts is None else parts.unionByName(scored)
        inputs = [*names, *(self.features if self.passthrough else ())]
        out_of_fold = materialise(assemble(parts.drop("features"), inputs), "stacked")
        level1 = (self.level1 or linear(self.label)).fit(out_of_fold)
        return StackedModel(
            tuple(self.features), [e.fit(rows) for e in estimators], level1, names, self.passthrough
        )


def learning_curve(
    df: DataFrame,
    fit: Callable[[DataFrame], object],
    fractions: Sequence[float],
    k: int = 5,
    label: str = "dom",
    key: str = "listing_id",
    seed: int = 50,
) -> DataFrame:
    """(fraction, fold, score): negative median absolute error on the held-out fold of a model trained
    on a growing hash prefix of the other folds. `fit` returns a model whose `transform` adds
    `prediction`."""
    spark: SparkSession = df.sparkSession
    rows = materialise(
        with_fold(df, k, seed, key).withColumn("_u", hash_uniform(key, f"{seed}/curve")), "curve"
    )
    scores = []
    for fraction in fractions:
        for fold in range(k):
            train = rows.where((F.col("fold") != fold) & (F.col("_u") < float(fraction))).drop("_u", "fold")
            held = fit(train).transform(rows.where(F.col("fold") == fold))
            errors = held.select(F.abs(F.col("prediction") - F.col(label)).alias("e"))
            scores.append((float(fraction), fold, -quantiles(errors, "e", [0.5]).first()["value"]))
    return spark.createDataFrame(scores, "fraction double, fold int, score double")
