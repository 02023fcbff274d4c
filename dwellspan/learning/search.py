"""Parameter search by seeded random trials; each trial is one distributed fit."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import fields, replace

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwellspan.learning.boosting import BinnedTable, BoostParams, fit_boosted
from dwellspan.learning.trees import TreeModel
from dwellspan.operators.evaluate import regression_report

# The search space, (kind, low, high); whole numbers include both ends.
SPACE = {
    "max_depth": ("int", 3, 29),
    "eta": ("real", 0.01, 0.2),
    "gamma": ("real", 0.0, 20.0),
    "subsample": ("real", 0.1, 1.0),
    "reg_alpha": ("real", 1.0, 200.0),
    "reg_lambda": ("real", 0.0, 10.0),
    "colsample_bytree": ("real", 0.1, 1.0),
    "colsample_bylevel": ("real", 0.1, 1.0),
    "min_child_weight": ("real", 1.0, 100.0),
    "n_estimators": ("int", 100, 999),
}


def sample_space(
    spark: SparkSession, n: int, seed: int, space: Mapping[str, tuple] = SPACE
) -> DataFrame:
    """n trials: (trial_id, one column per parameter), drawn from a digest of trial, name and seed."""
    trials = spark.range(n).select(F.col("id").cast("int").alias("trial_id"))
    columns = {}
    for name, (kind, low, high) in space.items():
        text = F.concat(F.col("trial_id").cast("string"), F.lit(f"|{name}|{seed}"))
        u = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)
        if kind == "int":
            columns[name] = (F.lit(low) + F.floor(u * (high - low + 1))).cast("int")
        else:
            columns[name] = F.lit(float(low)) + u * F.lit(float(high - low))
    return trials.withColumns(columns)


def search(
    df: DataFrame,
    table: BinnedTable,
    trials: DataFrame,
    base: BoostParams = BoostParams(patience=10),
    loss: str = "mae",
    label: str = "dom",
    parallel: int = 4,
) -> DataFrame:
    """Fit every trial on the shared binned table: early stopping looks at the validation split, the
    loss (`mae` or `median_ae`) at the test split of `df`. Returns the trials with their loss.

    `parallel` trials run at a time, each from its own driver thread and in its own scheduler pool, so that the small jobs of one fill the
    cores that another leaves idle (with `spark.scheduler.mode` FAIR pools share evenly). Results don't depend on it."""
    spark = df.sparkSession
    known = {f.name for f in fields(BoostParams)}
    names = [c for c in trials.columns if c in known]
    test = df.where(F.col("split") == "test")

    def run(trial: Row) -> tuple:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"trial-{trial['trial_id']}")
        model = fit_boosted(table, replace(base, **{n: trial[n] for n in names}))
        return (*(trial[c] for c in trials.columns), _loss(model, test, loss, label))

    with ThreadPoolExecutor(max(1, parallel)) as threads:
        rows = list(threads.map(inheritable_thread_target(spark)(run), trials.orderBy("trial_id").collect()))
    schema = T.StructType([*trials.schema.fields, T.StructField("loss", T.DoubleType())])
    return spark.createDataFrame(rows, schema)


def _loss(model: TreeModel, test: DataFrame, loss: str, label: str) -> float:
    scored = model.transform(test)
    if loss == "mae":
        return scored.agg(F.avg(F.abs(F.col("prediction") - F.col(label)))).first()[0]
    return regression_report(scored, label, by=(), digits=None).select(loss).first()[0]


def best_trial(results: DataFrame) -> DataFrame:
    """The trial with the smallest loss (the lowest id among equals)."""
    return results.orderBy("loss", "trial_id").limit(1)
