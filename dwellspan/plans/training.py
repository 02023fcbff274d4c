"""Registered queries that train, explain, search, save and score models."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellspan.functions.columns import interval_cols
from dwellspan.learning.boosting import (
    BoostParams, IntervalModel, best_splits, bin_edges, bin_table, fit_boosted, fit_forest, fit_interval, forest_params,
    level_histogram,
)
from dwellspan.learning.ensemble import Stacking, fast_boosted, forest, learning_curve, linear
from dwellspan.learning.scoring import score, score_interval
from dwellspan.learning.search import best_trial, sample_space, search
from dwellspan.learning.trees import TreeModel, contributions, global_contributions, importance
from dwellspan.learning.vectors import assemble
from dwellspan.operators import evaluate
from dwellspan.operators.features import fit_features
from dwellspan.plans.catalog import query, rounded
from dwellspan.plans.data import DATA_MONTHS, staged_splits
from dwellspan.schema import EUR_V2, TR_V2, feature_set, request_schema
from dwellspan.session import materialise, new_path
from dwellspan.sources import sinks
from dwellspan.streaming.requests import validate
from dwellspan.streaming.scoring import request_stream, score_stream

# Parameters of the registered training runs; the SQL side reads the same values.
TREE_FEATURES = ("price", "area", "has_lift", "type_group_id")
BINS = 8
SQUARED = BoostParams(
    n_estimators=2, max_depth=2, eta=0.3, reg_lambda=2.5, reg_alpha=5.0, gamma=1.0, min_child_weight=14.0
)
STUMPS = replace(SQUARED, max_depth=1)
EXPLAINED = replace(SQUARED, max_depth=4)
FOREST = forest_params(5, 5, seed=11)
STOPPING = replace(SQUARED, n_estimators=4, max_depth=1, eta=1.6, patience=1)
UPPER = BoostParams(
    objective="logcosh", alpha=0.95, base_score="quantile", n_estimators=2, max_depth=2, eta=0.05,
    reg_lambda=2.5, reg_alpha=4.5, gamma=0.5, min_child_weight=0.5,
)
DEEP = replace(SQUARED, n_estimators=10, max_depth=6, gamma=2000.0, min_child_weight=5.0)
SAMPLED = replace(SQUARED, subsample=0.9, colsample_bytree=0.75, colsample_bylevel=0.7, seed=123, n_estimators=3)
LOWER = replace(UPPER, alpha=0.05, eta=0.15, max_depth=1, reg_lambda=1.5)
SMALL_SPACE = {
    "max_depth": ("int", 1, 3),
    "eta": ("real", 0.1, 0.5),
    "gamma": ("real", 0.0, 20.0),
    "subsample": ("real", 0.1, 1.0),
    "reg_alpha": ("real", 1.0, 200.0),
    "reg_lambda": ("real", 0.0, 10.0),
    "colsample_bytree": ("real", 0.1, 1.0),
    "colsample_bylevel": ("real", 0.1, 1.0),
    "min_child_weight": ("real", 1.0, 100.0),
    "n_estimators": ("int", 1, 3),
}
TRIALS, TRIAL_SEED = 2, 7
TRIAL_BASE = BoostParams(patience=10)
CURVE, FOLDS = (0.25, 0.5, 1.0), 5
V1 = feature_set("V1", DATA_MONTHS)
V1_PARAMS = replace(SQUARED, n_estimators=1)
V1_BINS = 4


def binned(rows: DataFrame, features=TREE_FEATURES, bins: int = BINS, label: str = "dom"):
    edges = bin_edges(rows.where(F.col("split") == "train"), features, bins, exact=True)
    return bin_table(rows, features, label, edges=edges)


def trained(rows: DataFrame, params: BoostParams = SQUARED, features=TREE_FEATURES, bins: int = BINS) -> TreeModel:
    return fit_boosted(binned(rows, features, bins), params)


def _predictions(model: TreeModel, rows: DataFrame) -> DataFrame:
    return rounded(model.transform(rows).select("listing_id", "split", "prediction"))


@query("j2_split_histogram")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = staged_splits(spark, d)
    table = binned(rows)
    types = rows.select(F.col("listing_id").alias("key"), F.col("contact_type_id").alias("node"))
    nodes = table.rows.where(F.col("split") == "train").join(types, "key")
    ready = nodes.select("node", "b", (F.lit(0.5) - F.col("y")).alias("g"), F.lit(1.0).alias("h"))
    best = best_splits(level_histogram(ready), SQUARED)
    return rounded(best.select("node", "feature", "bin", "gain", "g", "h", "gl", "hl"), 5)


@query("j3_train_gbt")
def _(spark, d):
    rows = staged_splits(spark, d)
    return _predictions(trained(rows), rows)


def with_holes(rows: DataFrame) -> DataFrame:
    """Areas missing for every fifth value of the label, so that being missing tells something."""
    return rows.withColumn("area", F.when(F.col("dom") % 5 != 0, F.col("area")))


@query("j3_train_gbt_missing")
def _(spark, d):
    rows = with_holes(staged_splits(spark, d))
    return _predictions(trained(rows), rows)


@query("j3_train_gbt_deep")
def _(spark, d):
    rows = staged_splits(spark, d)
    return _predictions(trained(rows, DEEP), rows)


@query("j3_train_gbt_sampled")
def _(spark, d):
    rows = staged_splits(spark, d)
    return _predictions(trained(rows, SAMPLED, TR_V2), rows)


@query("j3_train_gbt_fast_lane")
def _(spark, d):
    rows = materialise(assemble(staged_splits(spark, d), TR_V2).select("listing_id", "split", "dom", "features"), "vectors")
    params = BoostParams(n_estimators=3, max_depth=3, eta=0.3, max_bins=32, seed=123, reg_lambda=0.0, base_score="mean")
    model = fast_boosted(params).fit(rows.where(F.col("split") == "train"))
    return evaluate.regression_report(model.transform(rows), features=len(TR_V2))


@query("j4_early_stopping")
def _(spark, d):
    rows = staged_splits(spark, d)
    return _predictions(trained(rows, STOPPING), rows)


@query("h10_eval_curve")
def _(spark, d):
    return rounded(trained(staged_splits(spark, d)).history_table(spark))


@query("j5_train_interval")
def _(spark, d):
    rows = staged_splits(spark, d)
    model = fit_interval(binned(rows), 0.95, UPPER, LOWER)
    test = model.transform(rows.where(F.col("split") == "test")).withColumn("true_dom", F.col("dom"))
    scored = interval_cols(test)
    return rounded(
        scored.select(
            "listing_id", "lower_bound", "true_dom", "upper_bound", "interval_length", "within_interval", "diff"
        ),
        4,
    )


@query("j6_train_linear")
def _(spark, d):
    rows = materialise(assemble(staged_splits(spark, d), TR_V2).select("listing_id", "split", "dom", "features"), "vectors")
    model = linear().fit(rows.where(F.col("split") == "train"))
    return evaluate.regression_report(model.transform(rows), features=len(TR_V2))


@query("j6_train_linear_one_variable")
def _(spark, d):
    rows = materialise(assemble(staged_splits(spark, d), ["area"]).select("split", "price", "features"), "vectors")
    model = linear("price").fit(rows.where(F.col("split") == "train"))
    scored = model.transform(rows)
    return scored.groupBy("split").agg(F.round(F.avg("prediction"), 3).alias("mean_prediction"))


@query("j6_train_linear_two_variables")
def _(spark, d):
    names = ["area", "type_group_id"]
    rows = materialise(assemble(staged_splits(spark, d), names).select("listing_id", "split", "dom", "features"), "vectors")
    model = linear().fit(rows.where(F.col("split") == "train"))
    return rounded(model.transform(rows).select("listing_id", "prediction"), 4)


@query("j7_train_forest")
def _(spark, d):
    rows = staged_splits(spark, d)
    return _predictions(fit_forest(binned(rows, TR_V2), FOREST.n_estimators, FOREST.max_depth, seed=FOREST.seed), rows)


@query("j7_train_forest_fast_lane")
def _(spark, d):
    rows = materialise(assemble(staged_splits(spark, d), TR_V2).select("listing_id", "split", "dom", "features"), "vectors")
    model = forest(numTrees=5, maxDepth=5).fit(rows.where(F.col("split") == "train"))
    return evaluate.regression_report(model.transform(rows), features=len(TR_V2))


@query("j8_train_stacking")
def _(spark, d):
    rows = staged_splits(spark, d)
    level0 = {
        "lr": linear(),
        "rfr": forest(numTrees=3, maxDepth=4),
        "gbt": fast_boosted(
            BoostParams(n_estimators=2, max_depth=3, subsample=0.33, eta=0.01, max_bins=32, reg_lambda=0.0, base_score="mean")
        ),
    }
    model = Stacking(TR_V2, level0, folds=FOLDS).fit(rows.where(F.col("split") == "train"))
    return evaluate.regression_report(model.transform(rows), features=len(TR_V2))


@query("j8_train_stacking_linear")
def _(spark, d):
    rows = staged_splits(spark, d)
    stack = Stacking(["area"], {"lr": linear("price")}, folds=FOLDS, passthrough=False, label="price")
    model = stack.fit(rows.where(F.col("split") == "train"))
    return rounded(model.transform(rows).select("listing_id", "prediction"), 3)


@query("j9_hyperparameter_search")
def _(spark, d):
    rows = staged_splits(spark, d)
    trials = sample_space(spark, TRIALS, TRIAL_SEED, SMALL_SPACE)
    return rounded(search(rows, binned(rows), trials, TRIAL_BASE))


@query("j9_best_trial")
def _(spark, d):
    rows = staged_splits(spark, d)
    trials = sample_space(spark, TRIALS, TRIAL_SEED, SMALL_SPACE)
    return rounded(best_trial(search(rows, binned(rows), trials, TRIAL_BASE, loss="median_ae")))


@query("j11_feature_importance_weight")
def _(spark, d):
    return importance(trained(staged_splits(spark, d)), spark, "weight")


@query("j11_feature_importance_gain")
def _(spark, d):
    return rounded(importance(trained(staged_splits(spark, d)), spark, "gain"))


@query("j12_shap_contributions")
def _(spark, d):
    rows = staged_splits(spark, d)
    return rounded(contributions(trained(rows, EXPLAINED), rows))


@query("j12_shap_global")
def _(spark, d):
    rows = staged_splits(spark, d)
    return rounded(global_contributions(trained(rows, EXPLAINED), rows))


@query("j12_shap_sums_to_prediction")
def _(spark, d):
    """Contributions of deeper trees: their sum next to the prediction, per row."""
    rows = staged_splits(spark, d)
    model = trained(rows)
    phi = contributions(model, rows)
    total = sum((F.col(c) for c in TREE_FEATURES), F.col("expected_value"))
    return rounded(phi.select("listing_id", total.alias("prediction")))


@query("h12_learning_curve")
def _(spark, d):
    rows = assemble(staged_splits(spark, d), ["area"]).select("listing_id", "price", "features")
    return rounded(learning_curve(rows, linear("price").fit, CURVE, k=FOLDS, label="price"), 3)


@query("a7_model_save_load")
def _(spark, d):
    rows = staged_splits(spark, d)
    path = new_path(spark, "model")
    trained(rows).save(path)
    return _predictions(TreeModel.load(spark, path), rows)


# ---- scoring -----------------------------------------------------------------------------------


def _v1_model(spark: SparkSession, d: str):
    rows = staged_splits(spark, d)
    train = rows.where(F.col("split") == "train").drop("split")
    features = fit_features(train, "V1", months=DATA_MONTHS)
    ready = materialise(features.transform(train, trim=True).withColumn("split", F.lit("train")), "features")
    return rows.drop("split", "dom"), features, ready


@query("k1_score_batch")
def _(spark, d):
    test, features, ready = _v1_model(spark, d)
    return rounded(score(test, features, trained(ready, V1_PARAMS, V1, V1_BINS)))


@query("k1_score_batch_refit")
def _(spark, d):
    test, features, ready = _v1_model(spark, d)
    return rounded(score(test, features, trained(ready, V1_PARAMS, V1, V1_BINS), refit=True))


def _eur_rows(spark: SparkSession, d: str, name: str = "EUR_V2") -> DataFrame:
    """Features of all listings under state fitted on the training split, with split and target."""
    rows = staged_splits(spark, d)
    features = fit_features(rows.where(F.col("split") == "train").drop("split"), name, trim=False)
    return materialise(features.transform(rows).join(rows.select("listing_id", "split"), "listing_id"), "features")


@query("k2_score_interval")
def _(spark, d):
    rows = staged_splits(spark, d)
    features = fit_features(rows.where(F.col("split") == "train").drop("split"), "TR_V2", trim=False)
    model = fit_interval(binned(rows, TR_V2), 0.95, UPPER, LOWER)
    path = new_path(spark, "intervals")
    model.save(path)
    test = rows.where(F.col("split") == "test").drop("split", "dom")
    return rounded(score_interval(test, features, IntervalModel.load(spark, path)), 4)


def _bodies(rows: DataFrame, market: str) -> DataFrame:
    """One JSON body per row; some are cut off, lack a field or carry text in a number field."""
    names = request_schema(market).fieldNames()
    names = [F.col("listing_id").cast("string").alias("request_id"), *names]
    good = F.to_json(F.struct(*names))
    lacking = F.to_json(F.struct(*[n for n in names if not isinstance(n, str) or n != "area"]))
    worded = F.to_json(F.struct(*[F.lit("many").alias(n) if isinstance(n, str) and n == "area" else n for n in names]))
    body = (
        F.when(F.col("listing_id") % 5 == 0, worded)
        .when(F.col("listing_id") % 7 == 0, lacking)
        .when(F.col("listing_id") % 11 == 0, F.substring(good, 1, 40))
        .otherwise(good)
    )
    return rows.select("listing_id", body.alias("value"))


@query("k3_validate_requests")
def _(spark, d):
    return validate(_bodies(_eur_rows(spark, d), "EUR"), "EUR")[0]


@query("k3_rejected_requests")
def _(spark, d):
    return validate(_bodies(_eur_rows(spark, d, "TR_V2"), "TR"), "TR")[1].select("listing_id")


def _streamed(spark: SparkSession, rows: DataFrame, model, market: str) -> str:
    """Write the test rows as request files, stream them through the model, return the output folder."""
    inbox, folder = new_path(spark, "inbox"), new_path(spark, "stream")
    _bodies(rows.where(F.col("split") == "test"), market).select("value").repartition(4).write.text(inbox)
    stream = score_stream(request_stream(spark, inbox, files_per_batch=2), model, market, folder)
    stream.awaitTermination()
    return folder


def _stream_output(spark: SparkSession, folder: str, digits: int = 6) -> DataFrame:
    return rounded(spark.read.parquet(f"{folder}/predictions").drop("batch_id"), digits)


@query("k4_score_stream_point_eur")
def _(spark, d):
    rows = _eur_rows(spark, d)
    return _stream_output(spark, _streamed(spark, rows, trained(rows, SQUARED, EUR_V2), "EUR"))


@query("k4_score_stream_point_tr")
def _(spark, d):
    rows = _eur_rows(spark, d, "TR_V2")
    return _stream_output(spark, _streamed(spark, rows, trained(rows, SQUARED, TR_V2), "TR"))


@query("k5_score_stream_interval")
def _(spark, d):
    rows = _eur_rows(spark, d)
    model = fit_interval(binned(rows, EUR_V2), 0.95, UPPER, LOWER)
    return _stream_output(spark, _streamed(spark, rows, model, "EUR"), 4)


@query("a8_sink_request_metrics")
def _(spark, d):
    rows = _eur_rows(spark, d, "TR_V2")
    folder = _streamed(spark, rows, trained(rows, STUMPS, TR_V2), "TR")
    timed = sinks.read_metrics(spark, f"{folder}/metrics")
    return timed.agg(
        F.sum("answered").alias("answered"), F.sum("rejected").alias("rejected"), F.min(F.col("process_time") > 0).alias("timed")
    )
