import pytest
from pyspark.sql import functions as F

from dwellspan.learning.boosting import BoostParams, bin_table
from dwellspan.learning.ensemble import Stacking, fast_boosted, forest, learning_curve, linear
from dwellspan.learning.search import SPACE, best_trial, sample_space, search
from dwellspan.learning.vectors import assemble

FEATURES = ("area", "has_lift", "type_group_id")


@pytest.fixture(scope="module")
def rows(listings):
    return listings.withColumn(
        "label", 100.0 + 3 * F.col("area") + 50 * F.col("has_lift").cast("int") + F.col("type_group_id")
    )


def error(df):
    return df.agg(F.avg(F.abs(F.col("prediction") - F.col("label")))).first()[0]


def test_assembling_a_null_is_an_error(spark):
    df = spark.createDataFrame([(1, None)], "a int, b int")
    with pytest.raises(Exception):
        assemble(df, ["a", "b"]).collect()


def test_linear_recovers_the_coefficients(rows):
    model = linear("label").fit(assemble(rows, FEATURES))
    assert list(model.coefficients) == pytest.approx([3, 50, 1])
    assert model.intercept == pytest.approx(100)


def test_forest_and_fast_boosting_learn(rows):
    vectors = assemble(rows, FEATURES).cache()
    spread = vectors.agg(F.stddev_pop("label")).first()[0]
    for estimator in (
        forest("label", numTrees=4, maxDepth=6),
        fast_boosted(BoostParams(n_estimators=5, max_depth=4, max_bins=32, reg_lambda=0.0, base_score="mean"), "label"),
    ):
        assert error(estimator.fit(vectors).transform(vectors)) < spread / 3


def test_stacking_uses_out_of_fold_predictions_and_features(rows):
    level0 = {"lr": linear("label"), "rfr": forest("label", numTrees=2, maxDepth=3)}
    model = Stacking(FEATURES, level0, folds=3, label="label").fit(rows)
    assert len(model.level1.coefficients) == 2 + len(FEATURES)
    scored = model.transform(rows)
    assert set(scored.columns) == {*rows.columns, "prediction"}
    assert error(scored) < 1e-3
    bare = Stacking(FEATURES, level0, folds=3, passthrough=False, label="label").fit(rows)
    assert len(bare.level1.coefficients) == 2


def test_learning_curve(rows):
    vectors = assemble(rows, FEATURES).select("listing_id", "label", "features")
    curve = learning_curve(vectors, linear("label").fit, [0.5, 1.0], k=3, label="label").collect()
    assert len(curve) == 6
    assert all(-1e-6 < r["score"] <= 0 for r in curve)


def test_search_space_is_seeded_and_inside_its_bounds(spark):
    a = sample_space(spark, 300, 1)
    assert a.collect() == sample_space(spark, 300, 1).collect()
    assert a.collect() != sample_space(spark, 300, 2).collect()
    for name, (_, low, high) in SPACE.items():
        least, most = a.agg(F.min(name), F.max(name)).first()
        assert low <= least < most <= high
    assert a.agg(F.min("max_depth")).first()[0] == 3 and a.agg(F.max("max_depth")).first()[0] == 29


def test_search_returns_the_trial_with_the_least_loss(spark, rows):
    space = {"max_depth": ("int", 1, 3), "eta": ("real", 0.1, 0.9), "n_estimators": ("int", 1, 2)}
    trials = sample_space(spark, 2, 3, space)
    table = bin_table(rows, FEATURES, "label", max_bins=8)
    results = search(rows, table, trials, loss="median_ae", label="label", parallel=3).collect()
    assert results == search(rows, table, trials, loss="median_ae", label="label", parallel=1).collect()
    assert len(results) == 2 and all(r["loss"] > 0 for r in results)
    best = best_trial(spark.createDataFrame(results)).first()
    assert best["loss"] == min(r["loss"] for r in results)


def test_fast_lane_refuses_what_it_cannot_honour():
    with pytest.raises(ValueError, match="reg_lambda"):
        fast_boosted(BoostParams(base_score="mean"))
    with pytest.raises(ValueError, match="max_depth"):
        fast_boosted(BoostParams(base_score="mean", reg_lambda=0.0, max_depth=31))
