import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from dwellspan.functions.columns import interval_cols
from dwellspan.operators import evaluate
from dwellspan.operators.features import (
    FeatureModel, build_features, fit_categories, fit_features, select_features, subpopulations,
)
from dwellspan.plans.data import DATA_MONTHS, DATA_QUARTERS
from dwellspan.schema import EUR_V2, TR_V2, feature_set
from dwellspan.session import new_path


def test_report_equals_numpy(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"split": rng.choice(["train", "test"], 500), "dom": rng.integers(1, 99, 500)})
    pdf["prediction"] = pdf["dom"] + rng.normal(0, 5, 500)
    got = evaluate.regression_report(spark.createDataFrame(pdf), digits=None, features=3).collect()
    for row in got:
        part = pdf[pdf["split"] == row["split"]]
        y, e = part["dom"], part["prediction"] - part["dom"]
        r2 = 1 - (e**2).sum() / ((y - y.mean()) ** 2).sum()
        assert row["n"] == len(part)
        assert row["r2"] == pytest.approx(r2)
        assert row["adjusted_r2"] == pytest.approx(1 - (1 - r2) * (len(part) - 1) / (len(part) - 4))
        assert row["mae"] == pytest.approx(e.abs().mean())
        assert row["rmse"] == pytest.approx(math.sqrt((e**2).mean()))
        assert row["median_ae"] == pytest.approx(e.abs().median())
        assert row["mape"] == pytest.approx((e.abs() / y).mean())


def test_percentage_error_of_zero_target_explodes(spark):
    df = spark.createDataFrame([(0, 1.0)], "dom int, prediction double")
    assert evaluate.regression_report(df, by=(), digits=None).first()["mape"] == pytest.approx(4.5e15, rel=0.01)


def test_report_without_groups(spark):
    df = spark.createDataFrame([(1, 2.0), (3, 3.0), (8, 4.0)], "dom int, prediction double")
    row = evaluate.regression_report(df, by=(), digits=None).first()
    assert row["median_ae"] == 1.0 and row["n"] == 3


def test_interval_report(spark):
    rows = [(1, 0.0, 5, 10.0), (2, 0.0, 20, 10.0), (3, 5.0, 1, 10.0), (4, 0.0, 0, 10.0)]
    df = interval_cols(spark.createDataFrame(rows, "listing_id int, lower_bound double, true_dom int, upper_bound double"))
    row = evaluate.interval_report(df).first()
    assert (row["n"], row["inside"], row["coverage"], row["median_miss"]) == (4, 2, 0.5, 2.0)
    frame = evaluate.interval_frame(df, 2).collect()
    assert [(r["index"], r["listing_id"]) for r in frame] == [(0, 1), (1, 2)]


def test_feature_order_is_that_of_the_named_sets(spark, listings):
    df = listings.drop("split")
    assert build_features(df, "EUR_V2").columns == ["listing_id", "dom", *EUR_V2]
    assert len(EUR_V2) == 12 and len(TR_V2) == 9
    assert len(feature_set("V1")) == 24 and len(feature_set("V1_EUR_SEARCH")) == 25
    assert select_features(df, "TR_V2").columns == list(TR_V2)


def test_fitted_features_keep_every_row_and_survive_saving(spark, listings):
    rows = listings.drop("split")
    train, new = rows.where("listing_id % 2 = 0"), rows.where("listing_id % 2 = 1").drop("dom")
    model = fit_features(train, "V1", months=DATA_MONTHS)
    scored = model.transform(new)
    assert scored.count() == new.count()
    assert "dom" not in scored.columns
    path = new_path(spark, "features")
    model.save(path)
    again = FeatureModel.load(spark, path).transform(new)
    assert again.exceptAll(scored).count() == 0 == scored.exceptAll(again).count()
    trimmed = model.transform(train, trim=True)
    assert 0 < trimmed.count() < train.count()


def test_categories_are_sorted(spark, listings):
    found = [r[0] for r in fit_categories(listings, "country_name").collect()]
    assert found == ["IT", "PT", "SP"]


def test_subpopulations(spark, listings):
    df = subpopulations(listings.drop("split"), 400, 22, DATA_QUARTERS)
    assert df.where(~F.col("country_name").isin("IT", "PT", "ES")).count() == 0
    assert df.select("year_published", "quarter_published").distinct().count() <= len(DATA_QUARTERS)
    assert df.where("price_bin is null or price_label is null").count() == 0
