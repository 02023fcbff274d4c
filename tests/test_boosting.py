from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from dwellspan.learning import boosting, grow, trees
from dwellspan.learning.boosting import (
    BoostedTrees, BoostParams, IntervalModel, best_splits, bin_edges, bin_table, fit_boosted,
    fit_interval, level_histogram,
)
from dwellspan.learning.scoring import score
from dwellspan.learning.trees import TreeModel, contributions, global_contributions, importance
from dwellspan.operators.features import fit_features
from dwellspan.plans.data import DATA_MONTHS
from dwellspan.schema import feature_set
from dwellspan.session import materialise_bucketed, new_path

FEATURES = ("area", "price", "has_lift", "type_group_id")
PARAMS = BoostParams(n_estimators=3, max_depth=3, eta=0.3, max_bins=16)


@pytest.fixture(scope="module")
def learnable(listings):
    return listings.withColumn(
        "label", 100 + 3 * F.col("area") + 50 * F.col("has_lift").cast("int") + F.col("type_group_id") ** 2
    )


@pytest.fixture(scope="module")
def table(learnable):
    return bin_table(learnable, FEATURES, "label", max_bins=16)


@pytest.fixture(scope="module")
def model(table):
    return fit_boosted(table, PARAMS)


def test_single_split_worked_by_hand(spark):
    """x = 0 (missing), 1..4; y = 1, 1, 1, 9, 9. Base 0: g = -y, h = 1, lambda 1.
    Split between 2 and 3, missing left: 3^2/4 + 18^2/3 - 21^2/6 = 36.75; missing right:
    2^2/3 + 19^2/4 - 21^2/6 = 18.083..."""
    df = spark.createDataFrame(
        [(0, None, 1), (1, 1.0, 1), (2, 2.0, 1), (3, 3.0, 9), (4, 4.0, 9)], "listing_id int, x double, dom int"
    )
    t = bin_table(df, ["x"], split=None, edges=[[2.0, 3.0, 4.0]])
    rows = t.rows.select(F.lit(0).alias("node"), "b", (-F.col("y")).alias("g"), F.lit(1.0).alias("h"))
    best = best_splits(level_histogram(rows), BoostParams(reg_lambda=1.0)).first()
    assert (best["bin"], best["default_left"]) == (1, True)
    assert best["gain"] == pytest.approx(36.75)
    assert (best["gl"], best["hl"], best["cl"]) == (-3.0, 3.0, 3)
    m = fit_boosted(t, BoostParams(n_estimators=1, max_depth=1, base_score=0.0, eta=1.0), eval_splits=("train",), valid=None)
    got = {r["listing_id"]: r["prediction"] for r in m.transform(df).collect()}
    assert got == pytest.approx({0: 0.75, 1: 0.75, 2: 0.75, 3: 6.0, 4: 6.0})


def test_no_split_without_gain(spark):
    df = spark.createDataFrame([(i, float(i), 5) for i in range(6)], "listing_id int, x double, dom int")
    t = bin_table(df, ["x"], split=None, max_bins=4)
    m = fit_boosted(t, BoostParams(n_estimators=1, max_depth=3, base_score=5.0), eval_splits=("train",), valid=None)
    assert len(m.nodes) == 1
    assert {r["prediction"] for r in m.transform(df).collect()} == {5.0}


def test_training_error_falls_and_scoring_repeats_the_margins(table, learnable, model):
    train = [h["value"] for h in model.history if h["split"] == "train"]
    assert train == sorted(train, reverse=True) and train[-1] < 0.6 * train[0]
    scored = model.transform(learnable.where("split = 'train'"))
    mae = scored.agg(F.avg(F.abs(F.col("prediction") - F.col("label")))).first()[0]
    assert mae == pytest.approx(train[-1])


@pytest.mark.parametrize("partitions", [1, 4, 17])
def test_result_does_not_depend_on_partitions(table, learnable, model, partitions):
    moved = replace(table, rows=table.rows.repartition(partitions))
    other = fit_boosted(moved, PARAMS)
    pd.testing.assert_frame_equal(other.nodes, model.nodes, rtol=1e-9)


def test_small_scoring_chunks_and_passes_change_nothing(monkeypatch, learnable, model):
    plain = model.transform(learnable).orderBy("listing_id").toPandas()["prediction"]
    phi = contributions(model, learnable).orderBy("listing_id").toPandas()
    monkeypatch.setattr(trees, "NODES_PER_UDF", 1)
    monkeypatch.setattr(trees, "ROWS_AT_ONCE", 7)
    assert len(list(model._chunks())) == 3
    np.testing.assert_allclose(model.transform(learnable).orderBy("listing_id").toPandas()["prediction"], plain)
    again = contributions(model, learnable).orderBy("listing_id").toPandas()
    np.testing.assert_allclose(again, phi)


def test_contributions_sum_to_the_prediction(learnable, model):
    phi = contributions(model, learnable).toPandas().set_index("listing_id").sort_index()
    predicted = model.transform(learnable).toPandas().set_index("listing_id").sort_index()["prediction"]
    np.testing.assert_allclose(phi.sum(axis=1), predicted)
    top = global_contributions(model, learnable).collect()
    assert top[0]["feature"] == "area"
    assert top[0]["importance"] == pytest.approx(phi["area"].abs().mean())


def test_contributions_equal_the_definition(spark, learnable):
    """Shapley values by their definition: subsets of features known, the others averaged by cover."""
    from itertools import combinations
    from math import factorial

    deep = fit_boosted(bin_table(learnable, FEATURES, "label", max_bins=8), BoostParams(n_estimators=1, max_depth=7))
    rows = learnable.where("split = 'test'").limit(5)
    nodes = deep.nodes.set_index("node")

    def value(x, known, node=0):
        n = nodes.loc[node]
        if n["feature"] < 0:
            return n["leaf"]
        if int(n["feature"]) in known:
            side = n["left"] if x[int(n["feature"])] < n["threshold"] else n["right"]
            return value(x, known, int(side))
        parts = [(nodes.loc[int(n[s])]["cover"] / n["cover"], int(n[s])) for s in ("left", "right")]
        return sum(w * value(x, known, c) for w, c in parts)

    got = contributions(deep, rows).toPandas().set_index("listing_id")
    for r in rows.collect():
        x = [float(r[c]) for c in FEATURES]
        assert got.loc[r["listing_id"], "expected_value"] == pytest.approx(deep.base_score + value(x, set()))
        for j, name in enumerate(FEATURES):
            others = [i for i in range(4) if i != j]
            want = sum(
                factorial(k) * factorial(3 - k) / 24 * (value(x, {*s, j}) - value(x, set(s)))
                for k in range(4) for s in combinations(others, k)
            )
            assert got.loc[r["listing_id"], name] == pytest.approx(want, abs=1e-9)


def test_early_stopping_keeps_the_best_round(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"listing_id": range(600), "x": rng.normal(size=600), "dom": rng.integers(0, 100, 600)})
    pdf["split"] = np.where(pdf["listing_id"] % 3 == 0, "valid", "train")
    t = bin_table(spark.createDataFrame(pdf), ["x"], max_bins=64)
    m = fit_boosted(t, BoostParams(n_estimators=12, max_depth=4, eta=1.0, patience=2))
    valid = [h["value"] for h in m.history if h["split"] == "valid"]
    assert m.best_round == int(np.argmin(valid)) and len(valid) == m.best_round + 3 < 12
    scored = m.transform(spark.createDataFrame(pdf[pdf["split"] == "valid"]))
    mae = scored.agg(F.avg(F.abs(F.col("prediction") - F.col("dom")))).first()[0]
    assert mae == pytest.approx(min(valid))


def test_saved_model_predicts_the_same(spark, learnable, model):
    path = new_path(spark, "model")
    model.save(path)
    again = TreeModel.load(spark, path)
    pd.testing.assert_frame_equal(again.nodes, model.nodes)
    assert again.history == model.history
    a = model.transform(learnable).select("listing_id", "prediction")
    assert a.exceptAll(again.transform(learnable).select("listing_id", "prediction")).count() == 0


def test_importance(spark, model):
    weight = {r["feature"]: r["importance"] for r in importance(model, spark).collect()}
    assert sum(weight.values()) == (model.nodes["feature"] >= 0).sum()
    gain = [r["importance"] for r in importance(model, spark, "gain").collect()]
    assert sum(gain) == pytest.approx(1.0)


def test_interval_model_orders_its_bounds(spark, table, learnable):
    upper = BoostParams(n_estimators=4, max_depth=2, eta=0.3, min_child_weight=0.01, base_score="quantile")
    m = fit_interval(table, 0.95, upper, upper)
    assert m.upper.base_score > m.lower.base_score
    path = new_path(spark, "interval")
    m.save(path)
    rows = IntervalModel.load(spark, path).transform(learnable).select("lower_bound", "upper_bound")
    assert rows.where("lower_bound is null or upper_bound is null").count() == 0
    assert rows.agg(F.avg(F.col("upper_bound") - F.col("lower_bound"))).first()[0] > 0


def test_sampling_of_rows_and_columns_is_seeded(learnable):
    params = replace(PARAMS, subsample=0.6, colsample_bytree=0.5, colsample_bylevel=0.5, seed=9, n_estimators=2)
    a, b = (BoostedTrees(FEATURES, params, label="label").fit(learnable) for _ in range(2))
    pd.testing.assert_frame_equal(a.nodes, b.nodes)
    assert len(set(a.nodes.loc[(a.nodes["tree"] == 0) & (a.nodes["feature"] >= 0), "feature"])) <= 2


def test_exact_edges(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 2, 9, 4)], "x double")
    assert bin_edges(df, ["x"], 4, exact=True) == ((2.0, 4.0),)


def test_batch_scoring_with_and_without_refit(spark, listings):
    rows = listings.drop("split")
    features = fit_features(rows, "V1", months=DATA_MONTHS)
    ready = features.transform(rows, trim=True)
    m = BoostedTrees(feature_set("V1", DATA_MONTHS), replace(PARAMS, n_estimators=1), split=None)
    m = fit_boosted(bin_table(ready, m.features, split=None, max_bins=8), m.params, valid=None, eval_splits=("train",))
    new = rows.drop("dom")
    assert score(new, features, m).count() == rows.count()
    assert 0 < score(new, features, m, refit=True).count() < rows.count()


@pytest.mark.parametrize(("local_rows", "walk_levels"), [(0, 2), (0, 9), (60, 2), (10**9, 9)])
def test_deep_trees_do_not_depend_on_where_nodes_are_grown(monkeypatch, table, learnable, local_rows, walk_levels):
    """By the cluster, level by level, in tasks, or both; with columns and rows sampled."""
    params = BoostParams(n_estimators=2, max_depth=6, eta=0.5, subsample=0.8, colsample_bylevel=0.75, gamma=50.0, seed=3)
    plain = fit_boosted(table, params)
    assert len(plain.nodes) > 30
    monkeypatch.setattr(grow, "WALK_LEVELS", walk_levels)
    monkeypatch.setattr(grow, "LOCAL_ROWS", local_rows)
    other = fit_boosted(table, params)
    pd.testing.assert_frame_equal(other.nodes, plain.nodes, rtol=1e-9)
    scored = other.transform(learnable.where("split = 'train'"))
    mae = scored.agg(F.avg(F.abs(F.col("prediction") - F.col("label")))).first()[0]
    assert mae == pytest.approx([h["value"] for h in other.history if h["split"] == "train"][-1])


def _grown(table, params, local_rows):
    state = table.rows.withColumn("margin", F.lit(0.5))
    rows = state.select("row", F.lit(True).alias("learns"), (F.col("margin") - F.col("y")).alias("g"), F.lit(1.0).alias("h"), "b")
    chosen, levels = boosting.level_features(params, len(table.features), 0)
    return state, grow.grow_tree(rows, table.rows.count(), params, levels, chosen, 20, table.buckets, boosting.leaf_sql(params), local_rows)


def test_at_most_half_of_the_rows_are_summed_below_the_root(table):
    total = table.rows.count()
    _, tree = _grown(table, BoostParams(max_depth=5), 0)
    assert len(tree.summed) == 5 and all(0 < n <= total / 2 for n in tree.summed[:4]) and tree.summed[4] == 0
    _, all_levels = _grown(table, BoostParams(max_depth=5, colsample_bylevel=0.5), 0)  # here sums of fewer columns are cheaper
    assert all_levels.nodes.count() > 1


def test_margins_are_updated_without_a_shuffle(spark, monkeypatch, table):
    """Binned rows, margins and places are bucketed alike: only small tables of nodes are exchanged."""
    state, tree = _grown(table, BoostParams(max_depth=4), 200)
    margins, drop = materialise_bucketed(table.rows.select("row", F.lit(0.5).alias("margin")), "margins", "row", table.buckets)
    moved = tree.placed(table.rows.join(margins.hint("shuffle_hash"), "row")).select("row", "node", "margin")
    plan = moved._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ShuffledHashJoin") == 2 and "Bucketed: true" in plan
    assert "Exchange hashpartitioning(row" not in plan and "Sort [row" not in plan
    assert set(margins.columns) == {"row", "margin"} and "b" not in margins.columns
    assert moved.count() == table.rows.count() and moved.where("node is null").count() == 0
    drop()


def test_repeated_keys_and_empty_tables(spark):
    rows = [(1, 1.0, 1), (1, 1.0, 1), (None, 5.0, 9), (None, None, 9)] * 3
    df = spark.createDataFrame(rows, "listing_id int, x double, dom int")
    fit = lambda d: fit_boosted(
        bin_table(d, ["x"], split=None, max_bins=4), BoostParams(n_estimators=1, max_depth=2, eta=1.0, reg_lambda=0.0), valid=None, eval_splits=("train",)
    )
    assert sorted(r["prediction"] for r in fit(df).transform(df).collect()) == [1.0] * 6 + [9.0] * 6
    assert len(fit(df.limit(0)).nodes) == 0


def test_known_against_missing_splits_behind_the_last_bin(spark):
    """Only being missing tells: known values 1, missing 9. The split parts the last bin from the missing ones."""
    rows = [(i, float(i), 1) for i in range(8)] + [(10 + i, None, 9) for i in range(8)] + [(20, float("inf"), 1)]
    df = spark.createDataFrame(rows, "listing_id int, x double, dom int")
    t = bin_table(df, ["x"], split=None, max_bins=4)
    m = fit_boosted(t, BoostParams(n_estimators=1, max_depth=2, base_score=0.0, eta=1.0, reg_lambda=0.0), valid=None, eval_splits=("train",))
    assert m.nodes["threshold"][0] == float("inf") and not m.nodes["default_left"][0]
    assert {r["listing_id"]: r["prediction"] for r in m.transform(df).collect()} == {r[0]: float(r[2]) for r in rows}
    phi = contributions(m, df).toPandas()
    np.testing.assert_allclose(phi["x"] + phi["expected_value"], phi["listing_id"].map({r[0]: r[2] for r in rows}))
    flat = spark.createDataFrame([(i, None, i) for i in range(4)], "listing_id int, x double, dom int")
    none = fit_boosted(bin_table(flat, ["x"], split=None, max_bins=4), BoostParams(n_estimators=1), valid=None, eval_splits=("train",))
    assert len(none.nodes) == 1


def test_weak_splits_above_strong_ones_survive(spark):
    """Labels 0 10 10 0 over x = 0..3 twice: splitting off x = 0 gains 200/3, splitting off x = 3 below it 400/3."""
    df = spark.createDataFrame([(i, float(i % 4), [0, 1, 1, 0][i % 4] * 10) for i in range(8)], "listing_id int, x double, dom int")
    t = bin_table(df, ["x"], split=None, edges=[[1.0, 2.0, 3.0]])
    fit = lambda gamma: fit_boosted(
        t, BoostParams(n_estimators=1, max_depth=3, base_score=5.0, eta=1.0, reg_lambda=0.0, gamma=gamma), valid=None, eval_splits=("train",)
    )
    free = fit(0.0).nodes
    gains = sorted(free.loc[free.feature >= 0, "gain"])
    assert gains == pytest.approx([200 / 3, 400 / 3])
    assert fit(100.0).nodes.equals(free)  # the weak split stays, as the one below it does
    assert len(fit(150.0).nodes) == 1


def test_cells_of_a_level_are_summed_once(monkeypatch, table):
    """The level's histogram is used twice, for a child and for its sibling: it is read back from where it was written."""
    sources, real = [], grow._next_histogram

    def seen(hist, splits, summed):
        sources.append(summed._jdf.queryExecution().optimizedPlan().toString())
        return real(hist, splits, summed)

    monkeypatch.setattr(grow, "_next_histogram", seen)
    _grown(table, BoostParams(max_depth=3), 0)
    assert len(sources) == 2 and not any("Generate" in plan or "Aggregate" in plan for plan in sources)


def test_bags_of_a_forest_are_drawn_once_a_tree(monkeypatch, table):
    """Levels read the weights; none hashes the keys again."""
    plans, real = [], boosting.grow_tree

    def seen(rows, *args, **named):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return real(rows, *args, **named)

    monkeypatch.setattr(boosting, "grow_tree", seen)
    m = boosting.fit_forest(table, 2, 2, seed=4)
    assert m.nodes["tree"].nunique() == 2
    assert len(plans) == 2 and not any("md5" in plan or "lambda" in plan for plan in plans)


def test_exact_edges_of_few_values_are_not_narrowed(spark, monkeypatch):
    """Only columns of many values pay for brackets; edges stay exact, missing values are left out, and an empty table has none."""
    monkeypatch.setattr(boosting, "FEW_VALUES", 50)
    asked, real = [], boosting.quantiles

    def seen(df, *args, **named):
        asked.append(({r["column"] for r in df.select("column").distinct().collect()}, named.get("bracket_rows")))
        return real(df, *args, **named)

    monkeypatch.setattr(boosting, "quantiles", seen)
    rows = [(float(i * 37 % 1000), i % 3, None if i % 2 else i % 7) for i in range(1000)]
    df = spark.createDataFrame(rows, "wide double, few int, some int")
    edges = bin_edges(df, ["few", "wide", "some"], 4, exact=True)
    columns = ([r[1] for r in rows], [r[0] for r in rows], [r[2] for r in rows if r[2] is not None])
    assert edges == tuple(tuple(sorted(set(np.quantile(c, [0.25, 0.5, 0.75]).tolist()))) for c in columns)
    assert [(len(c), b) for c, b in asked] == [(2, float("inf")), (1, None)]
    assert bin_edges(df.limit(0), ["few", "wide"], 4, exact=True) == ((), ())


def test_bins_of_all_features_are_found_in_one_function(spark, monkeypatch):
    """One Arrow function for all features, none for each; bins as worked by hand, also of edges, missing and infinite values."""
    plans, real = [], boosting.materialise

    def seen(df, label, *args):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return real(df, label, *args)

    monkeypatch.setattr(boosting, "materialise", seen)
    values = [None, float("nan"), float("-inf"), 0.9, 1.0, 1.5, 2.0, float("inf")]
    df = spark.createDataFrame([(i, v, v, 1) for i, v in enumerate(values)], "listing_id int, x double, z double, dom int")
    t = bin_table(df, ["x", "z"], split=None, edges=[[1.0, 2.0], []])
    found = {r["key"]: list(r["b"]) for r in t.rows.collect()}
    assert [found[i] for i in range(8)] == [[-1, -1], [-1, -1], [0, 0], [0, 0], [1, 0], [1, 0], [2, 0], [2, 0]]
    assert sum(p.count("ArrowEvalPython") for p in plans) == 1 and not any("UDF(" in p for p in plans)
    with pytest.raises(ValueError):
        bin_table(df, ["x"], split=None, edges=[[2.0, 1.0]])


@pytest.mark.parametrize("change", [{}, {"subsample": 0.6, "seed": 3}, {"objective": "logcosh", "alpha": 0.9, "metric": "rmse"}])
def test_like_rows_are_one_row_with_a_weight(spark, monkeypatch, change):
    """The same trees and metrics as from the rows one by one, sampled or not, from a fraction of the rows."""
    rows = [(i if i % 50 else None, [i % 4, None][i % 9 == 0], i % 3, [i % 4 + i % 3, None][i % 40 == 0], ["train", "valid"][i % 5 == 0]) for i in range(900)]
    df = spark.createDataFrame(rows, "listing_id int, x int, z int, dom int, split string")
    t = bin_table(df, ["x", "z"], edges=[[1.0, 2.0, 3.0], [1.0, 2.0]])
    params = BoostParams(n_estimators=3, max_depth=3, **change)
    one_by_one = fit_boosted(t, params)
    totals, real = [], boosting.grow_tree

    def seen(rows, total, *args, **named):
        totals.append(total)
        return real(rows, total, *args, **named)

    monkeypatch.setattr(boosting, "grow_tree", seen)
    monkeypatch.setattr(boosting, "GROUP_ROWS", 0)
    together = fit_boosted(t, params)
    assert set(totals) == {t.rows.select("split", "y", "b").distinct().count()} and totals[0] < 300
    pd.testing.assert_frame_equal(one_by_one.nodes, together.nodes)
    assert [(h["round"], h["split"]) for h in one_by_one.history] == [(h["round"], h["split"]) for h in together.history]
    np.testing.assert_allclose([h["value"] for h in one_by_one.history], [h["value"] for h in together.history])
