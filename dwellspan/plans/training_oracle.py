"""SQL equivalents of the registered training and scoring queries."""

from __future__ import annotations

import hashlib
from dataclasses import fields, replace
from math import factorial

from dwellspan.learning.boosting import BoostParams, bag_seed
from dwellspan.plans.boosted_sql import all_splits, bag_sql, best_cte, binned_cte, boosted, edges_cte
from dwellspan.plans.data import DATA_MONTHS, SPLIT_SEED
from dwellspan.plans.oracle import MONTH, ORACLES, SPLITS, bucket, onehot, rfm, sql, trimmed
from dwellspan.plans.training import (
    BINS, CURVE, DEEP, EXPLAINED, FOLDS, FOREST, LOWER, SAMPLED, SMALL_SPACE, SQUARED, STOPPING, TREE_FEATURES, TRIAL_BASE, TRIAL_SEED, TRIALS, UPPER,
    V1, V1_BINS, V1_PARAMS,
)
from dwellspan.schema import BOOL_COLUMNS, COUNTRIES, EUR_V2, RFM_COLUMNS, TR_V2

O = ORACLES
NAMES = "[" + ", ".join(f"'{c}'" for c in TREE_FEATURES) + "]"
MODEL = boosted("m", "splits", TREE_FEATURES, SQUARED, BINS)
LAST = f"m_m{SQUARED.n_estimators}"

O["j2_split_histogram"] = sql(
    "SELECT node, CAST(feature AS INTEGER) AS feature, CAST(bin AS INTEGER) AS bin, round(gain, 5) AS gain, "
    "round(g, 5) AS g, round(h, 5) AS h, round(gl, 5) AS gl, round(hl, 5) AS hl FROM best",
    SPLITS,
    edges_cte("e", "splits", TREE_FEATURES, BINS),
    binned_cte("b", "splits", TREE_FEATURES, "e", "dom"),
    "nodes AS (SELECT contact_type_id AS node, 0.5 - y AS g, CAST(1.0 AS DOUBLE) AS h, b.* "
    "FROM b JOIN listings USING (listing_id) WHERE split = 'train')",
    "cells AS (" + " UNION ALL ".join(
        f"SELECT node, {i} AS feature, b{i} AS bin, g, h FROM nodes" for i in range(len(TREE_FEATURES))
    ) + ")",
    best_cte("best", "cells", SQUARED),
)
PREDICTED = f"SELECT listing_id, split, round(margin, 6) AS prediction FROM {LAST}"
O["j3_train_gbt"] = sql(PREDICTED, SPLITS, MODEL)
O["j3_train_gbt_missing"] = sql(
    f"SELECT listing_id, split, round(margin, 6) AS prediction FROM o_m{SQUARED.n_estimators}",
    SPLITS,
    "holes AS (SELECT * REPLACE (CASE WHEN dom % 5 <> 0 THEN area END AS area) FROM splits)",
    boosted("o", "holes", TREE_FEATURES, SQUARED, BINS),
)
O["j3_train_gbt_sampled"] = sql(
    f"SELECT listing_id, split, round(margin, 6) AS prediction FROM q_m{SAMPLED.n_estimators}",
    SPLITS, boosted("q", "splits", TR_V2, SAMPLED, BINS),
)
O["j3_train_gbt_deep"] = sql(
    f"SELECT listing_id, split, round(margin, 6) AS prediction FROM d_m{DEEP.n_estimators}",
    SPLITS, boosted("d", "splits", TREE_FEATURES, DEEP, BINS),
)
O["a7_model_save_load"] = O["j3_train_gbt"]
O["j7_train_forest"] = sql(
    f"SELECT listing_id, split, round(margin, 6) AS prediction FROM w_m{FOREST.n_estimators}",
    SPLITS, boosted("w", "splits", TR_V2, FOREST, BINS, bag=lambda tree: bag_sql("listing_id", bag_seed(FOREST, tree))),
)
O["j12_shap_sums_to_prediction"] = sql(
    f"SELECT listing_id, round(margin, 6) AS prediction FROM {LAST}", SPLITS, MODEL
)

# Stop at the first round whose validation error is not below the best so far (patience 1).
_valid = [
    f"(SELECT avg(abs(y - margin)) FROM s_m{t + 1} WHERE split = 'valid') AS v{t}" for t in range(STOPPING.n_estimators)
]
_best = " ".join(f"WHEN v{t + 1} >= v{t} THEN {t}" for t in range(STOPPING.n_estimators - 1))
_pick = " ".join(f"WHEN {t} THEN s_m{t + 1}.margin" for t in range(STOPPING.n_estimators))
_joined = " ".join(f"JOIN s_m{t + 1} USING (listing_id)" for t in range(1, STOPPING.n_estimators))
O["j4_early_stopping"] = sql(
    f"SELECT s_m1.listing_id, s_m1.split, round(CASE best {_pick} END, 6) AS prediction "
    f"FROM s_m1 {_joined} CROSS JOIN stopped",
    SPLITS,
    boosted("s", "splits", TREE_FEATURES, STOPPING, BINS),
    f"errors AS (SELECT {', '.join(_valid)})",
    f"stopped AS (SELECT CASE {_best} ELSE {STOPPING.n_estimators - 1} END AS best FROM errors)",
)
O["h10_eval_curve"] = sql(
    " UNION ALL ".join(
        f"SELECT CAST({t} AS INTEGER) AS round, split, 'mae' AS metric, round(avg(abs(y - margin)), 6) AS value "
        f"FROM m_m{t + 1} WHERE split IN ('train', 'valid') GROUP BY split"
        for t in range(SQUARED.n_estimators)
    ),
    SPLITS, MODEL,
)


def interval_ctes(source: str, features) -> tuple[str, str, str]:
    return (
        boosted("u", source, features, UPPER, BINS),
        boosted("w", source, features, LOWER, BINS),
        f"""found AS (
  SELECT u.listing_id, u.split, w.margin AS lower_bound, CAST(u.y AS INTEGER) AS true_dom, u.margin AS upper_bound
  FROM u_m{UPPER.n_estimators} u JOIN w_m{LOWER.n_estimators} w USING (listing_id) WHERE u.split = 'test')""",
    )


O["j5_train_interval"] = sql(
    """SELECT listing_id, round(lower_bound, 4) AS lower_bound, true_dom, round(upper_bound, 4) AS upper_bound,
       round(upper_bound - lower_bound, 4) AS interval_length,
       lower_bound <= true_dom AND true_dom <= upper_bound AS within_interval,
       round(CASE WHEN true_dom < lower_bound THEN lower_bound - true_dom
                  WHEN true_dom > upper_bound THEN true_dom - upper_bound ELSE 0.0 END, 4) AS diff FROM found""",
    SPLITS, *interval_ctes("splits", TREE_FEATURES),
)
O["j6_train_linear_one_variable"] = sql(
    """SELECT split, round(avg(intercept + slope * area), 3) AS mean_prediction
FROM splits CROSS JOIN (SELECT regr_slope(price, area) AS slope, regr_intercept(price, area) AS intercept
                        FROM splits WHERE split = 'train') GROUP BY split""",
    SPLITS,
)


O["j6_train_linear_two_variables"] = sql(
    """SELECT listing_id, round(my + b1 * (area - m1) + b2 * (type_group_id - m2), 4) AS prediction
FROM splits CROSS JOIN (
  SELECT m1, m2, my, (c1 * v2 - c2 * c12) / (v1 * v2 - c12 * c12) AS b1, (c2 * v1 - c1 * c12) / (v1 * v2 - c12 * c12) AS b2
  FROM (SELECT avg(area) AS m1, avg(type_group_id) AS m2, avg(dom) AS my, var_pop(area) AS v1,
               var_pop(type_group_id) AS v2, covar_pop(area, type_group_id) AS c12, covar_pop(area, dom) AS c1,
               covar_pop(type_group_id, dom) AS c2 FROM splits WHERE split = 'train'))""",
    SPLITS,
)
FOLD = f"CAST({bucket('listing_id', SPLIT_SEED)} % {FOLDS} AS INTEGER)"
O["j8_train_stacking_linear"] = sql(
    """SELECT listing_id, round(c + d * (a + b * area), 3) AS prediction
FROM splits
CROSS JOIN (SELECT regr_intercept(price, area) AS a, regr_slope(price, area) AS b FROM folds)
CROSS JOIN (SELECT regr_intercept(price, p) AS c, regr_slope(price, p) AS d FROM held)""",
    SPLITS,
    f"folds AS (SELECT *, {FOLD} AS fold FROM splits WHERE split = 'train')",
    f"""lines AS (
  SELECT k AS fold, regr_intercept(price, area) AS a, regr_slope(price, area) AS b
  FROM range({FOLDS}) t(k) JOIN folds ON fold <> k GROUP BY k)""",
    "held AS (SELECT price, a + b * area AS p FROM folds JOIN lines USING (fold))",
)
_fractions = ", ".join(f"(CAST({f} AS DOUBLE))" for f in CURVE)
O["h12_learning_curve"] = sql(
    """SELECT fraction, fold, round(-median(abs(a + b * area - price)), 3) AS score
FROM rows JOIN lines USING (fold) GROUP BY fraction, fold""",
    f"rows AS (SELECT *, {FOLD} AS fold, {bucket('listing_id', f'{SPLIT_SEED}/curve')} / CAST(4294967296 AS DOUBLE) AS u FROM listings)",
    f"""lines AS (
  SELECT fraction, CAST(k AS INTEGER) AS fold, regr_intercept(price, area) AS a, regr_slope(price, area) AS b
  FROM (VALUES {_fractions}) f(fraction) CROSS JOIN range({FOLDS}) t(k) JOIN rows ON fold <> k AND u < fraction GROUP BY ALL)""",
)


def drawn(trial: int, name: str) -> float | int:
    kind, low, high = SMALL_SPACE[name]
    digest = hashlib.md5(f"{trial}|{name}|{TRIAL_SEED}".encode()).hexdigest()
    u = int(digest[:8], 16) / 4294967296.0
    return low + int(u * (high - low + 1)) if kind == "int" else low + u * (high - low)


def trial_params(trial: int) -> BoostParams:
    known = {f.name for f in fields(BoostParams)}
    return replace(TRIAL_BASE, **{n: drawn(trial, n) for n in SMALL_SPACE if n in known})


def trials_sql(loss: str) -> tuple[str, list[str]]:
    rows, ctes = [], []
    for t in range(TRIALS):
        p = trial_params(t)
        ctes.append(boosted(f"t{t}", "splits", TREE_FEATURES, p, BINS))
        values = ", ".join(
            f"CAST({drawn(t, n)} AS INTEGER) AS {n}" if kind == "int" else f"round(CAST({drawn(t, n)!r} AS DOUBLE), 6) AS {n}"
            for n, (kind, _, _) in SMALL_SPACE.items()
        )
        rows.append(
            f"SELECT CAST({t} AS INTEGER) AS trial_id, {values}, round({loss}(abs(y - margin)), 6) AS loss "
            f"FROM t{t}_m{p.n_estimators} WHERE split = 'test'"
        )
    return " UNION ALL ".join(rows), ctes


_rows, _ctes = trials_sql("avg")
O["j9_hyperparameter_search"] = sql(_rows, SPLITS, *_ctes)
_rows, _ctes = trials_sql("median")
O["j9_best_trial"] = sql(f"SELECT * FROM ({_rows}) ORDER BY loss, trial_id LIMIT 1", SPLITS, *_ctes)
SPLIT_ROWS = f"all_splits AS ({all_splits('m', SQUARED)})"
O["j11_feature_importance_weight"] = sql(
    f"SELECT {NAMES}[feature + 1] AS feature, CAST(count(*) AS DOUBLE) AS importance FROM all_splits GROUP BY ALL",
    SPLITS, MODEL, SPLIT_ROWS,
)
O["j11_feature_importance_gain"] = sql(
    f"""SELECT {NAMES}[feature + 1] AS feature, round(gain / sum(gain) OVER (), 6) AS importance
FROM (SELECT feature, avg(gain) AS gain FROM all_splits GROUP BY feature)""",
    SPLITS, MODEL, SPLIT_ROWS,
)

# Shapley values by their definition. A leaf's value counts for a set of known features as far as a row passes the tests on these,
# times the shares of the training cover that pass the tests on the others.
EXPLAINED_MODEL = boosted("k", "splits", TREE_FEATURES, EXPLAINED, BINS)
_all = range(len(TREE_FEATURES))
_steps = " UNION ALL ".join(
    f"SELECT {t} AS tree, {d} AS level, node, feature, bin, h, hl FROM k_s{t}_{d}"
    for t in range(EXPLAINED.n_estimators) for d in range(EXPLAINED.max_depth)
)
_leaves = " UNION ALL ".join(f"SELECT {t} AS tree, node, leaf FROM k_l{t}" for t in range(EXPLAINED.n_estimators))
_tests = ", ".join(
    f"coalesce(product(CASE WHEN goes_left THEN hl / h ELSE (h - hl) / h END) FILTER (WHERE feature = {i}), 1.0) AS s{i}, "
    f"coalesce(max(bin) FILTER (WHERE feature = {i} AND NOT goes_left), -1) AS lo{i}, "
    f"coalesce(min(bin) FILTER (WHERE feature = {i} AND goes_left), 1000) AS hi{i}"
    for i in _all
)
_passes = {i: f"CASE WHEN b{i} > lo{i} AND b{i} <= hi{i} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END" for i in _all}
_values = ", ".join(
    f"sum(leaf * {' * '.join(f'({_passes[i]})' if known >> i & 1 else f's{i}' for i in _all)}) AS v{known}"
    for known in range(1 << len(TREE_FEATURES))
)


def _shapley(j: int) -> str:
    n = len(TREE_FEATURES)
    weight = lambda k: factorial(k) * factorial(n - k - 1) / factorial(n)
    return " + ".join(
        f"{weight(known.bit_count())!r}::DOUBLE * (v{known | 1 << j} - v{known})" for known in range(1 << n) if not known >> j & 1
    )


PHI = (
    f"""leaves AS (SELECT *, CAST(floor(log2(node)) AS INTEGER) AS level FROM ({_leaves})),
tests AS (
  SELECT l.tree, l.node, any_value(l.leaf) AS leaf, {_tests}
  FROM (SELECT l.tree, l.node, l.leaf, s.feature, s.bin, s.h, s.hl, ((l.node >> (l.level - s.level - 1)) & 1) = 0 AS goes_left
        FROM leaves l LEFT JOIN ({_steps}) s ON s.tree = l.tree AND s.level < l.level AND s.node = l.node >> (l.level - s.level)) l
  GROUP BY l.tree, l.node),
known AS MATERIALIZED (SELECT listing_id, {_values} FROM k_b, tests GROUP BY listing_id),
phi AS (SELECT listing_id, v0, {", ".join(f"{_shapley(j)} AS {c}" for j, c in enumerate(TREE_FEATURES))} FROM known)"""
)
_rounded = ", ".join(f"round({c}, 6) AS {c}" for c in TREE_FEATURES)
O["j12_shap_contributions"] = sql(
    f"SELECT listing_id, {_rounded}, round({EXPLAINED.base_score!r} + v0, 6) AS expected_value FROM phi", SPLITS, EXPLAINED_MODEL, PHI,
)
O["j12_shap_global"] = sql(
    " UNION ALL ".join(f"SELECT '{c}' AS feature, round(avg(abs({c})), 6) AS importance FROM phi" for c in TREE_FEATURES),
    SPLITS, EXPLAINED_MODEL, PHI,
)

# The V1 model learns on trimmed training rows with their city scores; the scored rows take the same
# scores, or those of the trimmed batch itself where the features are refitted.
V1_HEAD = "price, price_change_count, area, type_group_id, " + ", ".join(BOOL_COLUMNS)
V1_COLUMNS = V1_HEAD + ", " + ", ".join(RFM_COLUMNS) + ", " + onehot(MONTH, DATA_MONTHS)


def v1_scored(refit: bool) -> str:
    score_source = "trimmed_test" if refit else "test"
    scores = "rfm_test" if refit else "rfm"
    return sql(
        f"SELECT listing_id, round(margin, 6) AS prediction FROM v_m{V1_PARAMS.n_estimators} WHERE split = 'test'",
        SPLITS,
        "train AS (SELECT * EXCLUDE (split) FROM splits WHERE split = 'train'), "
        "test AS (SELECT * EXCLUDE (split, dom) FROM splits)",
        trimmed("train"), rfm("trimmed", "city_name"), trimmed("test", "trimmed_test"),
        rfm("trimmed_test", "city_name", "rfm_test"),
        f"""ready AS MATERIALIZED (
  SELECT listing_id, 'train' AS split, dom, {V1_COLUMNS} FROM trimmed LEFT JOIN rfm USING (city_name)
  UNION ALL
  SELECT listing_id, 'test' AS split, CAST(NULL AS INTEGER) AS dom, {V1_COLUMNS} FROM {score_source} LEFT JOIN {scores} USING (city_name))""",
        boosted("v", "ready", V1, V1_PARAMS, V1_BINS),
    )


O["k1_score_batch"] = v1_scored(False)
O["k1_score_batch_refit"] = v1_scored(True)
O["k2_score_interval"] = sql(
    "SELECT listing_id, round(lower_bound, 4) AS lower_bound, round(upper_bound, 4) AS upper_bound FROM found",
    SPLITS, *interval_ctes("splits", TR_V2),
)
READY = f"ready AS MATERIALIZED (SELECT listing_id, split, dom, {', '.join(TR_V2)}, {onehot('country_name', COUNTRIES)} FROM splits)"
BAD = "(listing_id % 5 = 0 OR listing_id % 7 = 0 OR listing_id % 11 = 0)"
EUR_LIST = ", ".join(f'"{c}"' for c in EUR_V2)
O["k3_validate_requests"] = sql(f"SELECT listing_id, {EUR_LIST} FROM ready WHERE NOT {BAD}", SPLITS, READY)
O["k3_rejected_requests"] = sql(f"SELECT listing_id FROM listings WHERE {BAD}")


def streamed(features) -> str:
    columns = ", ".join(f'"{c}"' for c in features)
    return sql(
        f"SELECT CAST(listing_id AS VARCHAR) AS request_id, {columns}, round(margin, 6) AS prediction FROM ready JOIN r_m{SQUARED.n_estimators} USING (listing_id) "
        f"WHERE ready.split = 'test' AND NOT {BAD}",
        SPLITS, READY, boosted("r", "ready", features, SQUARED, BINS),
    )


O["k4_score_stream_point_eur"] = streamed(EUR_V2)
O["k4_score_stream_point_tr"] = streamed(TR_V2)
O["k5_score_stream_interval"] = sql(
    f"SELECT CAST(listing_id AS VARCHAR) AS request_id, {EUR_LIST}, round(lower_bound, 4) AS lower_bound, round(upper_bound, 4) AS upper_bound "
    f"FROM ready JOIN found USING (listing_id) WHERE NOT {BAD}",
    SPLITS, READY, *interval_ctes("ready", EUR_V2),
)
O["a8_sink_request_metrics"] = sql(
    f"SELECT count(*) FILTER (WHERE NOT {BAD}) AS answered, count(*) FILTER (WHERE {BAD}) AS rejected, true AS timed "
    "FROM splits WHERE split = 'test'",
    SPLITS,
)
