"""Second-order boosted trees as Spark jobs (Chen & Guestrin 2016).

Features are binned once, into a table bucketed by row; trees are grown over it as tables (`grow.py`). The driver sees a few
counts per level, and the nodes when the model is done.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from dwellspan.functions.columns import hash_uniform, logcosh_quantile
from dwellspan.learning.grow import LEAST_CHANGE, MAX_DEPTH, MISSING, NODES, best_splits, grow_tree, level_histogram  # noqa: F401
from dwellspan.learning.trees import TreeModel, tree_frame
from dwellspan.operators.ordered import merged_sketches, quantiles, sketch_quantiles
from dwellspan.session import discard, materialise, materialise_bucketed, new_path

# Rows of a bucket: a join by row holds a bucket's margins and places in memory, some 50 bytes a row.
BUCKET_ROWS = 1_000_000
# Largest size of a sketch of bin edges; its ranks are off by some 2.3 parts of that.
SKETCH_MOST = 8192
# Least rows of a table whose like rows are grouped, and how many times fewer the groups must be (estimated).
GROUP_ROWS = 50_000
GROUP_SHARE = 2
# Distinct values (estimated) up to which a feature's exact edges come straight from its histogram.
FEW_VALUES = 10_000


@dataclass(frozen=True)
class BoostParams:
    """Names and defaults follow the usual boosting libraries. `objective` is "squared" or "logcosh"
    (then `alpha` is the quantile); `base_score` is a number, "mean" or "quantile"."""

    objective: str = "squared"
    alpha: float = 0.5
    n_estimators: int = 100
    max_depth: int = 6
    eta: float = 0.3
    reg_lambda: float = 1.0
    reg_alpha: float = 0.0
    gamma: float = 0.0
    min_child_weight: float = 1.0
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    colsample_bylevel: float = 1.0
    max_bins: int = 256
    base_score: float | str = 0.5
    metric: str = "mae"
    patience: int | None = None
    seed: int = 0


@dataclass(frozen=True)
class BinnedTable:
    """(row, key, split, y, b) in the work folder, bucketed by `row`, a number given when it was written; b is the array of the
    features' bins. And the bin edges per feature."""

    rows: DataFrame
    features: tuple[str, ...]
    edges: tuple[tuple[float, ...], ...]
    key: str
    buckets: int


def objective_columns(params: BoostParams, y: Column, margin: Column) -> tuple[Column, Column]:
    if params.objective == "squared":
        return margin - y, F.lit(1.0)
    if params.objective == "logcosh":
        return logcosh_quantile(y, margin, params.alpha)
    raise ValueError(f"unknown objective {params.objective}")


def bin_edges(
    df: DataFrame, features: Sequence[str], max_bins: int, exact: bool = False
) -> tuple[tuple[float, ...], ...]:
    """Bin edges per feature at equal steps of rank. One pass over all features with bounded sketches that are merged in rounds;
    `exact` takes exact quantiles instead, one histogram per feature; only features of many values are narrowed to brackets."""
    marks = [i / max_bins for i in range(1, max_bins)]
    numbers = {c: F.col(f"`{c}`").cast("double") for c in features}
    found: dict[str, list[float]] = {c: [] for c in features}
    if exact:
        distinct = df.agg(*[F.approx_count_distinct(v).alias(f"n{i}") for i, v in enumerate(numbers.values())]).first()
        few = [c for i, c in enumerate(features) if distinct[f"n{i}"] <= FEW_VALUES]
        # A histogram of few values is combined before its shuffle to next to nothing, so narrowing would only cost passes.
        for columns, options in ((few, {"bracket_rows": math.inf}), ([c for c in features if c not in few], {})):
            if columns:
                long = df.select(F.posexplode(F.array(*[numbers[c] for c in columns])).alias("column", "value"))
                for row in quantiles(long, "value", marks, ["column"], **options).collect():
                    found[columns[row["column"]]].append(row["value"])
    else:
        named = df.select(*[v.alias(f"e{i}") for i, v in enumerate(numbers.values())])
        sketches = merged_sketches(named, named.columns, k=max(8, min(SKETCH_MOST, 16 * max_bins)))
        row = sketches.select(*[
            F.when(F.kll_sketch_get_n_double(c) > 0, sketch_quantiles(named, c, marks)).alias(c) for c in named.columns
        ]).first()
        for i, c in enumerate(features):
            found[c] = (row and row[f"e{i}"]) or []  # no row: an empty table
    return tuple(tuple(sorted(set(found[c]))) for c in features)


def bin_table(
    df: DataFrame,
    features: Sequence[str],
    label: str = "dom",
    key: str = "listing_id",
    split: str | None = "split",
    max_bins: int = 256,
    edges: Sequence[Sequence[float]] | None = None,
) -> BinnedTable:
    """Bin the features with edges learnt on the training split. Bin b holds values from edge b-1 up to,
    but not including, edge b; a missing value is in bin -1."""
    features = tuple(features)
    part = F.col(split) if split else F.lit("train")
    named = df.select(
        F.col(key),
        part.alias("split"),
        F.col(label).cast("double").alias("y"),
        *[
            F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))).alias(f"f{i}")
            for i, c in enumerate(features)
        ],
    )
    names = [f"f{i}" for i in range(len(features))]
    if edges is None:
        known = {n: F.when(~F.isnan(n), F.col(n)) for n in names}
        edges = bin_edges(named.where(F.col("split") == "train").withColumns(known), names, max_bins)
    edges = tuple(tuple(e) for e in edges)
    bins = _binner(edges)(*names) if names else F.array().cast("array<smallint>")
    binned = named.select(F.col(key).alias("key"), "split", "y", bins.alias("b"))
    return BinnedTable(features=features, edges=edges, key=key, **_numbered(binned, "binned"))


def _numbered(df: DataFrame, label: str) -> dict:
    """`df` with the number of each row, bucketed by it. Rows get their number where they are first written, so it stays the same
    whatever is computed again."""
    numbered = materialise(df.withColumn("row", F.monotonically_increasing_id()), "numbered")
    buckets = _buckets(numbered)
    rows, _ = materialise_bucketed(numbered.select("row", *df.columns), label, "row", buckets)
    return {"rows": rows, "buckets": buckets}


def _binner(edges: Sequence[Sequence[float]]) -> Callable[..., Column]:
    """Array of the bins of numbers that are not null, a batch of rows at a time; a feature without edges has one bin."""
    inner = [np.array(e, dtype=float) for e in edges]
    if any(not np.isfinite(e).all() or (np.diff(e) <= 0).any() for e in inner):
        raise ValueError("bin edges must be finite and rise")

    def bins(*columns: pa.Array) -> pa.Array:
        out = np.empty((len(columns[0]), len(columns)), dtype=np.int16)
        for i, column in enumerate(columns):
            value = column.to_numpy(zero_copy_only=False)
            out[:, i] = np.where(np.isnan(value), MISSING, np.searchsorted(inner[i], value, "right"))
        ends = np.arange(0, out.size + 1, len(columns), dtype=np.int32)
        return pa.ListArray.from_arrays(ends, pa.array(out.ravel()))

    return F.arrow_udf(bins, "array<smallint>")


def _buckets(rows: DataFrame) -> int:
    """A bucket has at most BUCKET_ROWS rows; small tables are spread over the cores, larger ones evenly."""
    count, cores = rows.count(), rows.sparkSession.sparkContext.defaultParallelism
    wanted = max(-(-count // BUCKET_ROWS), min(cores, -(-count // 2500)), 1)
    return -(-wanted // cores) * cores if wanted > cores else wanted


def row_seed(params: BoostParams, tree: int) -> str:
    """Rows of a tree are those whose hashed key with this seed falls below `subsample`."""
    return f"{params.seed}/{tree}"


def column_draws(params: BoostParams, tree: int) -> random.Random:
    """Source of a tree's column draws: one for the tree, then one per level."""
    return random.Random(f"{params.seed}/{tree}")


def sampled_columns(features: list[int], fraction: float, rng: random.Random) -> list[int]:
    return sorted(rng.sample(features, max(1, int(fraction * len(features))))) if fraction < 1 else features


def leaf_sql(params: BoostParams) -> Callable[[str, str], str]:
    """Value of a leaf from its sums of gradient and hessian."""
    alpha, lambda_, eta = (f"{float(v)!r}D" for v in (params.reg_alpha, params.reg_lambda, params.eta))
    return lambda g, h: f"coalesce(-{eta} * sign({g}) * greatest(abs({g}) - {alpha}, 0D) / nullif({h} + {lambda_}, 0D), 0D)"


def level_features(params: BoostParams, n_features: int, tree: int) -> tuple[list[int], list[list[int]]]:
    """Features of a tree, and those that each of its levels tries."""
    rng = column_draws(params, tree)
    chosen = sampled_columns(list(range(n_features)), params.colsample_bytree, rng)
    return chosen, [sampled_columns(chosen, params.colsample_bylevel, rng) for _ in range(params.max_depth)]


def model_nodes(grown: pd.DataFrame, edges: Sequence[Sequence[float]]) -> pd.DataFrame:
    """Nodes (tree, heap number, bin, ..) as the model keeps them: numbered by level within each tree, with thresholds. Values below
    a threshold go left; a split of the last bin parts the known values from the missing ones."""
    grown = grown.sort_values(["tree", "node"], ignore_index=True)
    number = grown.groupby("tree").cumcount()
    places = pd.Series(number.to_numpy(), index=pd.MultiIndex.from_frame(grown[["tree", "node"]]))
    splits = grown["feature"] >= 0
    left = np.zeros(len(grown), dtype=np.int32)
    left[splits] = places.loc[list(zip(grown.loc[splits, "tree"], 2 * grown.loc[splits, "node"]))].to_numpy()
    padded = np.full((len(edges), max(map(len, edges), default=0) + 1), np.inf)
    for i, own in enumerate(edges):
        padded[i, : len(own)] = own
    threshold = np.where(splits, padded[grown["feature"].clip(lower=0), grown["bin"]], 0.0)
    return tree_frame(grown.assign(node=number, left=left, right=np.where(splits, left + 1, 0), threshold=threshold))


def _first_margin(table: BinnedTable, params: BoostParams) -> float:
    train = table.rows.where(F.col("split") == "train")
    if params.base_score == "mean":
        return train.agg(F.avg("y")).first()[0]
    if params.base_score == "quantile":
        return quantiles(train, "y", [params.alpha]).first()["value"]
    return float(params.base_score)


def _metric_of(metric: str, split: str, weight: Column) -> Column:
    error = F.when(F.col("split") == split, F.col("y") - F.col("margin"))
    each = error * error if metric == "rmse" else F.abs(error)
    mean = F.sum(weight * each) / F.sum(F.when(error.isNotNull(), weight))
    return F.sqrt(mean) if metric == "rmse" else mean


def grouped(table: BinnedTable, total: int) -> BinnedTable | None:
    """(row, split, y, b, n): rows of one split, label and bins, n of them, as one row, if the table has
    GROUP_ROWS or more and there are GROUP_SHARE times fewer groups. Whatever trees are grown, such rows reach the same nodes and have the same
    margin, gradient and hessian, so sums over the groups are those over the rows."""
    if total < GROUP_ROWS:
        return None
    alike = ["split", "y", "b"]
    if table.rows.agg(F.approx_count_distinct(F.xxhash64(*alike))).first()[0] * GROUP_SHARE > total:
        return None
    groups = table.rows.groupBy(*alike).agg(F.count(F.lit(1)).cast("double").alias("n"))
    return replace(table, **_numbered(groups, "groups"))


def _drawn(rows: DataFrame, groups: DataFrame, params: BoostParams, tree: int) -> DataFrame:
    """(row, m): how many training rows of a group a tree draws, if any; combined before it is shuffled."""
    learns = (F.col("split") == "train") & (hash_uniform("key", row_seed(params, tree)) < float(params.subsample))
    counts = rows.where(learns).groupBy(F.col("y").alias("_y"), F.col("b").alias("_b")).agg(F.count(F.lit(1)).cast("double").alias("m"))
    same = F.col("y").eqNullSafe(F.col("_y")) & (F.col("b") == F.col("_b"))
    return groups.where(F.col("split") == "train").join(counts, same).select("row", "m")


def fit_boosted(
    table: BinnedTable,
    params: BoostParams,
    valid: str | None = "valid",
    eval_splits: Sequence[str] = ("train", "valid"),
) -> TreeModel:
    """Grow trees until `n_estimators`, or until the metric of the `valid` split has not improved for
    `patience` rounds; predictions then stop at the best round.

    The binned rows stay as they were written. Margins are a narrow table (row, margin), bucketed alike and joined without a
    shuffle; a new one is written after each tree, which cuts lineage, and the metrics are observed in that pass. Nodes are
    appended to a table and are read once, at the end. Rows that no tree can tell apart are one row with a weight (`grouped`);
    then a sampled tree counts the rows that it draws of each, in one pass over the binned rows."""
    spark, base, every = table.rows.sparkSession, _first_margin(table, params), table.rows
    total, widest = every.count(), max(map(len, table.edges), default=0)
    groups = grouped(table, total)
    weight = F.lit(1.0)
    if groups is not None:
        table, total, weight = groups, groups.rows.count(), F.col("n")
    folder, history = new_path(spark, "nodes"), []
    best_round, best_value, margins, drop = None, None, None, None
    tree = -1
    for tree in range(params.n_estimators if total else 0):
        if margins is None:
            state = table.rows.withColumn("margin", F.lit(float(base)))
        else:
            state = table.rows.join(margins.hint("shuffle_hash"), "row")
        learns, counts, learners, drop_drawn = F.col("split") == "train", weight, state, None
        if params.subsample < 1 and groups is not None:
            drawn, drop_drawn = materialise_bucketed(_drawn(every, table.rows, params, tree), "weights", "row", table.buckets)
            learners, counts = state.join(drawn.hint("shuffle_hash"), "row", "left"), F.coalesce("m", F.lit(0.0))
            learns &= counts > 0
        elif params.subsample < 1:
            learns &= hash_uniform("key", row_seed(params, tree)) < float(params.subsample)
        g, h = objective_columns(params, F.col("y"), F.col("margin"))
        rows = learners.select("row", learns.alias("learns"), (counts * g).alias("g"), (counts * h).alias("h"), "b")
        chosen, levels = level_features(params, len(table.features), tree)
        grown = grow_tree(rows, total, params, levels, chosen, widest + 2, table.buckets, leaf_sql(params))
        grown.nodes.select(F.lit(tree).alias("tree"), "*").write.mode("append").parquet(folder)
        moved = grown.placed(state).join(grown.values, "node", "left")
        moved = moved.withColumn("margin", F.col("margin") + F.coalesce("value", F.lit(0.0)))
        seen = Observation()
        metrics = [F.count(F.lit(1)).alias("rows"), *[_metric_of(params.metric, s, weight).alias(s) for s in eval_splits]]
        newer, drop_newer = materialise_bucketed(
            moved.observe(seen, *metrics).select("row", "margin"), "margins", "row", table.buckets
        )
        values = seen.get
        grown.discard()
        if drop_drawn:
            drop_drawn()
        if drop:
            drop()
        margins, drop = newer, drop_newer
        for s in eval_splits:
            if values[s] is not None:
                history.append({"round": tree, "split": s, "metric": params.metric, "value": values[s]})
        if params.patience is not None and valid is not None:
            if best_value is None or values[valid] < best_value:
                best_round, best_value = tree, values[valid]
            elif tree - best_round >= params.patience:
                break
    if drop:
        drop()
    nodes = spark.read.schema(f"tree int, {NODES}").parquet(folder).toPandas() if tree >= 0 else None
    discard(spark, folder)
    return TreeModel(table.features, base, tree_frame([]) if nodes is None else model_nodes(nodes, table.edges), history, best_round)


def _poisson() -> tuple[float, ...]:
    """P(X <= k) of the Poisson distribution of mean 1, for k = 0, 1, .. as far as a 32-bit hash can tell."""
    term, total, out = math.exp(-1), 0.0, []
    while total < 1 - 2.0**-33:
        total += term
        out.append(total)
        term /= len(out)
    return tuple(out)


POISSON = _poisson()


def bag_seed(params: BoostParams, tree: int) -> str:
    return f"{params.seed}/bag/{tree}"


def fit_forest(
    table: BinnedTable, trees: int = 100, max_depth: int | None = None, min_child_weight: float = 1.0,
    colsample_bylevel: float = 1.0, seed: int = 0,
) -> TreeModel:
    """Random forest for the squared error on the same engine: a tree learns the label from training rows that count as often as a
    Poisson draw seeded by their key says (a bootstrap sample, for large tables); predictions are means over trees. Trees
    grow until no split helps; `max_depth` None is as deep as nodes can be numbered."""
    params = forest_params(trees, max_depth, min_child_weight, colsample_bylevel, seed)
    spark, total, folder = table.rows.sparkSession, table.rows.count(), new_path(table.rows.sparkSession, "nodes")
    widest = max(map(len, table.edges), default=0)
    for tree in range(trees if total else 0):
        drawn = hash_uniform("key", bag_seed(params, tree))
        # unfolded, as a lambda would hash the key once per step; a row without key is in no bag
        weight = sum((F.coalesce(F.lit(p) <= drawn, F.lit(False)).cast("double") for p in POISSON), F.lit(0.0))
        # Drawn once a tree, as a narrow table that joins without a shuffle: each level reads it several times.
        bag, drop = materialise_bucketed(table.rows.select("row", weight.alias("w")), "weights", "row", table.buckets)
        rows = table.rows.join(bag.hint("shuffle_hash"), "row").select(
            "row", ((F.col("split") == "train") & (F.col("w") > 0)).alias("learns"), (-F.col("w") * F.col("y")).alias("g"),
            F.col("w").alias("h"), "b",
        )
        chosen, levels = level_features(params, len(table.features), tree)
        grown = grow_tree(rows, total, params, levels, chosen, widest + 2, table.buckets, leaf_sql(params))
        grown.nodes.select(F.lit(tree).alias("tree"), "*").write.mode("append").parquet(folder)
        grown.discard()
        drop()
    nodes = spark.read.schema(f"tree int, {NODES}").parquet(folder).toPandas() if total and trees else None
    discard(spark, folder)
    return TreeModel(table.features, 0.0, tree_frame([]) if nodes is None else model_nodes(nodes, table.edges), name="forest")


def forest_params(
    trees: int, max_depth: int | None = None, min_child_weight: float = 1.0, colsample_bylevel: float = 1.0, seed: int = 0
) -> BoostParams:
    """A forest as boosting parameters: leaves are means, divided by the number of trees."""
    return BoostParams(
        n_estimators=trees, max_depth=max_depth or MAX_DEPTH, eta=1 / trees, reg_lambda=0.0, base_score=0.0,
        min_child_weight=min_child_weight, colsample_bylevel=colsample_bylevel, seed=seed,
    )


@dataclass
class BoostedTrees:
    """Estimator over raw feature columns: `fit` bins the features and boosts, `transform` of the model
    adds the prediction."""

    features: Sequence[str]
    params: BoostParams = BoostParams()
    label: str = "dom"
    key: str = "listing_id"
    split: str | None = "split"

    def fit(self, df: DataFrame) -> TreeModel:
        table = bin_table(df, self.features, self.label, self.key, self.split, self.params.max_bins)
        return fit_boosted(table, self.params)


# Parameters of the published models.
EUR_V2_PARAMS = BoostParams(
    n_estimators=1000, reg_lambda=2.7921, reg_alpha=50, gamma=13, max_depth=16, min_child_weight=14.1631,
    eta=0.0604, colsample_bytree=0.9793, colsample_bylevel=0.8327, subsample=0.9029, seed=123, patience=15,
)
TR_V1_PARAMS = BoostParams(
    n_estimators=600, reg_lambda=7.8634, reg_alpha=9.6275, gamma=7.9183, max_depth=9, min_child_weight=17.57,
    eta=0.1886, colsample_bytree=0.6304, colsample_bylevel=0.2338, subsample=0.93952, seed=123,
)
UPPER_PARAMS = BoostParams(
    objective="logcosh", alpha=0.95, n_estimators=500, reg_lambda=2.4755, reg_alpha=45.273, gamma=3.4073,
    max_depth=22, min_child_weight=68.7668, eta=0.03754, colsample_bytree=0.9250, colsample_bylevel=0.8932,
    subsample=0.6204, seed=123, patience=15,
)
LOWER_PARAMS = BoostParams(
    objective="logcosh", alpha=0.05, n_estimators=200, reg_lambda=1.5918, reg_alpha=50, gamma=9.4535,
    max_depth=5, min_child_weight=59.6102, eta=0.1565, colsample_bytree=0.9393, colsample_bylevel=0.7923,
    subsample=0.5025, seed=123, patience=15,
)


@dataclass
class IntervalModel:
    """Two boosted models on the same features: `lower_bound` and `upper_bound`."""

    lower: TreeModel
    upper: TreeModel

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({"lower_bound": self.lower.margin(), "upper_bound": self.upper.margin()})

    def save(self, path: str) -> None:
        self.lower.save(f"{path}/lower")
        self.upper.save(f"{path}/upper")

    @classmethod
    def load(cls, spark, path: str) -> IntervalModel:
        return cls(TreeModel.load(spark, f"{path}/lower"), TreeModel.load(spark, f"{path}/upper"))


def fit_interval(
    table: BinnedTable, alpha: float = 0.95, upper: BoostParams = UPPER_PARAMS, lower: BoostParams = LOWER_PARAMS
) -> IntervalModel:
    """Upper model at quantile alpha, lower at 1 - alpha, each with its own parameters."""
    return IntervalModel(
        fit_boosted(table, replace(lower, objective="logcosh", alpha=round(1 - alpha, 12))),
        fit_boosted(table, replace(upper, objective="logcosh", alpha=alpha)),
    )
