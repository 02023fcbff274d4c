"""A boosted ensemble as a node table, its distributed scoring, importance and contributions."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NODE_SCHEMA = (
    "tree int, node int, feature int, threshold double, left int, right int, default_left boolean, "
    "leaf double, gain double, cover double"
)
# Nodes shipped to the executors with one scoring function (40 bytes each).
NODES_PER_UDF = 1_000_000
# Rows that are explained together: a path of d features holds some d * d numbers for each.
ROWS_AT_ONCE = 2_000


@dataclass
class TreeModel:
    """`nodes` has one row per tree node; a leaf has feature -1. A row goes left if its value is below
    the threshold, and by `default_left` if the value is missing. An infinite threshold sends every known value left."""

    features: tuple[str, ...]
    base_score: float
    nodes: pd.DataFrame
    history: list[dict] = field(default_factory=list)
    best_round: int | None = None
    name: str = "boosted_trees"

    @property
    def rounds(self) -> int:
        """Trees that take part in predictions."""
        grown = int(self.nodes["tree"].max()) + 1 if len(self.nodes) else 0
        return grown if self.best_round is None else self.best_round + 1

    def node_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.nodes, NODE_SCHEMA)

    def history_table(self, spark: SparkSession) -> DataFrame:
        """(round, split, metric, value): the metric of every evaluated split after each round."""
        return spark.createDataFrame(
            [(h["round"], h["split"], h["metric"], h["value"]) for h in self.history],
            "round int, split string, metric string, value double",
        )

    def _chunks(self) -> Iterator[dict[str, np.ndarray]]:
        """Flat node arrays of consecutive trees, each chunk of bounded size."""
        used = self.nodes[self.nodes["tree"] < self.rounds].sort_values(["tree", "node"])
        sizes = used.groupby("tree").size()
        chunk = (sizes.cumsum() - 1) // NODES_PER_UDF
        for _, trees in sizes.groupby(chunk):
            part = used[used["tree"].isin(trees.index)]
            roots = np.concatenate([[0], np.cumsum(trees.to_numpy())[:-1]]).astype(np.int64)
            shift = np.repeat(roots, trees.to_numpy())
            yield {
                "roots": roots,
                "feature": part["feature"].to_numpy(np.int32),
                "threshold": part["threshold"].to_numpy(float),
                "left": part["left"].to_numpy(np.int64) + shift,
                "right": part["right"].to_numpy(np.int64) + shift,
                "default_left": part["default_left"].to_numpy(bool),
                "leaf": part["leaf"].to_numpy(float),
                "cover": part["cover"].to_numpy(float),
            }

    def margin(self, prefix: str = "") -> Column:
        """Prediction column: each chunk of trees is walked by Arrow batch, all rows of it at once."""
        inputs = [F.col(f"`{prefix}{c}`").cast("double") for c in self.features]
        total = F.lit(float(self.base_score))
        for arrays in self._chunks():
            total = total + _walker(arrays)(*inputs)
        return total

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        return df.withColumn(output, self.margin())

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        meta = [(self.name, list(self.features), float(self.base_score), self.best_round)]
        spark.createDataFrame(
            meta, "name string, features array<string>, base_score double, best_round int"
        ).write.mode("overwrite").parquet(f"{path}/meta")
        self.node_table(spark).write.mode("overwrite").parquet(f"{path}/nodes")
        self.history_table(spark).write.mode("overwrite").parquet(f"{path}/history")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TreeModel:
        meta = spark.read.parquet(f"{path}/meta").first()
        nodes = spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").toPandas()
        history = [r.asDict() for r in spark.read.parquet(f"{path}/history").orderBy("round", "split").collect()]
        return cls(tuple(meta["features"]), meta["base_score"], nodes, history, meta["best_round"], meta["name"])


def _walker(arrays: dict[str, np.ndarray]):
    def walk(*columns: pd.Series) -> pd.Series:
        values = np.column_stack([c.to_numpy(dtype=float, na_value=np.nan) for c in columns])
        rows = np.arange(len(values))
        total = np.zeros(len(values))
        for root in arrays["roots"]:
            node = np.full(len(values), root)
            while True:
                feature = arrays["feature"][node]
                inner = feature >= 0
                if not inner.any():
                    break
                value = values[rows, np.where(inner, feature, 0)]
                cut = arrays["threshold"][node]
                left = np.where(np.isnan(value), arrays["default_left"][node], (value < cut) | np.isposinf(cut))
                step = np.where(left, arrays["left"][node], arrays["right"][node])
                node = np.where(inner, step, node)
            total += arrays["leaf"][node]
        return pd.Series(total)

    return F.pandas_udf(walk, "double")


def importance(model: TreeModel, spark: SparkSession, kind: str = "weight") -> DataFrame:
    """Per feature: number of splits, or its share of the mean gain per split."""
    inner = model.node_table(spark).where((F.col("feature") >= 0) & (F.col("tree") < model.rounds))
    names = F.array(*[F.lit(c) for c in model.features])
    per_feature = inner.groupBy(F.get(names, F.col("feature")).alias("feature"))
    if kind == "weight":
        return per_feature.agg(F.count(F.lit(1)).cast("double").alias("importance"))
    gains = per_feature.agg(F.avg("gain").alias("gain"))
    whole = gains.agg(F.sum("gain")).scalar()
    return gains.select("feature", (F.col("gain") / F.nullif(whole, F.lit(0.0))).alias("importance"))


def expected_value(model: TreeModel) -> float:
    """Mean prediction under the training cover of the nodes."""
    return model.base_score + sum(float(_means(arrays)[arrays["roots"]].sum()) for arrays in model._chunks())


def _shares(arrays: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Of each split, the shares of its cover that go left and right."""
    cover = np.maximum(arrays["cover"], 1e-300)
    return arrays["cover"][arrays["left"]] / cover, arrays["cover"][arrays["right"]] / cover


def _means(arrays: dict[str, np.ndarray]) -> np.ndarray:
    """Mean leaf value below each node; children come after their parents."""
    means, (left, right) = arrays["leaf"].copy(), _shares(arrays)
    for node in np.flatnonzero(arrays["feature"] >= 0)[::-1]:
        means[node] = left[node] * means[arrays["left"][node]] + right[node] * means[arrays["right"][node]]
    return means


def contributions(model: TreeModel, df: DataFrame, key: str = "listing_id") -> DataFrame:
    """Additive per-row contributions of each feature (Shapley values under the path-dependent
    expectation), with `expected_value`; they sum to the prediction. By the recursive path algorithm of Lundberg et al. 2018,
    for all rows of an Arrow batch at once: work per row grows with leaves x depth squared."""
    features = list(model.features)
    inputs, sums = [f"_x{i}" for i in range(len(features))], [f"_s{i}" for i in range(len(features))]
    kind = df.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, " + ", ".join(f"`{c}` double" for c in inputs + sums)
    rows = df.select(
        key,
        *[F.col(f"`{c}`").cast("double").alias(x) for c, x in zip(features, inputs)],
        *[F.lit(0.0).alias(s) for s in sums],
    )
    for arrays in model._chunks():
        rows = rows.mapInPandas(_explainer(arrays, inputs, sums), schema)
    return rows.select(
        key,
        *[F.col(s).alias(c) for c, s in zip(features, sums)],
        F.lit(expected_value(model)).alias("expected_value"),
    )


class _Path:
    """The distinct features on the way to a node: for each the share of training rows that go this way (`zero`), whether a row does
    (`one`, 0 or 1 per row), and the weights of subsets by size (`weight`, per row)."""

    def __init__(self, features: list[int], zero: list[float], one: list[np.ndarray], weight: np.ndarray):
        self.features, self.zero, self.one, self.weight = features, zero, one, weight

    def extended(self, feature: int, zero: float, one: np.ndarray) -> _Path:
        size = len(self.features)
        weight = np.zeros((size + 1, len(one)))
        weight[:size] = self.weight * (zero * np.arange(size, 0, -1) / (size + 1))[:, None]
        weight[1:] += one * self.weight * (np.arange(1, size + 1) / (size + 1))[:, None]
        return _Path([*self.features, feature], [*self.zero, zero], [*self.one, one], weight)

    def _weights_without(self, place: int) -> np.ndarray:
        """Weights as they were before the feature at `place` came in."""
        size = len(self.features) - 1
        zero, goes = self.zero[place], self.one[place] > 0
        out = np.zeros((size, self.weight.shape[1]))
        rest = self.weight[size].copy()
        for j in range(size - 1, -1, -1):
            with_one = rest * ((size + 1) / (j + 1))
            without = self.weight[j] * ((size + 1) / (zero * (size - j))) if zero > 0 else 0.0
            out[j] = np.where(goes, with_one, without)
            rest = self.weight[j] - with_one * (zero * (size - j) / (size + 1))
        return out

    def without(self, place: int) -> _Path:
        cut = lambda values: values[:place] + values[place + 1 :]
        return _Path(cut(self.features), cut(self.zero), cut(self.one), self._weights_without(place))

    def credit(self, leaf: float, phi: np.ndarray) -> None:
        for place in range(1, len(self.features)):
            total = self._weights_without(place).sum(axis=0)
            phi[:, self.features[place]] += total * (self.one[place] - self.zero[place]) * leaf


def _explainer(arrays: dict[str, np.ndarray], inputs: list[str], sums: list[str]):
    """Batch function that adds the contributions of the given trees to the sums so far."""

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        left_share, right_share = _shares(arrays)
        feature, threshold, missing_left = arrays["feature"], arrays["threshold"], arrays["default_left"]
        for batch in batches:
            for start in range(0, len(batch), ROWS_AT_ONCE):
                part = batch.iloc[start : start + ROWS_AT_ONCE].copy()
                values = part[inputs].to_numpy(dtype=float, na_value=np.nan)
                phi, every = part[sums].to_numpy(dtype=float).copy(), np.ones(len(part))
                top = _Path([-1], [1.0], [every], np.ones((1, len(part))))
                stack = [(root, top) for root in arrays["roots"].tolist()]
                while stack:
                    node, path = stack.pop()
                    own = int(feature[node])
                    if own < 0:
                        path.credit(arrays["leaf"][node], phi)
                        continue
                    zero, one = 1.0, every
                    if own in path.features:
                        place = path.features.index(own)
                        zero, one = path.zero[place], path.one[place]
                        path = path.without(place)
                    value, cut = values[:, own], threshold[node]
                    left = np.where(np.isnan(value), missing_left[node], (value < cut) | np.isposinf(cut)).astype(float)
                    stack.append((arrays["left"][node], path.extended(own, zero * left_share[node], one * left)))
                    stack.append((arrays["right"][node], path.extended(own, zero * right_share[node], one * (1 - left))))
                part[sums] = phi
                yield part

    return explain


def global_contributions(model: TreeModel, df: DataFrame, key: str = "listing_id", top: int = 25) -> DataFrame:
    """Mean absolute contribution per feature, largest first."""
    rows = contributions(model, df, key)
    means = rows.agg(*[F.avg(F.abs(f"`{c}`")).alias(c) for c in model.features])
    pairs = [F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").alias("importance")) for c in model.features]
    return means.select(F.inline(F.array(*pairs))).orderBy(F.desc("importance"), "feature").limit(top)


def tree_frame(rows: pd.DataFrame | Sequence[dict]) -> pd.DataFrame:
    columns = [c.split()[0] for c in NODE_SCHEMA.split(", ")]
    frame = pd.DataFrame(rows, columns=columns)
    return frame.astype({"tree": "int32", "node": "int32", "feature": "int32", "left": "int32", "right": "int32"})
