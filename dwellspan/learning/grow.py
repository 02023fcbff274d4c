"""One tree, grown as tables: a table of splits per level, a narrow table of (row, node) that rows are placed with.

Nodes are numbered as in a heap, 1 is the root and 2n, 2n + 1 are the children of n, so ancestors are a shift away. While a node has
more than `local_rows` rows it is split by the whole cluster: cells (node, feature, bin) are summed with map-side combine. Of two
children only the one with fewer learning rows is summed; the other one is the parent's kept cells minus these. Rows find
their node by joins with the splits of the levels since `WALK_LEVELS` were last written, small tables that Catalyst broadcasts
by their measured size. A node of at most `local_rows` rows moves, rows and all, to one task that grows all below it, many nodes at
a time in different tasks (as Panda et al. 2009 do): moving the rows is cheaper there than summing cells once per level.

All rows are placed, also those that don't learn (of other splits, or not sampled); only learning rows count in sums."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellspan.session import discard, materialise, materialise_bucketed, materialise_observed, new_path

MISSING = -1
# Fixed value: the least loss reduction at which the usual libraries try a split.
LEAST_CHANGE = 1e-6
# Levels that rows walk down within one job before their place is written.
WALK_LEVELS = 4
# Rows up to which a node is grown in one task.
LOCAL_ROWS = 8192
# Deepest tree whose nodes a long can number.
MAX_DEPTH = 60
RECORD = "node bigint, feature int, bin int, default_left boolean, gain double, g double, h double, gl double, hl double"
NODES = "node bigint, feature int, bin int, default_left boolean, gain double, cover double, leaf double"


def level_histogram(rows: DataFrame, features: Sequence[int] | None = None) -> DataFrame:
    """Sums of gradient and hessian, and counts of learning rows (c) and all rows (a), per (node, feature, bin) of rows (node, g, h, b
    [, learns]); b is the array of bins. A row is unfolded within the stage and added up before the shuffle."""
    learns = "learns" if "learns" in rows.columns else "true"
    cells = rows.selectExpr(
        "node", f"if({learns}, g, 0D) AS g", f"if({learns}, h, 0D) AS h", f"if({learns}, 1L, 0L) AS c",
        "posexplode(b) AS (feature, bin)",
    ).withColumn("bin", F.col("bin").cast("int"))
    if features is not None:
        cells = cells.where(_chosen(features))
    return cells.groupBy("node", "feature", "bin").agg(
        F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("c").alias("c"), F.count(F.lit(1)).alias("a")
    )


def _chosen(features: Sequence[int]):
    """A lookup in an array, so the generated code is that of any other choice."""
    mask = ", ".join("true" if i in set(features) else "false" for i in range(max(features) + 1))
    return F.expr(f"coalesce(get(array({mask}), feature), false)")


def best_splits(hist: DataFrame, params, features: Sequence[int] | None = None) -> DataFrame:
    """Per node the split with the largest gain, both ways of sending missing values tried.

    One row per node: feature, bin (goes left up to and including it), default_left, gain, sums of the
    node (g, h, c, a) and of its left child (gl, hl, cl, al). The gain is the loss reduction left + right - parent;
    it is null if no split is allowed. `gamma` counts later, when the grown tree is pruned."""
    if features is not None:
        hist = hist.where(_chosen(features))
    cell = "OVER (PARTITION BY node, feature)"
    upto = "OVER (PARTITION BY node, feature ORDER BY bin ROWS UNBOUNDED PRECEDING)"
    sums = hist.selectExpr(
        "node", "feature", "bin", "c AS own",
        *[f"sum({x}) {cell} AS {x}" for x in "ghca"],
        *[f"sum(if(bin = {MISSING}, {x}, 0)) {cell} AS {x}_missing" for x in "ghca"],
        *[f"sum(if(bin = {MISSING}, 0, {x})) {upto} AS {x}_known" for x in "ghca"],
    )
    sides = sums.selectExpr(
        "*", "explode(if(c_missing > 0, array(false, true), array(false))) AS default_left"
    ).selectExpr("*", *[f"{x}_known + if(default_left, {x}_missing, 0) AS {x}l" for x in "ghca"])

    def score(g: str, h: str) -> str:
        kept = f"greatest(abs({g}) - {float(params.reg_alpha)!r}D, 0D)"
        return f"{kept} * {kept} / nullif({h} + {float(params.reg_lambda)!r}D, 0D)"

    weight = f"{float(params.min_child_weight)!r}D"
    allowed = f"bin <> {MISSING} AND own > 0 AND cl > 0 AND c > cl AND hl >= {weight} AND h - hl >= {weight}"
    change = f"{score('gl', 'hl')} + {score('g - gl', 'h - hl')} - {score('g', 'h')}"
    gain = f"if({allowed}, {change}, NULL)"
    payload = "default_left, g, h, c, a, gl, hl, cl, al"
    best = sides.selectExpr(
        "node", f"struct({gain} AS gain, -feature AS minus_feature, -bin AS minus_bin, {payload}) AS s"
    ).groupBy("node").agg(F.max("s").alias("s"))
    return best.selectExpr(
        "node", "-s.minus_feature AS feature", "-s.minus_bin AS bin", "s.gain AS gain",
        *[f"s.{c} AS {c}" for c in payload.split(", ")],
    )


def _walk(placed: DataFrame, splits: DataFrame) -> DataFrame:
    """Move rows of split nodes to the child; `summed` marks those whose cells are to be summed for the next level."""
    known = splits.where("split").select("node", "feature", "bin", "default_left", "next", "sum_left")
    side = "CASE WHEN get(b, feature) = -1 THEN default_left ELSE get(b, feature) <= bin END"
    moved = placed.join(known, "node", "left").selectExpr("*", f"{side} AS _left")
    others = [c for c in placed.columns if c not in ("node", "summed")]
    return moved.selectExpr(
        *others, "CASE WHEN feature IS NULL THEN node WHEN _left THEN node * 2 ELSE node * 2 + 1 END AS node",
        "coalesce(next AND _left = sum_left, false) AS summed",
    )


def _children(splits: DataFrame, depth: int, max_depth: int, local_rows: int) -> DataFrame:
    """What becomes of the children: to be split by all (big), in a task (small), or not at all."""
    open_ = depth + 1 < max_depth
    flags = {}
    for side, rows in (("left", "al"), ("right", "a - al")):
        flags[f"{side}_big"] = f"split AND {open_ and 'true' or 'false'} AND {rows} > {local_rows}"
        flags[f"{side}_small"] = f"split AND {open_ and 'true' or 'false'} AND {rows} <= {local_rows}"
    return (
        splits.selectExpr("*", f"coalesce(gain > {LEAST_CHANGE!r}D, false) AS split")
        .selectExpr("*", *[f"{e} AS {n}" for n, e in flags.items()], "2 * cl <= c AS sum_left")
        .selectExpr("*", "left_big OR right_big AS next")
    )


def _next_histogram(hist: DataFrame, splits: DataFrame, summed: DataFrame) -> DataFrame:
    """Cells of the big children: of one child as summed, of its sibling the parent's cells minus these."""
    pairs = splits.where("next").select("node", "sum_left", "left_big", "right_big")
    parents = hist.join(pairs, "node").selectExpr(
        "node * 2 + if(sum_left, 1, 0) AS node", "feature", "bin", "g", "h", "c", "a"
    )
    taken = summed.selectExpr("node + 1 - 2 * (node % 2) AS node", "feature", "bin", "-g AS g", "-h AS h", "-c AS c", "-a AS a")
    rest = parents.unionByName(taken).groupBy("node", "feature", "bin").agg(*[F.sum(x).alias(x) for x in "ghca"])
    rest = rest.where("a > 0").selectExpr("node", "feature", "bin", "if(c > 0, g, 0D) AS g", "if(c > 0, h, 0D) AS h", "c", "a")
    both = summed.unionByName(rest).withColumn("parent", F.shiftright("node", 1))
    flags = pairs.selectExpr("node AS parent", "left_big", "right_big")
    return both.join(flags, "parent").where("if(node % 2 = 0, left_big, right_big)").select("node", "feature", "bin", *"ghca")


# ---- nodes that fit a task ---------------------------------------------------------------------


def _best_of(cells: np.ndarray, features: np.ndarray, params) -> tuple | None:
    """The same choice as `best_splits` for one node. `cells`: (g, h, c) x feature x bin, bin 0 for missing values."""
    total = cells.sum(axis=2)[:, :, None]
    known, missing, own = np.cumsum(cells[:, :, 1:], axis=2), cells[:, :, :1], cells[2, :, 1:] > 0
    left = np.stack([known + missing, known], axis=3)  # default_left first: it wins among equals
    whole, right = total[..., None], total[..., None] - left

    def score(g, h):
        kept, below = np.maximum(np.abs(g) - params.reg_alpha, 0.0), h + params.reg_lambda
        return np.divide(kept * kept, below, out=np.full(np.broadcast(kept, below).shape, np.nan), where=below != 0)

    gain = score(left[0], left[1]) + score(right[0], right[1]) - score(whole[0], whole[1])
    allowed = own[:, :, None] & (left[2] > 0) & (right[2] > 0)
    allowed &= (left[1] >= params.min_child_weight) & (right[1] >= params.min_child_weight) & ~np.isnan(gain)
    allowed[:, :, 0] &= missing[2] > 0
    if not allowed.any():
        return None
    gain = np.where(allowed, gain, -np.inf)
    at, bin_, way = np.unravel_index(int(gain.argmax()), gain.shape)
    g, h = total[:2, at, 0]
    gl, hl = left[:2, at, bin_, way]
    return int(features[at]), int(bin_), way == 0, float(gain[at, bin_, way]), float(g), float(h), float(gl), float(hl)


def _grow_in_task(params, level_features: list[list[int]], width: int) -> Callable[[pa.Table], pa.Table]:
    """All below the nodes of a bucket: rows with the node they reach, and the splits made."""
    fields = pa.schema([
        ("row", pa.int64()), ("node", pa.int64()), ("feature", pa.int32()), ("bin", pa.int32()), ("default_left", pa.bool_()),
        ("gain", pa.float64()), ("g", pa.float64()), ("h", pa.float64()), ("gl", pa.float64()), ("hl", pa.float64()),
    ])

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        rows, node = table.column("row").to_numpy(), table.column("node").to_numpy()
        learns = table.column("learns").to_numpy()
        g, h = (np.where(learns, table.column(x).to_numpy(), 0.0) for x in "gh")
        bins = pa.concat_arrays(table.column("b").chunks).flatten().to_numpy().reshape(len(rows), -1).astype(np.int64)
        reached, records = node.copy(), []
        order = np.argsort(node, kind="stable")
        starts = np.flatnonzero(np.diff(node[order], prepend=-1))
        stack = [(int(node[part[0]]), part) for part in np.split(order, starts[1:])]
        while stack:
            number, part = stack.pop()
            depth = number.bit_length() - 1
            features = np.array(level_features[depth])
            mine = part[learns[part]]
            place = (bins[np.ix_(mine, features)] + 1 + np.arange(len(features)) * width).ravel()
            count, size = len(features), len(features) * width
            cells = np.stack([
                np.bincount(place, np.repeat(g[mine], count), size), np.bincount(place, np.repeat(h[mine], count), size),
                np.bincount(place, minlength=size).astype(float),
            ]).reshape(3, count, width)
            best = _best_of(cells, features, params)
            if best is None or best[3] <= LEAST_CHANGE:
                if number == 1:
                    records.append((number, None, None, None, None, float(g[mine].sum()), float(h[mine].sum()), None, None))
                continue
            records.append((number, *best))
            value = bins[part, best[0]]
            left = np.where(value == MISSING, best[2], value <= best[1])
            for child, below in ((2 * number, part[left]), (2 * number + 1, part[~left])):
                reached[below] = child
                if depth + 1 < len(level_features):
                    stack.append((child, below))
        columns = list(zip(*records)) if records else [()] * 9
        made = pa.table({
            "row": pa.nulls(len(records), pa.int64()),
            **{f.name: pa.array(c, f.type) for f, c in zip(list(fields)[1:], columns)},
        }, schema=fields)
        placed = pa.table({
            "row": rows, "node": reached, **{f.name: pa.nulls(len(rows), f.type) for f in list(fields)[2:]}
        }, schema=fields)
        return pa.concat_tables([placed, made])

    return run


# ---- the tree ----------------------------------------------------------------------------------


@dataclass
class GrownTree:
    """`nodes`: the pruned tree, a row per node (NODES). `values`: (node, value) of every node that rows can have reached.
    `placed`: adds the node to rows (row, b, ..)."""

    nodes: DataFrame
    values: DataFrame
    placed: Callable[[DataFrame], DataFrame]
    summed: list[int] = field(default_factory=list)  # rows whose cells were summed, by level of the cluster
    discard: Callable[[], None] = lambda: None


def _ancestors(nodes: DataFrame, name: str = "above") -> DataFrame:
    """A row for each node and each of its ancestors, itself included."""
    return nodes.withColumn(name, F.expr("explode(transform(sequence(0, length(bin(node)) - 1), i -> shiftright(node, i)))"))


def grow_tree(
    rows: DataFrame, total: int, params, level_features: list[list[int]], chosen: list[int], width: int, buckets: int,
    leaf: Callable[[str, str], str], local_rows: int | None = None,
) -> GrownTree:
    """Grow a tree over `total` rows (row, learns, g, h, b), then prune it by `gamma` from the bottom up.

    `level_features`: features tried at each level; `chosen`: all of them; `width`: bins of a feature, and one for missing
    values; `leaf`: SQL of a leaf's value from the SQL of its sums."""
    spark, max_depth = rows.sparkSession, len(level_features)
    local_rows = LOCAL_ROWS if local_rows is None else local_rows
    if max_depth > MAX_DEPTH:
        raise ValueError(f"a tree of more than {MAX_DEPTH} levels")
    subtract = params.colsample_bylevel > 0.5  # else half the features' cells cost less than one child's
    written: list[Callable[[], None]] = []
    state, walked, parts, smalls, summed_rows = None, [], [], [], []

    def keep(df: DataFrame, label: str, **metrics) -> tuple[DataFrame, dict]:
        path = new_path(spark, label)
        written.append(lambda: discard(spark, path))
        return materialise_observed(df, label, path, **metrics) if metrics else (materialise(df, label, path), {})

    def placed(source: DataFrame, steps: Sequence[DataFrame] | None = None) -> DataFrame:
        at = source.withColumn("node", F.lit(1).cast("bigint")) if state is None else source.join(state.hint("shuffle_hash"), "row")
        return reduce(_walk, walked if steps is None else steps, at)

    depth, big, small_rows, hist, splits = 0, total > local_rows and max_depth > 0, 0, None, None
    while big:
        here = placed(rows)
        tried = chosen if subtract else level_features[depth]
        if splits is None:
            hist = level_histogram(here, tried)
        elif subtract:
            summed, _ = keep(level_histogram(here.where("summed"), tried), "summed")  # read twice, summed once
            hist = _next_histogram(hist, splits, summed)
        else:
            hist = level_histogram(here.join(_hanging(splits, "big"), "node", "left_semi"), tried)
        hist, _ = keep(hist, "cells")
        best = _children(best_splits(hist, params, level_features[depth]), depth, max_depth, local_rows)
        splits, seen = keep(
            best, "splits", big=F.sum(F.expr("int(left_big) + int(right_big)")),
            small=F.sum(F.expr("if(left_small, al, 0) + if(right_small, a - al, 0)")),
            next=F.sum(F.expr("if(next, if(sum_left, cl, c - cl), 0)")),
        )
        parts.append(splits.selectExpr(*[c.split()[0] for c in RECORD.split(", ")]))
        smalls.append(_hanging(splits, "small"))
        summed_rows.append(seen["next"] or 0)
        walked.append(splits)
        depth, big, small_rows = depth + 1, bool(seen["big"]), small_rows + (seen["small"] or 0)
        if big and len(walked) == WALK_LEVELS:
            state, gone = materialise_bucketed(placed(rows).select("row", "node", "summed"), "standing", "row", buckets)
            written.append(gone)
            walked = []

    local = None
    if small_rows or (total <= local_rows and max_depth > 0):
        here = placed(rows)
        if smalls:
            here = here.join(reduce(DataFrame.unionByName, smalls), "node", "left_semi")
        pieces = max(1, -(-(small_rows or total) // local_rows))
        dealt = here.select(F.pmod(F.xxhash64("node"), F.lit(pieces)).alias("bucket"), "row", "learns", "g", "h", "b", "node")
        grown, _ = keep(
            dealt.groupBy("bucket").applyInArrow(_grow_in_task(params, level_features, width), f"row bigint, {RECORD}"), "subtrees"
        )
        parts.append(grown.where("row IS NULL").drop("row"))
        local, gone = materialise_bucketed(grown.where("row IS NOT NULL").select("row", "node"), "placed", "row", buckets)
        written.append(gone)

    records = (reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], RECORD)).coalesce(1)
    nodes, _ = keep(_pruned(records, params.gamma, leaf), "nodes")
    return GrownTree(
        nodes, _values(records, nodes, params.gamma), lambda source: _reached(placed(source), local), summed_rows,
        lambda: [gone() for gone in written],
    )


def _hanging(splits: DataFrame, kind: str) -> DataFrame:
    """The big, or the small, children."""
    return splits.selectExpr(
        f"explode(filter(array(if(left_{kind}, node * 2, NULL), if(right_{kind}, node * 2 + 1, NULL)), n -> n IS NOT NULL)) AS node"
    )


def _reached(placed: DataFrame, local: DataFrame | None) -> DataFrame:
    """Rows with the node they reach in the grown tree."""
    if local is None:
        return placed
    below = local.withColumnRenamed("node", "_below")
    both = placed.join(below.hint("shuffle_hash"), "row", "left")
    return both.withColumn("node", F.coalesce("_below", "node")).drop("_below")


def _pruned(records: DataFrame, gamma: float, leaf: Callable[[str, str], str]) -> DataFrame:
    """Splits that reach `gamma` or have one below them that does, and the leaves under them. `records`: in one partition, so
    that these small joins need no exchange (they sort, and spill if a tree should be that large)."""
    grown = records.where(f"gain > {LEAST_CHANGE!r}D")
    kept = grown
    if gamma > LEAST_CHANGE:
        strong = _ancestors(grown.where(f"gain >= {float(gamma)!r}D").select("node")).select(F.col("above").alias("node"))
        kept = grown.join(strong.hint("merge"), "node", "left_semi")
    children = kept.selectExpr("inline(array(struct(node * 2 AS node, gl AS g, hl AS h), struct(node * 2 + 1 AS node, g - gl AS g, h - hl AS h)))")
    root = records.where("node = 1").select("node", "g", "h")
    leaves = children.unionByName(root).coalesce(1).join(kept.select("node").hint("merge"), "node", "left_anti")
    return kept.selectExpr(
        "node", "feature", "bin", "default_left", "gain", "h AS cover", "0D AS leaf"
    ).unionByName(leaves.selectExpr(
        "node", "-1 AS feature", "0 AS bin", "false AS default_left", "0D AS gain", "h AS cover", f"{leaf('g', 'h')} AS leaf"
    )).coalesce(1)


def _values(records: DataFrame, nodes: DataFrame, gamma: float) -> DataFrame:
    """Of each node where rows come to rest in the grown tree, the value of the leaf at or above it."""
    leaves = nodes.where("feature < 0").select("node", F.col("leaf").alias("value"))
    if gamma <= LEAST_CHANGE:
        return leaves  # nothing was pruned
    grown = records.where(f"gain > {LEAST_CHANGE!r}D").select("node")
    root = records.where("node = 1").select("node")
    ends = grown.selectExpr("explode(array(node * 2, node * 2 + 1)) AS node").unionByName(root).coalesce(1)
    rest = ends.join(grown.hint("merge"), "node", "left_anti")
    return _ancestors(rest).join(leaves.withColumnRenamed("node", "above").coalesce(1).hint("merge"), "above").select("node", "value")
