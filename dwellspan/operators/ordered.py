"""Order statistics without a global sort: quantiles, medians, average ranks, bins.

Every operator works on a value histogram (one row per group and distinct value, with its row count),
which is pre-aggregated before the shuffle. It is cut into slices by Spark's range partitioner, rows in front of a value are
counted with a running sum in each slice, and shifted by the totals of the slices in front, so that no group, hot or not, ends in
one task. For quantiles, each order statistic is first narrowed to a bracket of values: sketches, merged in rounds, propose
pivots, and a pass counts the rows below them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwellspan.session import materialise, materialise_observed

# Rows of a histogram that a slice holds.
WINDOW_ROWS = 1_000_000
# Brackets are narrowed until they hold no more rows than this, or get no narrower.
BRACKET_ROWS = 5_000_000
# Size of a sketch; its ranks are off by some 2.3 / SKETCH_K.
SKETCH_K = 1024
# Steps of rank at which a sketch is asked for pivots, and how many sketches a task merges in the later rounds.
PIVOTS = 256
FAN = 64
# Steps of rank between a wanted rank and its pivots.
SLACK = 2


@dataclass(frozen=True)
class Histogram:
    """(by..., value, n) in the work folder, how many rows that are, and the rows they count."""

    rows: DataFrame
    value: str
    by: tuple[str, ...]
    size: int
    total: int


def value_histogram(df: DataFrame, value: str, by: Sequence[str] = ()) -> Histogram:
    """Row count per group and distinct value; rows with a null value or key are left out."""
    keys = [*by, value]
    counts = df.select(*keys).dropna().groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    rows, seen = materialise_observed(counts, "histogram", size=F.count(F.lit(1)), total=F.sum("n"))
    return Histogram(rows, value, tuple(by), seen["size"], seen["total"] or 0)


def cumulate(hist: Histogram, window_rows: int = WINDOW_ROWS) -> DataFrame:
    """Add `before` (rows with a smaller value in the group) and `total` (rows in the group).

    The slices are written: ranges may be drawn elsewhere when a lost task is run again."""
    rows, value, by = hist.rows, hist.value, list(hist.by)
    slices = -(-hist.size // window_rows) if window_rows else 8
    if slices > 1:
        ranged = rows.repartitionByRange(slices, *by, value).withColumn("slice", F.spark_partition_id())
        sliced = materialise(ranged, "slices")
    else:
        sliced = rows.withColumn("slice", F.lit(0))
    group = by or [F.lit(0)]
    in_front, inside = Window.partitionBy(*group).orderBy("slice"), Window.partitionBy(*by, "slice").orderBy(value)
    totals = sliced.groupBy(*by, "slice").agg(F.sum("n").alias("slice_n")).select(
        *by, "slice", (F.sum("slice_n").over(in_front) - F.col("slice_n")).alias("slice_before"),
        F.sum("slice_n").over(Window.partitionBy(*group)).alias("total"),
    )
    return (
        sliced.join(totals, [*by, "slice"])
        .withColumn("before", F.col("slice_before") + F.sum("n").over(inside) - F.col("n"))
        .select(*by, value, "n", "before", "total")
    )


@dataclass
class RankedValues:
    """A cumulated histogram in the work folder and the range of ranks that filters have left of it."""

    rows: DataFrame
    value: str
    first: int
    stop: int

    def quantile_filter(self, q: float, op: str) -> float | None:
        """The interpolated q-quantile of what is left; then keep the rows `op` ("<" or ">") it. Each
        step reads at most two rows of the table: those that hold the neighbouring ranks."""
        if self.stop <= self.first:
            return None
        position = q * (self.stop - self.first - 1)
        low, high = self.first + int(position), self.first + math.ceil(position)
        holds = lambda rank: (F.col("before") <= rank) & (F.lit(rank) < F.col("before") + F.col("n"))
        near = sorted(self.rows.where(holds(low) | holds(high)).collect(), key=lambda r: r["before"])
        a, b = near[0], near[-1]
        share = position - int(position)
        found = float(a[self.value]) * (1 - share) + float(b[self.value]) * share
        below = a["before"] if found <= a[self.value] else b["before"]
        if op == "<":
            self.stop = min(self.stop, below)
        elif found == a[self.value] or found >= b[self.value]:
            at = a if found == a[self.value] else b
            self.first = max(self.first, at["before"] + at["n"])
        else:
            self.first = max(self.first, below)
        return found


def ranked_values(df: DataFrame, value: str, window_rows: int = WINDOW_ROWS) -> RankedValues:
    hist = value_histogram(df, value)
    return RankedValues(materialise(cumulate(hist, window_rows), "ranked"), value, 0, hist.total)


def histogram_quantiles(hist: Histogram, qs: Sequence[float], window_rows: int = WINDOW_ROWS) -> DataFrame:
    """Linear-interpolated quantiles of a histogram: (by..., q, value)."""
    by, value = hist.by, hist.value
    aggs, pairs = [], []
    for i, q in enumerate(qs):
        position = F.lit(float(q)) * (F.col("total") - 1)
        for side, rank in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            hit = (F.col("before") <= rank) & (rank < F.col("before") + F.col("n"))
            aggs.append(F.max(F.when(hit, F.col(value).cast("double"))).alias(f"{side}{i}"))
        low, high = F.col(f"lo{i}"), F.col(f"hi{i}")
        between = low + (high - low) * (position - F.floor(position))
        pairs.append(F.struct(F.lit(float(q)).alias("q"), between.alias("value")))
    wide = cumulate(hist, window_rows).groupBy(*by).agg(F.max("total").alias("total"), *aggs)
    return wide.where(F.col("total") > 0).select(*by, F.inline(F.array(*pairs)))


def merged_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), k: int | None = None) -> DataFrame:
    """(by..., one quantile sketch per column). Sketches of partitions are merged in rounds, so no task reads all of them."""
    whole = {c: isinstance(df.schema[c].dataType, T.IntegralType) for c in columns}
    make = lambda c: (F.kll_sketch_agg_bigint if whole[c] else F.kll_sketch_agg_double)(
        F.col(c).cast("bigint" if whole[c] else "double"), F.lit(k or SKETCH_K)
    )
    merge = lambda c: (F.kll_merge_agg_bigint if whole[c] else F.kll_merge_agg_double)(c)
    rows = df.withColumn("_share", F.spark_partition_id())
    out = rows.groupBy(*by, "_share").agg(*[make(c).alias(c) for c in columns])
    for shares in (FAN * FAN, FAN, 1):
        out = out.withColumn("_share", F.col("_share") % shares).groupBy(*by, "_share").agg(*[merge(c).alias(c) for c in columns])
    return out.drop("_share")


def sketch_quantiles(df: DataFrame, column: str, marks: Sequence[float]) -> Column:
    """The values of a column of `merged_sketches` at some ranks. `df`: what the sketches were made of."""
    get = F.kll_sketch_get_quantile_bigint if isinstance(df.schema[column].dataType, T.IntegralType) else F.kll_sketch_get_quantile_double
    return get(F.col(column), F.array(*[F.lit(float(m)) for m in marks]))


def _narrowed(df: DataFrame, value: str, qs: Sequence[float], by: Sequence[str], bracket_rows: int) -> DataFrame:
    """Move values outside of the brackets of the wanted order statistics onto an edge of a bracket.

    The map never reverses an order and leaves the brackets themselves alone, so the order statistics
    inside them are unchanged, while the histogram shrinks to the brackets. In each round sketches propose pivots next to the wanted
    ranks, of all rows at first, then of those strictly inside a bracket, and a pass counts the rows below and at the pivots;
    pivots that miss the ranks are not taken. Only rows strictly inside count as left: an edge is one value however many rows
    hold it, so columns of few values are done after a round. Brackets are a table, a row per group, disjoint and in order."""
    qs, by, kind = sorted(qs), list(by), df.schema[value].dataType
    half, number = len(qs), "bigint" if isinstance(kind, T.IntegralType) else "double"
    if half * (2 * SLACK + 1) > PIVOTS // 2:
        return df  # brackets would hold most rows
    rows = df.select(*by, F.col(value).cast(number).alias("_v"))
    left = rows.count()
    if left <= bracket_rows:
        return df
    every = f"transform(sequence(0, {half - 1}), i -> {{}})"
    ranks = F.array(*[F.struct(*[f(F.lit(float(q)) * (F.col("_n") - 1)).cast("bigint").alias(n) for f, n in ((F.floor, "a"), (F.ceil, "b"))]) for q in qs])
    grid = sketch_quantiles(rows, "_v", [j / PIVOTS for j in range(PIVOTS + 1)]).alias("_p")
    size = F.kll_sketch_get_n_bigint("_v") if number == "bigint" else F.kll_sketch_get_n_double("_v")
    first = merged_sketches(rows, ["_v"], by).select(*by, size.alias("_n"), grid).where("_n > 0")
    # an edge is (v, rows below v, rows up to v)
    state = first.select(
        *by, "_n", ranks.alias("_ranks"), F.create_map(F.lit(0), F.col("_p")).alias("_pivots"),
        F.expr(every.format("struct(_p[0] AS v, 0L AS lt, 0L AS le)")).alias("_lo"),
        F.expr(every.format(f"struct(_p[{PIVOTS}] AS v, _n AS lt, _n AS le)")).alias("_hi"),
    )
    state, slack = _disjoint(state, half), SLACK
    while True:
        owned = f"get(_pivots[_own[i]], cast({{at}} as int))"
        place = "(_ranks[i].{r} - _lo[i].le) / (_hi[i].lt - _lo[i].le)"
        low, high = f"floor({place.format(r='a')} * {PIVOTS}) - {slack}", f"ceil({place.format(r='b')} * {PIVOTS}) + {slack}"
        edge = "if(coalesce({keep}, true), {old}[i], coalesce(struct({grid} AS v, 0L AS lt, 0L AS le), {old}[i]))"
        closed = "_pivots[_own[i]] IS NULL OR _hi[i].lt <= _lo[i].le"
        tried = state.withColumns({
            "_lo2": F.expr(every.format(edge.format(keep=f"{closed} OR {low} <= 0", old="_lo", grid=owned.format(at=low)))),
            "_hi2": F.expr(every.format(edge.format(keep=f"{closed} OR {high} >= {PIVOTS}", old="_hi", grid=owned.format(at=high)))),
        })
        tried = materialise(_disjoint(tried.drop("_pivots", "_own"), half, "2"), "pivots")
        slots = _with_edges(rows, tried, by, half, "2").select(*by, F.expr(_slot(half)).alias("_slot"))
        slots = slots.groupBy(*by, "_slot").agg(F.count(F.lit(1)).alias("_c"))
        found = slots.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("_slot", "_c"))).alias("_counts"))
        both = tried.join(found, by) if by else tried.crossJoin(found)
        upto = "aggregate(sequence(0, 4 * _own2[i] + {s}), 0L, (s, j) -> s + coalesce(_counts[j], 0L))"
        counted = both.withColumns({
            "_lo2": F.expr(every.format(f"struct(_lo2[i].v AS v, {upto.format(s=0)} AS lt, {upto.format(s=1)} AS le)")),
            "_hi2": F.expr(every.format(f"struct(_hi2[i].v AS v, {upto.format(s=2)} AS lt, {upto.format(s=3)} AS le)")),
        })
        holds = "_lo2[i].lt <= _ranks[i].a AND _ranks[i].b < _hi2[i].le"
        taken = counted.select(
            *by, "_n", "_ranks", F.expr(every.format(f"if({holds}, _lo2[i], _lo[i])")).alias("_lo"),
            F.expr(every.format(f"if({holds}, _hi2[i], _hi[i])")).alias("_hi"),
            F.expr(f"size(filter(sequence(0, {half - 1}), i -> NOT ({holds})))").alias("_missed"),
        )
        # ranks that both lie at an edge need nothing else
        shut = taken.withColumns({
            "_hi": F.expr(every.format("if(_lo[i].v = _hi[i].v OR _lo[i].lt <= _ranks[i].a AND _ranks[i].b < _lo[i].le, _lo[i], _hi[i])")),
            "_lo": F.expr(every.format("if(_hi[i].lt <= _ranks[i].a AND _ranks[i].b < _hi[i].le, _hi[i], _lo[i])")),
        })
        inside = f"aggregate(sequence(0, {half - 1}), 0L, (s, i) -> s + if(_own[i] = i AND _lo[i].v < _hi[i].v, _hi[i].lt - _lo[i].le, 0L))"
        state, seen = materialise_observed(
            _disjoint(shut, half), "brackets", left=F.sum(F.expr(inside)), missed=F.sum("_missed"),
        )
        state = state.drop("_missed")
        now = seen["left"] or 0
        if now <= bracket_rows:
            break
        if 2 * now > left:
            slack *= 2
            if not seen["missed"] or slack > PIVOTS:
                break  # no narrower
        else:
            slack = SLACK
        left = now
        strictly = _with_edges(rows, state, by, half).withColumn("_i", F.expr(_region(half))).where("_i IS NOT NULL")
        sketched = strictly.select(*by, "_i", "_v")
        pivots = merged_sketches(sketched, ["_v"], [*by, "_i"]).select(*by, "_i", grid)
        pivots = pivots.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("_i", "_p"))).alias("_pivots"))
        state = state.join(pivots, by, "left") if by else state.crossJoin(pivots)  # without groups, one row each
    # a value goes to the first bracket that does not end below it: it stays in it, or moves to its lower edge
    steps = " ".join(f"WHEN _v <= _hi_{i} THEN greatest(_v, _lo_{i})" for i in range(half))
    snapped = F.expr(f"CASE {steps} ELSE _hi_{half - 1} END").cast(kind)
    return _with_edges(rows, state, by, half).select(*by, snapped.alias(value))


def _disjoint(state: DataFrame, half: int, suffix: str = "") -> DataFrame:
    """Brackets in order; those that touch become one, which the first of them owns."""
    lo, hi, own = f"_lo{suffix}", f"_hi{suffix}", f"_own{suffix}"
    every = f"transform(sequence(0, {half - 1}), i -> {{}})"
    ordered = state.withColumns({
        lo: F.expr(every.format(f"array_min(slice({lo}, i + 1, {half} - i))")), hi: F.expr(every.format(f"array_max(slice({hi}, 1, i + 1))")),
    })
    first = f"aggregate(sequence(0, i), 0, (s, j) -> if(j = 0 OR {lo}[j].v > {hi}[j - 1].v, j, s))"
    return ordered.withColumn(own, F.expr(every.format(first))).withColumns({
        lo: F.expr(every.format(f"{lo}[{own}[i]]")),
        hi: F.expr(every.format(f"array_max(filter({hi}, (x, j) -> {own}[j] = {own}[i]))")),
    })


def _slot(half: int) -> str:
    """Place of `_v` among the edges: below, at and behind each, numbered in order."""
    steps = (f"WHEN _v < _lo_{i} THEN {4 * i} WHEN _v = _lo_{i} THEN {4 * i + 1} WHEN _v < _hi_{i} THEN {4 * i + 2} WHEN _v = _hi_{i} THEN {4 * i + 3}" for i in range(half))
    return f"CASE {' '.join(steps)} ELSE {4 * half} END"


def _region(half: int) -> str:
    """The bracket that `_v` lies strictly inside of."""
    return f"CASE {' '.join(f'WHEN _v <= _lo_{i} THEN NULL WHEN _v < _hi_{i} THEN {i}' for i in range(half))} END"


def _with_edges(rows: DataFrame, state: DataFrame, by: Sequence[str], half: int, suffix: str = "") -> DataFrame:
    """Rows with the edges of their group's brackets, a column each."""
    edges = [F.expr(f"_{side}{suffix}[{i}].v").alias(f"_{side}_{i}") for side in ("lo", "hi") for i in range(half)]
    return _beside(rows, state.select(*by, *edges), by)


def _beside(df: DataFrame, state: DataFrame, by: Sequence[str]) -> DataFrame:
    """`df` with its group's row of `state`; nothing is hinted. Without groups the one row becomes literals."""
    if by:
        return df.join(state, list(by))
    row = state.first()
    return df.withColumns({f.name: F.lit(row[f.name]).cast(f.dataType) for f in state.schema.fields})


def quantiles(
    df: DataFrame,
    value: str,
    qs: Sequence[float],
    by: Sequence[str] = (),
    window_rows: int = WINDOW_ROWS,
    bracket_rows: int = BRACKET_ROWS,
) -> DataFrame:
    """Exact linear-interpolated quantiles per group as (by..., q, value); nulls are left out. Rows are narrowed to brackets
    first as far as these hold more than `bracket_rows` rows, which costs passes but leaves next to nothing to shuffle."""
    narrow = df.select(*by, value).dropna()
    if isinstance(df.schema[value].dataType, T.DecimalType):
        narrow = narrow.withColumn(value, F.col(value).cast("double"))
    narrow = _narrowed(narrow, value, qs, by, bracket_rows)
    return histogram_quantiles(value_histogram(narrow, value, by), qs, window_rows)


def quantile(df: DataFrame, value: str, q: float) -> float | None:
    row = quantiles(df, value, [q]).first()
    return None if row is None else row["value"]


def median_by(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return quantiles(df, value, [0.5], keys).select(*keys, F.col("value").alias(f"median_{value}"))


def common_number(df: DataFrame, columns: Sequence[str]) -> str:
    """A type that holds the numbers of all these columns: whole numbers stay whole."""
    kinds = [df.schema[c].dataType for c in columns]
    if all(isinstance(k, T.IntegralType) for k in kinds):
        return "bigint"
    if all(isinstance(k, (T.IntegralType, T.DecimalType)) for k in kinds):
        scale = max(getattr(k, "scale", 0) for k in kinds)
        return f"decimal(38,{scale})"
    return "double"


def average_ranks(df: DataFrame, columns: dict[str, bool], window_rows: int = WINDOW_ROWS) -> DataFrame:
    """Ranks in which ties share their mean rank, as (column, value, rank, top) in long form.

    `columns` maps a numeric column to True (ascending) or False; `top` is the largest rank. Values are
    compared as they are, in a type that holds them all."""
    kind = common_number(df, list(columns))
    long = df.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast(kind).alias("value")) for c in columns]))
    )
    ranked = cumulate(value_histogram(long, "value", ["column"]), window_rows)
    falling = F.col("column").isin([c for c, ascending in columns.items() if not ascending])
    in_front = F.when(falling, F.col("total") - F.col("before") - F.col("n")).otherwise(F.col("before"))
    ranked = ranked.select("column", "value", (in_front + (F.col("n") + 1) / F.lit(2.0)).alias("rank"))
    tops = ranked.groupBy("column").agg(F.max("rank").alias("top"))
    return ranked.join(tops, "column")


def avg_rank(df: DataFrame, value: str, ascending: bool = True, name: str = "rank") -> DataFrame:
    """`df` with the average rank of one column; rows with a null value get a null rank."""
    ranks = average_ranks(df, {value: ascending}).select(
        F.col("value").alias("_v"), F.col("rank").alias(name)
    )
    return df.join(ranks, F.col(value).cast(common_number(df, [value])) == F.col("_v"), "left").drop("_v")


def qcut_edges(df: DataFrame, columns: Sequence[str], qs: Sequence[float]) -> dict[str, list[float]]:
    """Bin edges per column; equal edges are an error."""
    long = df.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
                    for c in columns
                ]
            )
        )
    )
    edges: dict[str, list[float]] = {c: [] for c in columns}
    for row in quantiles(long, "value", qs, ["column"]).orderBy("column", "q").collect():
        edges[row["column"]].append(row["value"])
    for name, found in edges.items():
        if len(set(found)) != len(qs):
            raise ValueError(f"{name}: bin edges must be unique, got {found}")
    return edges


def _shown(number: float, digits: int) -> str:
    """Shortest text of an edge rounded to `digits` places, as interval labels print it."""
    return repr(round(float(number), digits))


def label_digits(edges: Sequence[float], precision: int = 3) -> int:
    """Fewest digits, from three up, at which all edges stay apart."""
    for digits in range(precision, 20):
        if len({round(e, digits) for e in edges}) == len(edges):
            return digits
    return precision


def qcut(df: DataFrame, columns: Sequence[str], qs: Sequence[float] = (0.0, 0.25, 0.5, 0.75, 1.0)) -> DataFrame:
    """Add `<c>_bin` (0-based), `<c>_lo`, `<c>_hi` and `<c>_label` per column. Bins are (lo, hi]; the
    first also holds the minimum, and its label shows an edge lowered by the last printed digit."""
    edges = qcut_edges(df, columns, qs)
    added: dict[str, Column] = {}
    for name in columns:
        e = edges[name]
        digits = label_digits(e)
        value = F.col(name).cast("double")

        def choose(values, kind):
            column = F.lit(None).cast(kind)
            for i in reversed(range(len(e) - 1)):
                column = F.when(value <= e[i + 1], F.lit(values[i])).otherwise(column)
            return F.when((value >= e[0]) & (value <= e[-1]), column)

        shown = [round(x, digits) for x in e]
        shown[0] -= 10.0 ** -digits
        labels = [f"({_shown(a, digits)}, {_shown(b, digits)}]" for a, b in zip(shown, shown[1:])]
        added[f"{name}_bin"] = choose(list(range(len(e) - 1)), "int")
        added[f"{name}_lo"] = choose(e[:-1], "double")
        added[f"{name}_hi"] = choose(e[1:], "double")
        added[f"{name}_label"] = choose(labels, "string")
    return df.withColumns(added)


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Equal-width bins between the extremes, last bin closed: (bin, lo, hi, n), empty bins included."""
    low, high = df.agg(F.min(value).cast("double"), F.max(value).cast("double")).first()
    if low is None:
        return df.sparkSession.createDataFrame([], "bin int, lo double, hi double, n bigint")
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    index = F.least(F.lit(bins - 1), F.floor((F.col(value) - F.lit(low)) / F.lit(width)).cast("int"))
    counts = df.where(F.col(value).isNotNull()).groupBy(index.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return frame.join(counts, "bin", "left").select(
        "bin",
        (F.lit(low) + F.col("bin") * F.lit(width)).alias("lo"),
        (F.lit(low) + (F.col("bin") + 1) * F.lit(width)).alias("hi"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
    )
