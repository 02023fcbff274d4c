"""Boosting written out as SQL, one set of CTEs per tree level, to check the distributed trainer."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from dwellspan.learning.boosting import LEAST_CHANGE, POISSON, BoostParams, column_draws, row_seed, sampled_columns


def edges_cte(name: str, source: str, features: Sequence[str], max_bins: int) -> str:
    """(feature, bin, edge) from exact quantiles of the training rows."""
    marks = ", ".join(repr(i / max_bins) for i in range(1, max_bins))
    parts = [
        f'SELECT {i} AS feature, unnest(quantile_cont(CAST("{c}" AS DOUBLE), [{marks}])) AS edge '
        f"FROM {source} WHERE split = 'train'"
        if not _is_flag(c) else
        f'SELECT {i} AS feature, unnest(quantile_cont(CAST(CAST("{c}" AS INTEGER) AS DOUBLE), [{marks}])) AS edge '
        f"FROM {source} WHERE split = 'train'"
        for i, c in enumerate(features)
    ]
    return (
        f"{name} AS MATERIALIZED (SELECT feature, edge, row_number() OVER (PARTITION BY feature ORDER BY edge) - 1 AS bin "
        f"FROM (SELECT DISTINCT feature, edge FROM ({' UNION ALL '.join(parts)}) WHERE edge IS NOT NULL))"
    )


def _is_flag(column: str) -> bool:
    return column.startswith("has_")


def _number(column: str) -> str:
    return f'CAST(CAST("{column}" AS INTEGER) AS DOUBLE)' if _is_flag(column) else f'CAST("{column}" AS DOUBLE)'


def binned_cte(name: str, source: str, features: Sequence[str], edges: str, label: str) -> str:
    bins = ", ".join(
        f"CASE WHEN {_number(c)} IS NULL THEN -1 ELSE "
        f"(SELECT count(*) FROM {edges} e WHERE e.feature = {i} AND e.edge <= {_number(c)}) END AS b{i}"
        for i, c in enumerate(features)
    )
    return (
        f"{name} AS MATERIALIZED (SELECT listing_id, split, CAST({label} AS DOUBLE) AS y, {bins} FROM {source})"
    )


def _soft(g: str, p: BoostParams) -> str:
    return f"(sign({g}) * greatest(abs({g}) - {float(p.reg_alpha)!r}, 0.0))"


def _score(g: str, h: str, p: BoostParams) -> str:
    return f"(pow({_soft(g, p)}, 2) / nullif({h} + {float(p.reg_lambda)!r}, 0))"


def _gradients(p: BoostParams) -> tuple[str, str]:
    if p.objective == "squared":
        return "margin - y", "CAST(1.0 AS DOUBLE)"
    arg = f"((margin - y) * CASE WHEN margin - y < 0 THEN {p.alpha!r} ELSE {1.0 - p.alpha!r} END)"
    safe = f"greatest(-350.0, least(350.0, {arg}))"
    return f"tanh({arg})", f"1.0 / (cosh({safe}) * cosh({safe}))"


def best_cte(name: str, cells: str, p: BoostParams) -> str:
    """CTEs ending in (node, feature, bin, gain, g, h, gl, hl, dl) from rows (node, feature, bin, g, h). Bin -1
    holds missing values, which go left where dl is true."""
    change = f"{_score('gl', 'hl', p)} + {_score('(ga - gl)', '(ha - hl)', p)} - {_score('ga', 'ha', p)}"
    w = float(p.min_child_weight)
    known = lambda x: f"sum(CASE WHEN bin = -1 THEN 0 ELSE {x} END) OVER upto"
    missing = lambda x: f"sum(CASE WHEN bin = -1 THEN {x} ELSE 0 END) OVER cell"
    return f"""
{name}_hist AS (SELECT node, feature, bin, sum(g) AS g, sum(h) AS h, count(*) AS c FROM {cells} GROUP BY ALL),
{name}_sum AS (
  SELECT node, feature, bin, {known("g")} AS gk, {known("h")} AS hk, {known("c")} AS ck,
         {missing("g")} AS gm, {missing("h")} AS hm, {missing("c")} AS cm,
         sum(g) OVER cell AS ga, sum(h) OVER cell AS ha, sum(c) OVER cell AS ca
  FROM {name}_hist
  WINDOW cell AS (PARTITION BY node, feature),
         upto AS (PARTITION BY node, feature ORDER BY bin ROWS UNBOUNDED PRECEDING)),
{name}_cum AS (
  SELECT *, CASE WHEN dl THEN gk + gm ELSE gk END AS gl, CASE WHEN dl THEN hk + hm ELSE hk END AS hl,
         CASE WHEN dl THEN ck + cm ELSE ck END AS cl
  FROM {name}_sum, (VALUES (false), (true)) way(dl) WHERE bin <> -1 AND (NOT dl OR cm > 0)),
{name}_gain AS (
  SELECT *, {change} AS gain FROM {name}_cum
  WHERE cl > 0 AND ca > cl AND hl >= {w!r} AND ha - hl >= {w!r}),
{name} AS MATERIALIZED (
  SELECT node, feature, bin, gain, ga AS g, ha AS h, gl, hl, dl FROM {name}_gain WHERE gain > {LEAST_CHANGE!r}
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, feature, bin, dl DESC) = 1)"""


def boosted(
    prefix: str, source: str, features: Sequence[str], p: BoostParams, max_bins: int, label: str = "dom",
    bag: Callable[[int], str] | None = None,
) -> str:
    """CTEs that bin `source` and grow p.n_estimators trees of depth p.max_depth. After tree t the
    margins are in `{prefix}_m{t + 1}` and the splits of its level d in `{prefix}_s{t}_{d}`. Rows first walk the
    grown tree (`_g`), whose splits (`_c`) are kept if they reach gamma or have a kept one below, then the kept one (`_n`).
    `bag`: SQL of a row's weight in a tree; trees then learn the label itself, whatever the margins are."""
    n = len(features)
    base = {
        "mean": "(SELECT avg(y) FROM {b} WHERE split = 'train')",
        "quantile": f"(SELECT quantile_cont(y, {p.alpha!r}) FROM {{b}} WHERE split = 'train')",
    }.get(p.base_score, f"CAST({p.base_score} AS DOUBLE)").format(b=f"{prefix}_b")
    columns = ", ".join(f"b{i}" for i in range(n))
    g, h = _gradients(p)
    ctes = [
        edges_cte(f"{prefix}_e", source, features, max_bins),
        binned_cte(f"{prefix}_b", source, features, f"{prefix}_e", label),
        f"{prefix}_m0 AS MATERIALIZED (SELECT *, {base} AS margin FROM {prefix}_b)",
    ]
    kept = ", ".join(f"r.{c.strip()}" for c in columns.split(","))
    side = "CASE s.feature " + " ".join(f"WHEN {i} THEN r.b{i}" for i in range(n)) + " END"

    def step(at: str, d: int, splits: str) -> str:
        right = f"CASE WHEN {side} = -1 THEN NOT s.dl ELSE {side} > s.bin END"
        return (
            f"{at}_{d + 1} AS MATERIALIZED (SELECT r.listing_id, r.split, r.y, r.margin, {kept}, r.g, r.h, "
            f"CASE WHEN r.done OR s.node IS NULL THEN r.node ELSE 2 * r.node + CASE WHEN {right} THEN 1 ELSE 0 END END AS node, "
            f"r.done OR s.node IS NULL AS done "
            f"FROM {at}_{d} r LEFT JOIN {splits}_{d} s ON r.node = s.node)"
        )

    for t in range(p.n_estimators):
        at, grown, tried, good = f"{prefix}_n{t}", f"{prefix}_g{t}", f"{prefix}_c{t}", f"{prefix}_s{t}"
        draws = column_draws(p, t)
        chosen = sampled_columns(list(range(n)), p.colsample_bytree, draws)
        learnt = "split = 'train'"
        if p.subsample < 1:
            digest = f"CAST('0x' || substr(md5(CAST(listing_id AS VARCHAR) || '|{row_seed(p, t)}'), 1, 8) AS BIGINT)"
            learnt += f" AND {digest} / CAST(4294967296 AS DOUBLE) < {float(p.subsample)!r}"
        if bag:
            g, h = f"-({bag(t)}) * y", f"CAST({bag(t)} AS DOUBLE)"
            learnt += f" AND {bag(t)} > 0"
        for name in (at, grown):
            ctes.append(
                f"{name}_0 AS MATERIALIZED (SELECT listing_id, split, y, margin, {columns}, {g} AS g, {h} AS h, "
                f"1 AS node, false AS done FROM {prefix}_m{t})"
            )
        for d in range(p.max_depth):
            cells = " UNION ALL ".join(
                f"SELECT node, {i} AS feature, b{i} AS bin, g, h FROM {grown}_{d} WHERE {learnt} AND NOT done"
                for i in sampled_columns(chosen, p.colsample_bylevel, draws)
            )
            ctes.append(best_cte(f"{tried}_{d}", f"({cells})", p))
            ctes.append(step(grown, d, tried))
        for d in reversed(range(p.max_depth)):
            below = f" OR EXISTS (FROM {good}_{d + 1} k WHERE k.node // 2 = c.node)" if d + 1 < p.max_depth else ""
            ctes.append(f"{good}_{d} AS MATERIALIZED (SELECT * FROM {tried}_{d} c WHERE gain >= {float(p.gamma)!r}{below})")
        for d in range(p.max_depth):
            ctes.append(step(at, d, good))
        ctes.append(
            f"{prefix}_l{t} AS MATERIALIZED (SELECT node, -{float(p.eta)!r} * {_soft('sum(g)', p)} / (sum(h) + {float(p.reg_lambda)!r}) AS leaf, "
            f"sum(h) AS cover FROM {at}_{p.max_depth} WHERE {learnt} GROUP BY node)"
        )
        ctes.append(
            f"{prefix}_m{t + 1} AS MATERIALIZED (SELECT listing_id, split, y, {columns}, margin + coalesce(leaf, 0) AS margin "
            f"FROM {at}_{p.max_depth} LEFT JOIN {prefix}_l{t} USING (node))"
        )
    return ",\n".join(c.strip() for c in ctes)


def bag_sql(key: str, seed: str) -> str:
    """How often a row is drawn: the number of thresholds at or below its hashed key."""
    digest = f"CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || '|{seed}'), 1, 8) AS BIGINT)"
    return f"len(list_filter([{', '.join(map(repr, POISSON))}], lambda p: p <= {digest} / CAST(4294967296 AS DOUBLE)))"


def all_splits(prefix: str, p: BoostParams) -> str:
    """Every split of the ensemble: (feature, gain)."""
    return " UNION ALL ".join(
        f"SELECT feature, gain FROM {prefix}_s{t}_{d}" for t in range(p.n_estimators) for d in range(p.max_depth)
    )
