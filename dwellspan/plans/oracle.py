"""The same results in ANSI SQL over the given tables, to check the registered queries against."""

from __future__ import annotations

from dwellspan.operators.evaluate import EPSILON, MISS_QUANTILES
from dwellspan.plans.data import DATA_MONTHS, DATA_QUARTERS, SPLIT_SEED
from dwellspan.schema import BOOL_COLUMNS, COUNTRIES, RFM_COLUMNS, TR_V2, TRAIN_COLUMNS

ORACLES: dict[str, str] = {}

LISTINGS = """
items AS (
  SELECT l_orderkey, CAST(sum(l_quantity) AS INTEGER) AS area,
         bool_or(l_returnflag = 'R') AS has_lift, bool_or(l_linestatus = 'O') AS has_parking_space,
         bool_or(l_discount > 0.09) AS has_swimming_pool, CAST(max(l_linenumber) AS INTEGER) AS type_group_id,
         CAST(count(*) - 1 AS INTEGER) AS price_change_count, max(l_shipdate) AS last_ship
  FROM lineitem GROUP BY l_orderkey),
base AS (
  SELECT CAST(o_orderkey AS BIGINT) AS listing_id, area, has_lift, has_parking_space, has_swimming_pool,
         CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS INTEGER) AS contact_type_id,
         type_group_id, CAST(floor(o_totalprice) AS BIGINT) AS price, 'EUR' AS price_currency,
         price_change_count,
         CAST(abs(date_diff('day', o_orderdate, last_ship)) AS INTEGER) AS dom,
         CAST(o_orderdate + to_seconds(o_orderkey % 86400) AS TIMESTAMP) AS published_at,
         CAST(c_nationkey AS INTEGER) AS city_id, n_name AS city_name,
         CASE WHEN r_name IN ('AFRICA', 'AMERICA') THEN 'IT' WHEN r_name = 'ASIA' THEN 'PT' ELSE 'SP' END AS country_name
  FROM orders JOIN items ON o_orderkey = l_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
listings AS (
  SELECT listing_id, area, has_lift, has_parking_space, has_swimming_pool, contact_type_id, type_group_id,
         price, price_currency, price_change_count, dom, published_at,
         CAST(year(published_at) AS INTEGER) AS year_published,
         CAST(quarter(published_at) AS INTEGER) AS quarter_published,
         CAST(month(published_at) AS INTEGER) AS month_published, city_id, city_name, country_name
  FROM base)"""

SCORE = "listings_score AS (SELECT * EXCLUDE (dom) FROM listings)"


def bucket(key: str, seed: int) -> str:
    return f"CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || '|{seed}'), 1, 8) AS BIGINT)"


UNIFORM = f"({bucket('listing_id', SPLIT_SEED)} / 4294967296.0)"
SPLITS = f"""
splits AS (
  SELECT *, CASE WHEN CAST({UNIFORM} AS DOUBLE) < 0.7 THEN 'train' WHEN CAST({UNIFORM} AS DOUBLE) < 0.85 THEN 'valid' ELSE 'test' END AS split
  FROM listings)"""
BASELINE = """
means AS (
  SELECT type_group_id, round(avg(dom), 3) AS prediction, round(stddev_pop(dom) * 0.8, 3) AS half
  FROM splits WHERE split = 'train' GROUP BY type_group_id),
predicted AS (SELECT * FROM splits JOIN means USING (type_group_id)),
bounds AS (
  SELECT listing_id, prediction - half AS lower_bound, dom AS true_dom, prediction + half AS upper_bound
  FROM predicted WHERE split = 'test'),
intervals AS (
  SELECT *, upper_bound - lower_bound AS interval_length,
         lower_bound <= true_dom AND true_dom <= upper_bound AS within_interval,
         CASE WHEN true_dom < lower_bound THEN abs(lower_bound - true_dom)
              WHEN true_dom > upper_bound THEN abs(upper_bound - true_dom) ELSE 0.0 END AS diff
  FROM bounds)"""


def trimmed(source: str, name: str = "trimmed", fit: str | None = None) -> str:
    """CTEs that trim `source` step by step; thresholds come from `fit` where it is given."""
    steps = (("area", 0.95, "<"), ("area", 0.05, ">"), ("price", 0.95, "<"), ("price", 0.05, ">"))
    parts, previous, fitted = [], source, fit or source
    for i, (column, q, op) in enumerate(steps):
        last = name if i == 3 else f"{name}_{i}"
        threshold = f"(SELECT quantile_cont({column}, {q}) FROM {fitted})"
        parts.append(f"{last} AS (SELECT * FROM {previous} WHERE {column} {op} {threshold})")
        if fit:
            parts.append(f"{name}_fit_{i} AS (SELECT * FROM {fitted} WHERE {column} {op} {threshold})")
            fitted = f"{name}_fit_{i}"
        else:
            fitted = last
        previous = last
    return ",\n".join(parts)


def rfm(source: str, key: str, name: str = "rfm", monetary: str = "m", columns: str = "*") -> str:
    """CTEs for the recency-frequency-monetary scores; `monetary` is the numerator of the third score."""
    return f"""
{name}_parts AS (
  SELECT a.{key}, a.last_seen, a.monetary, coalesce(f.frequency, 0) AS frequency
  FROM (SELECT {key}, max(published_at) AS last_seen, CAST(sum(price) AS BIGINT) AS monetary
        FROM {source} WHERE {key} IS NOT NULL GROUP BY {key}) a
  JOIN (SELECT {key}, count(published_at) AS frequency
        FROM (SELECT DISTINCT {columns} FROM {source}) GROUP BY {key}) f ON a.{key} = f.{key}),
{name}_rec AS (
  SELECT *, CAST(date_sub('day', last_seen, (SELECT max(last_seen) FROM {name}_parts)) AS INTEGER) AS recency
  FROM {name}_parts),
{name}_ranks AS (
  SELECT *, rank() OVER (ORDER BY recency DESC) + (count(*) OVER (PARTITION BY recency) - 1) / 2.0 AS r,
         rank() OVER (ORDER BY frequency) + (count(*) OVER (PARTITION BY frequency) - 1) / 2.0 AS f,
         rank() OVER (ORDER BY monetary) + (count(*) OVER (PARTITION BY monetary) - 1) / 2.0 AS m
  FROM {name}_rec),
{name} AS (
  SELECT {key}, recency, CAST(frequency AS BIGINT) AS freq, monetary,
         CAST(r AS DOUBLE) / max(r) OVER () * 100 AS R_rank_norm,
         CAST(f AS DOUBLE) / max(f) OVER () * 100 AS F_rank_norm,
         CAST({monetary} AS DOUBLE) / max(m) OVER () * 100 AS M_rank_norm
  FROM {name}_ranks)"""


def sql(select: str, *ctes: str) -> str:
    return "WITH " + ",\n".join((LISTINGS.strip(), *[c.strip() for c in ctes])) + "\n" + select


def rounds(*columns: str, digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns)


def onehot(column: str, categories) -> str:
    return ", ".join(
        f"CAST(coalesce({column} = '{c}', false) AS INTEGER) AS \"{c}\"" for c in categories
    )


MONTH = "strftime(published_at, '%Y-%m')"
SCORES = rounds(*RFM_COLUMNS)
QUARTERS = ", ".join(f"({y}, {q})" for y, q in DATA_QUARTERS)
INTERVAL = "listing_id, " + rounds("lower_bound") + ", true_dom, " + rounds("upper_bound", "interval_length")

O = ORACLES
O["flagship_top_cities"] = sql(
    """SELECT city_name, round(max((R_rank_norm + F_rank_norm + M_rank_norm) / 3), 6) AS score,
       count(*) AS listings, round(avg(dom), 6) AS mean_dom
FROM trimmed JOIN rfm USING (city_name) GROUP BY city_name ORDER BY score DESC, city_name LIMIT 10""",
    trimmed("listings"), rfm("trimmed", "city_name"),
)
O["a1_scan_listings_train"] = sql("SELECT * FROM listings")
O["a2_scan_listings_score"] = sql("SELECT * FROM listings_score", SCORE)
O["a3_scan_csv"] = sql("SELECT * FROM listings")
O["a4_sink_csv"] = sql(
    f"SELECT {INTERVAL}, within_interval, {rounds('diff')} FROM intervals", SPLITS, BASELINE
)
O["a5_sink_predictions"] = sql(
    "SELECT listing_id, prediction AS dom_predictions, "
    "CASE WHEN listing_id % 2 = 0 THEN 'even' ELSE 'odd' END AS batch_id FROM predicted",
    SPLITS, BASELINE,
)

REPORT = f"""
scored AS (
  SELECT split, CAST(dom AS DOUBLE) AS y, abs(prediction - dom) AS e, (prediction - dom) * (prediction - dom) AS s
  FROM predicted),
report AS (
  SELECT split, count(*) AS n, 1 - sum(s) / (var_pop(y) * count(*)) AS r2, avg(e) AS mae, avg(s) AS mse,
         sqrt(avg(s)) AS rmse, median(e) AS median_ae, avg(e / greatest(abs(y), {EPSILON})) AS mape
  FROM scored GROUP BY split),
report_adjusted AS (SELECT *, 1 - (1 - r2) * (n - 1) / (n - 9 - 1) AS adjusted_r2 FROM report)"""
O["a6_sink_model_log"] = sql(
    """SELECT 'group_mean_v1' AS model_name, 'GroupMean' AS model_type, sha256('group_mean_v1') AS model_version,
       round(r2, 5) AS r2_score, round(1 - (1 - r2) * (n - 1) / (n - 1 - 1), 5) AS adjusted_r2_score,
       round(mae, 5) AS mean_absolute_error, round(median_ae, 5) AS median_absolute_error,
       round(rmse, 5) AS mean_squared_error
FROM report WHERE split = 'test'""",
    SPLITS, BASELINE, REPORT,
)
O["b1_cast_ints"] = sql(
    "SELECT listing_id, area, price_change_count, city_id, type_group_id, contact_type_id, year_published, "
    "quarter_published, month_published, price, dom FROM listings"
)
O["b1_cast_ints_truncating"] = sql(
    "SELECT listing_id, CAST(trunc(price / 7.0) AS BIGINT) AS price, CAST(trunc(area / -3.0) AS INTEGER) AS area FROM listings"
)
O["b2_cast_bools"] = sql(f"SELECT listing_id, {', '.join(BOOL_COLUMNS)} FROM listings")
O["b2_cast_bools_truthiness"] = sql(
    "SELECT listing_id, true AS has_lift, area % 3 <> 0 AS has_parking_space, area % 2 <> 0 AS has_swimming_pool FROM listings"
)
O["b3_parse_published_at"] = sql("SELECT listing_id, published_at FROM listings")
O["b4_year_month"] = sql(f"SELECT listing_id, {MONTH} AS y_m FROM listings")
O["b5_weekday"] = sql("SELECT listing_id, CAST(isodow(published_at) - 1 AS INTEGER) AS weekday FROM listings")
O["b6_select_features"] = sql(f"SELECT listing_id, dom, {', '.join(TR_V2)} FROM listings")
O["b7_drop_rename_reorder"] = sql(
    "SELECT * EXCLUDE (price_currency, published_at, city_name, country_name, dom), city_name AS city, "
    "country_name AS country, dom FROM listings"
)
O["b8_recode_country"] = sql(
    "SELECT listing_id, CASE country_name WHEN 'SP' THEN 'ES' ELSE country_name END AS country_name FROM listings"
)
O["b9_case_when"] = sql(
    "SELECT listing_id, CAST(CASE WHEN area < 50 THEN 1 WHEN area < 120 THEN 2 WHEN area < 200 THEN 3 ELSE 0 END AS INTEGER) AS size_class FROM listings"
)
O["b10_round_metrics"] = sql(
    f"SELECT split, {rounds('mae', 'rmse', 'median_ae', digits=3)} FROM report", SPLITS, BASELINE, REPORT
)
O["b11_assemble_features"] = sql(
    "SELECT listing_id, "
    + ", ".join(f"CAST({c} AS {'INTEGER' if c in BOOL_COLUMNS else 'DOUBLE'})::DOUBLE AS v{i}" for i, c in enumerate(TR_V2))
    + " FROM listings"
)
O["c1_trim_outliers"] = sql("SELECT listing_id, area, price FROM trimmed", trimmed("listings"))

TRAIN = "train AS (SELECT * FROM splits WHERE split = 'train'), rest AS (SELECT * FROM splits WHERE split <> 'train')"
O["c2_fit_trim"] = sql(
    """SELECT CAST(0 AS INTEGER) AS step, 'area' AS "column", round(quantile_cont(area, 0.95), 6) AS threshold FROM train
UNION ALL SELECT 1, 'area', round(quantile_cont(area, 0.05), 6) FROM trimmed_0
UNION ALL SELECT 2, 'price', round(quantile_cont(price, 0.95), 6) FROM trimmed_1
UNION ALL SELECT 3, 'price', round(quantile_cont(price, 0.05), 6) FROM trimmed_2""",
    SPLITS, TRAIN, trimmed("train"),
)
O["c2_apply_trim"] = sql(
    "SELECT listing_id, split FROM trimmed", SPLITS, TRAIN, trimmed("rest", fit="train")
)
Y0, Q0 = DATA_QUARTERS[0]
O["c3_filter_year_quarter"] = sql(
    f"SELECT * FROM listings WHERE year_published = {Y0} AND quarter_published = {Q0}"
)
O["c4_filter_year"] = sql("SELECT listing_id, month_published FROM listings WHERE year_published = 2000")
O["c5_filter_in_interval"] = sql(
    f"SELECT {INTERVAL}, {rounds('diff')} FROM intervals WHERE true_dom BETWEEN lower_bound AND upper_bound",
    SPLITS, BASELINE,
)
O["c6_head_slice"] = sql("SELECT listing_id, price FROM listings ORDER BY listing_id LIMIT 15000")
O["d1_sample_n"] = sql(
    "SELECT listing_id, price, dom FROM listings ORDER BY md5(CAST(listing_id AS VARCHAR) || '|22'), listing_id LIMIT 1000"
)
O["d2_split_train_valid_test"] = sql("SELECT listing_id, dom, split FROM splits", SPLITS)
O["d3_split_train_test"] = sql(
    f"SELECT listing_id, CASE WHEN CAST({UNIFORM} AS DOUBLE) < 0.7 THEN 'train' ELSE 'test' END AS split FROM listings"
)
O["d4_kfold"] = sql(
    f"SELECT listing_id, CAST({bucket('listing_id', SPLIT_SEED)} % 5 AS INTEGER) AS fold FROM listings"
)

KEYLESS = "keyless AS (SELECT * EXCLUDE (listing_id, published_at, price, dom) FROM listings)"
O["e1_distinct_rows"] = sql("SELECT DISTINCT * FROM keyless", KEYLESS)
O["e2_group_frequency"] = sql(
    "SELECT city_name, count(published_at) AS city_freq FROM (SELECT DISTINCT * FROM listings) GROUP BY city_name"
)
O["e3_group_monetary"] = sql(
    "SELECT city_name, CAST(2 * sum(price) AS BIGINT) AS city_monetary FROM listings GROUP BY city_name"
)
O["e4_group_last_seen"] = sql(
    "SELECT city_name, max(published_at) AS last_published_at FROM listings GROUP BY city_name"
)
O["e5_value_counts"] = sql("SELECT country_name, count(*) AS n FROM listings GROUP BY country_name")
ROW_KEYS = "area, city_name, type_group_id, " + ", ".join(BOOL_COLUMNS)
O["e6_row_value_counts"] = sql(
    f"SELECT {ROW_KEYS}, 2 * count(*) AS n FROM keyless GROUP BY ALL", KEYLESS
)
O["e7_columnwise_max"] = sql(
    "SELECT "
    + ", ".join(f"bool_or({c}) AS {c}" if c in BOOL_COLUMNS else f"max({c}) AS {c}" for c in TRAIN_COLUMNS)
    + " FROM listings WHERE year_published = 2000"
)
O["e8_median_by_weekday_city"] = sql(
    "SELECT CAST(isodow(published_at) - 1 AS INTEGER) AS weekday, city_name, median(dom) AS median_dom FROM listings GROUP BY 1, 2"
)
O["e9_quantile"] = sql(
    "SELECT CAST(0.95 AS DOUBLE) AS q, round(quantile_cont(price, 0.95), 6) AS value FROM listings"
)
O["e10_quantile_list"] = sql(
    "\nUNION ALL ".join(
        f"SELECT CAST({q} AS DOUBLE) AS q, round(quantile_cont(diff, {q}), 6) AS value FROM intervals"
        for q in MISS_QUANTILES
    ),
    SPLITS, BASELINE,
)
O["e11_median_scalar"] = sql(
    "SELECT round(median(diff), 6) AS median_miss FROM intervals", SPLITS, BASELINE
)
O["e12_profile_table"] = sql(
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CASE any_value(typeof({c})) WHEN 'INTEGER' THEN 'int' WHEN 'BIGINT' THEN 'bigint' "
        f"WHEN 'BOOLEAN' THEN 'boolean' WHEN 'VARCHAR' THEN 'string' ELSE 'timestamp_ntz' END AS type, count({c}) AS non_null, count(*) AS total FROM listings"
        for c in TRAIN_COLUMNS
    )
)
O["e13_histogram"] = sql(
    """SELECT CAST(b AS INTEGER) AS bin, round(lo + b * w, 6) AS lo, round(lo + (b + 1) * w, 6) AS hi, coalesce(n, 0) AS n
FROM range(60) t(b) CROSS JOIN ends LEFT JOIN counted ON b = k""",
    "ends AS (SELECT CAST(min(dom) AS DOUBLE) AS lo, (CAST(max(dom) AS DOUBLE) - min(dom)) / 60 AS w FROM listings)",
    "counted AS (SELECT least(59, CAST(floor((dom - lo) / w) AS INTEGER)) AS k, count(*) AS n FROM listings CROSS JOIN ends GROUP BY 1)",
)
O["f1_recency_days"] = sql("SELECT city_name, recency FROM rfm_rec", rfm("listings", "city_name"))
O["f2_average_rank"] = sql(
    "SELECT listing_id, dom, CAST(rank() OVER (ORDER BY dom DESC) + (count(*) OVER (PARTITION BY dom) - 1) / 2.0 AS DOUBLE) AS dom_rank FROM listings"
)
O["f3_normalise_rank"] = sql(f"SELECT city_name, {SCORES} FROM rfm", rfm("listings", "city_name"))
Z = """
groups AS (SELECT year_published, quarter_published, avg(dom) AS mean, stddev_pop(dom) AS sd FROM {source}
  WHERE (year_published, quarter_published) IN ({quarters}) GROUP BY 1, 2)"""
O["f4_zscore_by_quarter"] = sql(
    "SELECT listing_id, year_published, quarter_published, round((dom - mean) / nullif(sd, 0), 6) AS dom_z "
    "FROM listings JOIN groups USING (year_published, quarter_published)",
    Z.format(source="listings", quarters=QUARTERS),
)


def cuts(source: str) -> str:
    return "cuts AS (SELECT " + ", ".join(
        f"quantile_cont({c}, [0, .25, .5, .75, 1]) AS {c}_q" for c in ("price", "dom", "area")
    ) + f" FROM {source})"


def bins() -> str:
    out = []
    for c in ("price", "dom", "area"):
        index = f"(CASE WHEN {c} <= {c}_q[2] THEN 0 WHEN {c} <= {c}_q[3] THEN 1 WHEN {c} <= {c}_q[4] THEN 2 ELSE 3 END)"
        out += [
            f"CAST({index} AS INTEGER) AS {c}_bin",
            f"CAST({c}_q[{index} + 1] AS DOUBLE) AS {c}_lo",
            f"CAST({c}_q[{index} + 2] AS DOUBLE) AS {c}_hi",
            f"'(' || CAST(round(round(CAST({c}_q[{index} + 1] AS DOUBLE), 3) - CASE WHEN {index} = 0 THEN 0.001::DOUBLE ELSE 0 END, 3) AS VARCHAR) "
            f"|| ', ' || CAST(round(CAST({c}_q[{index} + 2] AS DOUBLE), 3) AS VARCHAR) || ']' AS {c}_label",
        ]
    return ", ".join(out)


O["f5_quartile_bins"] = sql(f"SELECT listing_id, {bins()} FROM listings CROSS JOIN cuts", cuts("listings"))
O["g1_inner_join_rfm_parts"] = sql(
    "SELECT type_group_id, recency, frequency, monetary FROM rfm_rec", rfm("listings", "type_group_id")
)
O["g2_left_join_features"] = sql(
    "SELECT listing_id, city_name, CAST(freq AS DOUBLE) AS freq, round(M_rank_norm, 6) AS M_rank_norm FROM listings LEFT JOIN rfm USING (city_name)",
    "known AS (SELECT * FROM listings WHERE country_name <> 'PT')", rfm("known", "city_name"),
)
O["g3_attach_predictions"] = sql(
    f"""SELECT s.listing_id, {', '.join(TR_V2)}, country_name, city_name, published_at, dom AS true_dom,
       {rounds('lower_bound', 'upper_bound', 'interval_length')}, CAST(CAST(within_interval AS INTEGER) AS DOUBLE) AS within_interval, {rounds('diff')}
FROM splits s LEFT JOIN (SELECT * EXCLUDE (true_dom) FROM intervals WHERE within_interval) i ON s.listing_id = i.listing_id
WHERE split = 'test'""",
    SPLITS, BASELINE,
)
O["g4_onehot_attach"] = sql(
    f"SELECT listing_id, country_name, {onehot('country_name', COUNTRIES)} FROM listings WHERE area > 40"
)
Y1, Q1 = DATA_QUARTERS[1]
O["g5_union_all"] = sql(
    f"""SELECT listing_id, dom, year_published, quarter_published FROM listings WHERE year_published = {Y0} AND quarter_published = {Q0}
UNION ALL SELECT listing_id, dom, year_published, quarter_published FROM listings WHERE year_published = {Y1} AND quarter_published = {Q1}"""
)
for _name, _column in (
    ("h1_r2", "r2"), ("h2_mae", "mae"), ("h3_rmse", "rmse"), ("h4_median_ae", "median_ae"),
    ("h14_adjusted_r2", "adjusted_r2"),
):
    O[_name] = sql(f"SELECT split, {rounds(_column)} FROM report_adjusted", SPLITS, BASELINE, REPORT)
O["h13_mape"] = sql(
    f"SELECT split, printf('%.5e', avg(abs(prediction - dom) / greatest(abs(dom), {EPSILON}))) AS mape FROM predicted GROUP BY split",
    SPLITS, BASELINE,
)
O["h5_interval_length"] = sql(f"SELECT listing_id, {rounds('interval_length')} FROM intervals", SPLITS, BASELINE)
O["h6_within_interval"] = sql("SELECT listing_id, within_interval FROM intervals", SPLITS, BASELINE)
O["h7_interval_miss"] = sql(f"SELECT listing_id, {rounds('diff')} FROM intervals", SPLITS, BASELINE)
O["h8_metrics_by_split"] = sql(
    f"SELECT split, n, {rounds('r2', 'mae', 'mse', 'rmse', 'median_ae', 'adjusted_r2', digits=5)}, "
    "printf('%.5e', mape) AS mape FROM report_adjusted",
    SPLITS, BASELINE, REPORT,
)
O["h9_interval_coverage"] = sql(
    """SELECT count(*) AS n, count(*) FILTER (WHERE within_interval) AS inside,
       round(avg(CAST(within_interval AS INTEGER)), 6) AS coverage, round(avg(interval_length), 6) AS mean_length,
       round(median(diff), 6) AS median_miss FROM intervals""",
    SPLITS, BASELINE,
)
O["h11_residual_table"] = sql(
    "SELECT split, dom AS y, round(prediction, 6) AS prediction, round(prediction - dom, 6) AS residual FROM predicted",
    SPLITS, BASELINE,
)
RFM_OUT = "recency, freq, monetary, " + SCORES
O["i1_rfm_city"] = sql(f"SELECT city_name, {RFM_OUT} FROM rfm", trimmed("listings"), rfm("trimmed", "city_name"))
O["i1_rfm_city_monetary_from_frequency"] = sql(
    f"SELECT city_name, {RFM_OUT} FROM rfm", trimmed("listings"), rfm("trimmed", "city_name", monetary="f")
)
O["i2_rfm_type_group"] = sql(
    "SELECT type_group_id, recency AS type_group_recency, freq AS type_group_freq, monetary AS type_group_monetary, "
    + ", ".join(f"round({c}, 6) AS {c}_type_group" for c in RFM_COLUMNS) + " FROM rfm",
    trimmed("listings"), rfm("trimmed", "type_group_id"),
)
O["i3_onehot_month"] = sql(f"SELECT listing_id, {MONTH} AS y_m, {onehot(MONTH, DATA_MONTHS)} FROM listings")
O["i4_onehot_country"] = sql(f"SELECT listing_id, country_name, {onehot('country_name', COUNTRIES)} FROM listings")
O["i5_fit_categories"] = sql(f"SELECT DISTINCT {MONTH} AS y_m FROM listings ORDER BY 1")
O["i6_features_eur_v2"] = sql(
    f"SELECT listing_id, dom, {', '.join(TR_V2)}, {onehot('country_name', COUNTRIES)} FROM trimmed", trimmed("listings")
)
O["i6_features_tr_v2"] = sql(f"SELECT listing_id, dom, {', '.join(TR_V2)} FROM trimmed", trimmed("listings"))
V1 = "price, price_change_count, area, type_group_id, " + ", ".join(BOOL_COLUMNS) + ", " + SCORES + ", " + onehot(MONTH, DATA_MONTHS)
O["i7_features_v1"] = sql(
    f"SELECT listing_id, dom, {V1} FROM trimmed LEFT JOIN rfm USING (city_name)",
    trimmed("listings"), rfm("trimmed", "city_name"),
)
O["i7_features_v1_eur_search"] = sql(
    f"SELECT listing_id, dom, contact_type_id, {V1} FROM listings LEFT JOIN rfm USING (city_name)",
    rfm("listings", "city_name", monetary="f"),
)
O["i7_features_v1_fit_apply"] = sql(
    f"SELECT listing_id, {V1} FROM splits LEFT JOIN rfm USING (city_name) WHERE split = 'test'",
    SPLITS, TRAIN, trimmed("train"), rfm("trimmed", "city_name"),
)
O["i8_subpopulation_frame"] = sql(
    f"""SELECT listing_id, CASE country_name WHEN 'SP' THEN 'ES' ELSE country_name END AS country_name, {bins()},
       round((dom - mean) / nullif(sd, 0), 6) AS dom_z
FROM sample CROSS JOIN cuts JOIN groups USING (year_published, quarter_published)""",
    "sample AS (SELECT * FROM listings ORDER BY md5(CAST(listing_id AS VARCHAR) || '|22'), listing_id LIMIT (SELECT count(*) // 2 FROM listings))",
    cuts("sample"), Z.format(source="sample", quarters=QUARTERS),
)
O["k6_plot_interval_frame"] = sql(
    f"""SELECT CAST(row_number() OVER (ORDER BY listing_id) - 1 AS INTEGER) AS index, listing_id, true_dom,
       {rounds('lower_bound', 'upper_bound')} FROM intervals ORDER BY listing_id LIMIT 100""",
    SPLITS, BASELINE,
)


def logcosh(error: str, alpha: float) -> tuple[str, str]:
    arg = f"(CASE WHEN {error} < 0 THEN {error} * {alpha} ELSE {error} * (1.0 - {alpha}) END)"
    safe = f"greatest(-350.0, least(350.0, {arg}))"
    return f"round(tanh({arg}), 9)", f"round(1 / (cosh({safe}) * cosh({safe})), 9)"


_G, _H = logcosh("(prediction - dom)", 0.95)
_G2, _H2 = logcosh("(-(area / CAST(50 AS DOUBLE)))", 0.05)
O["j1_logcosh_grad_hess"] = sql(
    f"SELECT listing_id, {_G} AS grad, {_H} AS hess, {_G2} AS low_grad, {_H2} AS low_hess FROM predicted",
    SPLITS, BASELINE,
)
