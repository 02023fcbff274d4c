"""Registered queries, one or more per operator; the key starts with the operator id."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellspan.functions.casts import cast_listing
from dwellspan.functions.columns import (
    case_when, interval_cols, interval_length, interval_miss, logcosh_quantile, onehot, recode,
    weekday, with_year_month, within_interval,
)
from dwellspan.learning.vectors import assemble
from dwellspan.operators import evaluate, ordered, rfm, sampling, stats, trim
from dwellspan.operators.features import (
    attach, build_features, fit_categories, fit_features, select_features, subpopulations,
)
from dwellspan.plans.data import (
    DATA_MONTHS, DATA_QUARTERS, FRACTIONS, SPLIT_SEED, baseline_intervals, baseline_predictions, splits, staged_splits,
)
from dwellspan.plans.flagship import top_cities
from dwellspan.schema import BOOL_COLUMNS, COUNTRIES, INT_COLUMNS, LONG_COLUMNS, TR_V2
from dwellspan.session import new_path
from dwellspan.sources import sinks
from dwellspan.sources.listings import listings_view, read_listings, read_listings_csv, staged_listings

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c, kind in df.dtypes if kind == "double"})


QUERIES["flagship_top_cities"] = top_cities

# ---- sources and sinks -------------------------------------------------------------------------


@query("a1_scan_listings_train")
def _(spark, d):
    path = new_path(spark, "listings")
    listings_view(spark, d).write.parquet(path)
    return read_listings(spark, path)


@query("a2_scan_listings_score")
def _(spark, d):
    path = new_path(spark, "listings")
    listings_view(spark, d).write.parquet(path)
    return read_listings(spark, path, with_target=False)


@query("a3_scan_csv")
def _(spark, d):
    path = new_path(spark, "csv")
    sinks.write_csv(listings_view(spark, d), path)
    return read_listings_csv(spark, path)


@query("a4_sink_csv")
def _(spark, d):
    path = new_path(spark, "csv")
    sinks.write_csv(baseline_intervals(spark, d), path)
    schema = "listing_id bigint, lower_bound double, true_dom int, upper_bound double, " \
        "interval_length double, within_interval boolean, diff double"
    return rounded(read_listings_csv(spark, path, schema))


@query("a5_sink_predictions")
def _(spark, d):
    path = new_path(spark, "predictions")
    rows = baseline_predictions(spark, d)
    even, odd = (F.col("listing_id") % 2 == i for i in (0, 1))
    sinks.write_predictions(rows.where(even), path, "even")
    sinks.write_predictions(rows.where(odd), path, "odd")
    sinks.write_predictions(rows.where(odd), path, "odd")  # a retry adds nothing
    return sinks.read_predictions(spark, path).select("listing_id", "dom_predictions", "batch_id")


@query("a6_sink_model_log")
def _(spark, d):
    path = new_path(spark, "ml_logs")
    test = baseline_predictions(spark, d).where(F.col("split") == "test")
    report = evaluate.regression_report(test, features=1).first().asDict()
    meta = {**report, "model_name": "group_mean_v1", "model_type": "GroupMean", "train_time": 0.0}
    sinks.log_run(spark, meta, path)
    return spark.read.parquet(path).drop("train_time", "created_at")


# ---- casts, projections, scalar functions ------------------------------------------------------


def _as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


@query("b1_cast_ints")
def _(spark, d):
    raw = _as_text(listings_view(spark, d))
    return cast_listing(raw).select("listing_id", *INT_COLUMNS, *LONG_COLUMNS, "dom")


@query("b1_cast_ints_truncating")
def _(spark, d):
    raw = listings_view(spark, d).select(
        "listing_id", (F.col("price") / 7.0).alias("price"), (F.col("area") / -3.0).alias("area")
    )
    return cast_listing(raw)


@query("b2_cast_bools")
def _(spark, d):
    raw = _as_text(listings_view(spark, d).select("listing_id", *BOOL_COLUMNS))
    return cast_listing(raw)


@query("b2_cast_bools_truthiness")
def _(spark, d):
    raw = listings_view(spark, d).select(
        "listing_id",
        F.col("has_lift").cast("string").alias("has_lift"),
        (F.col("area") % 3).alias("has_parking_space"),
        F.when(F.col("area") % 2 == 0, "").otherwise("no").alias("has_swimming_pool"),
    )
    return cast_listing(raw, pandas_truthiness=True)


@query("b3_parse_published_at")
def _(spark, d):
    raw = _as_text(listings_view(spark, d).select("listing_id", "published_at"))
    return cast_listing(raw)


@query("b4_year_month")
def _(spark, d):
    return with_year_month(listings_view(spark, d)).select("listing_id", "y_m")


@query("b5_weekday")
def _(spark, d):
    return listings_view(spark, d).select("listing_id", weekday("published_at").alias("weekday"))


@query("b6_select_features")
def _(spark, d):
    return select_features(listings_view(spark, d), "TR_V2", keep=["listing_id", "dom"])


@query("b7_drop_rename_reorder")
def _(spark, d):
    df = listings_view(spark, d).drop("price_currency", "published_at")
    df = df.withColumnsRenamed({"city_name": "city", "country_name": "country"})
    return df.select(*[c for c in df.columns if c != "dom"], "dom")


@query("b8_recode_country")
def _(spark, d):
    df = listings_view(spark, d).select("listing_id", "country_name")
    return recode(df, "country_name", {"SP": "ES"})


@query("b9_case_when")
def _(spark, d):
    area = F.col("area")
    size = case_when([(area < 50, F.lit(1)), (area < 120, F.lit(2)), (area < 200, F.lit(3))], F.lit(0))
    return listings_view(spark, d).select("listing_id", size.alias("size_class"))


@query("b10_round_metrics")
def _(spark, d):
    rows = baseline_predictions(spark, d)
    return evaluate.regression_report(rows, digits=3).select("split", "mae", "rmse", "median_ae")


@query("b11_assemble_features")
def _(spark, d):
    vectors = assemble(listings_view(spark, d), TR_V2).withColumn("v", vector_to_array("features"))
    return vectors.select("listing_id", *[F.col("v")[i].alias(f"v{i}") for i in range(len(TR_V2))])


# ---- filters -----------------------------------------------------------------------------------


@query("c1_trim_outliers")
def _(spark, d):
    return trim.trim_outliers(staged_listings(spark, d)).select("listing_id", "area", "price")


@query("c2_fit_trim")
def _(spark, d):
    train = staged_splits(spark, d).where(F.col("split") == "train")
    return trim.fit_trim(train).select("step", "column", F.round("threshold", 6).alias("threshold"))


@query("c2_apply_trim")
def _(spark, d):
    rows = staged_splits(spark, d)
    thresholds = trim.fit_trim(rows.where(F.col("split") == "train"))
    return trim.apply_trim(rows.where(F.col("split") != "train"), thresholds).select("listing_id", "split")


@query("c3_filter_year_quarter")
def _(spark, d):
    year, quarter = DATA_QUARTERS[0]
    return listings_view(spark, d).where(
        (F.col("year_published") == year) & (F.col("quarter_published") == quarter)
    )


@query("c4_filter_year")
def _(spark, d):
    return listings_view(spark, d).where(F.col("year_published") == 2000).select("listing_id", "month_published")


@query("c5_filter_in_interval")
def _(spark, d):
    return rounded(baseline_intervals(spark, d).where(within_interval()).drop("within_interval"))


@query("c6_head_slice")
def _(spark, d):
    return sampling.head_by(listings_view(spark, d), ["listing_id"], 15000).select("listing_id", "price")


# ---- samples and splits ------------------------------------------------------------------------


@query("d1_sample_n")
def _(spark, d):
    return sampling.sample_n(staged_listings(spark, d), 1000, 22).select("listing_id", "price", "dom")


@query("d2_split_train_valid_test")
def _(spark, d):
    return splits(spark, d).select("listing_id", "dom", "split")


@query("d3_split_train_test")
def _(spark, d):
    return sampling.split2(listings_view(spark, d), 0.3, 50).select("listing_id", "split")


@query("d4_kfold")
def _(spark, d):
    return sampling.with_fold(listings_view(spark, d), 5, SPLIT_SEED).select("listing_id", "fold")


# ---- aggregates --------------------------------------------------------------------------------


def _doubled(spark, d):
    """Listings without their key, each twice: rows that the deduplication has to merge."""
    df = listings_view(spark, d).drop("listing_id", "published_at", "price", "dom")
    return df.unionByName(df)


@query("e1_distinct_rows")
def _(spark, d):
    return _doubled(spark, d).distinct()


@query("e2_group_frequency")
def _(spark, d):
    df = listings_view(spark, d)
    parts = rfm.rfm_parts(df.unionByName(df), "city_name")
    return parts.select("city_name", F.col("frequency").alias("city_freq"))


@query("e3_group_monetary")
def _(spark, d):
    df = listings_view(spark, d)
    parts = rfm.rfm_parts(df.unionByName(df), "city_name")
    return parts.select("city_name", F.col("monetary").cast("bigint").alias("city_monetary"))


@query("e4_group_last_seen")
def _(spark, d):
    parts = rfm.rfm_parts(listings_view(spark, d), "city_name")
    return parts.select("city_name", F.col("last_seen").alias("last_published_at"))


@query("e5_value_counts")
def _(spark, d):
    return stats.value_counts(listings_view(spark, d), "country_name")


@query("e6_row_value_counts")
def _(spark, d):
    return stats.value_counts(_doubled(spark, d), "area", "city_name", "type_group_id", *BOOL_COLUMNS)


@query("e7_columnwise_max")
def _(spark, d):
    return stats.column_max(listings_view(spark, d).where(F.col("year_published") == 2000))


@query("e8_median_by_weekday_city")
def _(spark, d):
    df = listings_view(spark, d).withColumn("weekday", weekday("published_at"))
    return ordered.median_by(df, ["weekday", "city_name"], "dom")


@query("e9_quantile")
def _(spark, d):
    return rounded(ordered.quantiles(listings_view(spark, d), "price", [0.95]))


@query("e10_quantile_list")
def _(spark, d):
    return rounded(evaluate.miss_quantiles(baseline_intervals(spark, d)))


@query("e11_median_scalar")
def _(spark, d):
    found = ordered.quantiles(baseline_intervals(spark, d), "diff", [0.5])
    return rounded(found.select(F.col("value").alias("median_miss")))


@query("e12_profile_table")
def _(spark, d):
    return stats.profile(listings_view(spark, d)).select("column", "type", "non_null", "total")


@query("e13_histogram")
def _(spark, d):
    return rounded(ordered.histogram(staged_listings(spark, d), "dom", 60))


# ---- ranks, bins, z-scores ---------------------------------------------------------------------


@query("f1_recency_days")
def _(spark, d):
    parts = rfm.with_recency(rfm.rfm_parts(listings_view(spark, d), "city_name"))
    return parts.select("city_name", "recency")


@query("f2_average_rank")
def _(spark, d):
    df = listings_view(spark, d).select("listing_id", "dom")
    return ordered.avg_rank(df, "dom", ascending=False, name="dom_rank")


@query("f3_normalise_rank")
def _(spark, d):
    scores = rfm.rfm(staged_listings(spark, d), "city_name")
    return rounded(scores.select("city_name", "R_rank_norm", "F_rank_norm", "M_rank_norm"))


@query("f4_zscore_by_quarter")
def _(spark, d):
    df = stats.zscore_by(
        listings_view(spark, d), ["year_published", "quarter_published"], "dom", DATA_QUARTERS
    )
    return rounded(df.select("listing_id", "year_published", "quarter_published", "dom_z"))


@query("f5_quartile_bins")
def _(spark, d):
    df = ordered.qcut(staged_listings(spark, d), ["price", "dom", "area"])
    return df.select("listing_id", *[f"{c}_{p}" for c in ("price", "dom", "area") for p in ("bin", "lo", "hi", "label")])


# ---- joins and unions --------------------------------------------------------------------------


@query("g1_inner_join_rfm_parts")
def _(spark, d):
    parts = rfm.with_recency(rfm.rfm_parts(listings_view(spark, d), "type_group_id"))
    return parts.select("type_group_id", "recency", "frequency", F.col("monetary").cast("bigint").alias("monetary"))


@query("g2_left_join_features")
def _(spark, d):
    df = staged_listings(spark, d)
    known = rfm.rfm(df.where(F.col("country_name") != "PT"), "city_name")
    joined = rfm.add_rfm(df.select("listing_id", "city_name"), known, "city_name")
    return rounded(joined.select("listing_id", "city_name", F.col("freq").cast("double").alias("freq"), "M_rank_norm"))


@query("g3_attach_predictions")
def _(spark, d):
    rows = splits(spark, d).where(F.col("split") == "test").withColumnRenamed("dom", "true_dom")
    intervals = baseline_intervals(spark, d).where(F.col("within_interval"))
    columns = [*TR_V2, "country_name", "city_name", "published_at", "true_dom"]
    joined = attach(rows.select("listing_id", *columns), intervals.drop("true_dom"))
    return rounded(joined.withColumn("within_interval", F.col("within_interval").cast("double")))


@query("g4_onehot_attach")
def _(spark, d):
    kept = listings_view(spark, d).where(F.col("area") > 40)
    return onehot(kept, "country_name", COUNTRIES).select("listing_id", "country_name", *COUNTRIES)


@query("g5_union_all")
def _(spark, d):
    df = listings_view(spark, d).select("listing_id", "dom", "year_published", "quarter_published")
    first, second = (
        df.where((F.col("year_published") == y) & (F.col("quarter_published") == q)) for y, q in DATA_QUARTERS[:2]
    )
    return first.unionByName(second)


# ---- evaluation --------------------------------------------------------------------------------


def _metric(name: str, column: str):
    @query(name)
    def _(spark, d):
        report = evaluate.regression_report(baseline_predictions(spark, d), digits=None, features=9)
        return rounded(report.select("split", column))


_metric("h1_r2", "r2")
_metric("h2_mae", "mae")
_metric("h3_rmse", "rmse")
_metric("h4_median_ae", "median_ae")
_metric("h14_adjusted_r2", "adjusted_r2")


def _significant(name: str) -> Column:
    """Six digits from the first one that counts: a label of 0 makes the percentage error huge."""
    return F.format_string("%.5e", F.col(name)).alias(name)


@query("h13_mape")
def _(spark, d):
    report = evaluate.regression_report(baseline_predictions(spark, d), digits=None)
    return report.select("split", _significant("mape"))


@query("h5_interval_length")
def _(spark, d):
    rows = baseline_intervals(spark, d).drop("interval_length")
    return rounded(rows.select("listing_id", interval_length().alias("interval_length")))


@query("h6_within_interval")
def _(spark, d):
    rows = baseline_intervals(spark, d).drop("within_interval")
    return rows.select("listing_id", within_interval().alias("within_interval"))


@query("h7_interval_miss")
def _(spark, d):
    rows = baseline_intervals(spark, d).drop("diff")
    return rounded(rows.select("listing_id", interval_miss().alias("diff")))


@query("h8_metrics_by_split")
def _(spark, d):
    report = evaluate.regression_report(baseline_predictions(spark, d), features=9)
    return report.select("split", "n", "r2", "mae", "mse", "rmse", "median_ae", "adjusted_r2", _significant("mape"))


@query("h9_interval_coverage")
def _(spark, d):
    return rounded(evaluate.interval_report(baseline_intervals(spark, d)))


@query("h11_residual_table")
def _(spark, d):
    rows = evaluate.residuals(baseline_predictions(spark, d))
    return rounded(rows.select("split", "y", "prediction", "residual"))


# ---- composite features ------------------------------------------------------------------------


def _trimmed_rfm(spark, d, key, **options):
    return rounded(rfm.rfm(trim.trim_outliers(staged_listings(spark, d)), key, **options))


@query("i1_rfm_city")
def _(spark, d):
    return _trimmed_rfm(spark, d, "city_name")


@query("i1_rfm_city_monetary_from_frequency")
def _(spark, d):
    return _trimmed_rfm(spark, d, "city_name", monetary_from="frequency")


@query("i2_rfm_type_group")
def _(spark, d):
    return _trimmed_rfm(spark, d, "type_group_id", suffix="_type_group", prefix="type_group_")


@query("i3_onehot_month")
def _(spark, d):
    df = with_year_month(listings_view(spark, d)).select("listing_id", "y_m")
    return onehot(df, "y_m", DATA_MONTHS)


@query("i4_onehot_country")
def _(spark, d):
    return onehot(listings_view(spark, d).select("listing_id", "country_name"), "country_name", COUNTRIES)


@query("i5_fit_categories")
def _(spark, d):
    return fit_categories(with_year_month(listings_view(spark, d)), "y_m")


@query("i6_features_eur_v2")
def _(spark, d):
    return build_features(staged_listings(spark, d), "EUR_V2")


@query("i6_features_tr_v2")
def _(spark, d):
    return build_features(staged_listings(spark, d), "TR_V2")


@query("i7_features_v1")
def _(spark, d):
    return rounded(build_features(staged_listings(spark, d), "V1", months=DATA_MONTHS))


@query("i7_features_v1_eur_search")
def _(spark, d):
    df = build_features(
        staged_listings(spark, d), "V1_EUR_SEARCH", trim=False, months=DATA_MONTHS, monetary_from="frequency"
    )
    return rounded(df)


@query("i7_features_v1_fit_apply")
def _(spark, d):
    rows = staged_splits(spark, d)
    model = fit_features(rows.where(F.col("split") == "train").drop("split"), "V1", months=DATA_MONTHS)
    return rounded(model.transform(rows.where(F.col("split") == "test").drop("split", "dom")))


@query("i8_subpopulation_frame")
def _(spark, d):
    rows = staged_listings(spark, d)
    df = subpopulations(rows, rows.count() // 2, 22, DATA_QUARTERS)  # half of the listings, as published
    bins = [f"{c}_{p}" for c in ("price", "dom", "area") for p in ("bin", "lo", "hi", "label")]
    return rounded(df.select("listing_id", "country_name", *bins, "dom_z"))


@query("k6_plot_interval_frame")
def _(spark, d):
    return rounded(evaluate.interval_frame(baseline_intervals(spark, d), 100))


# ---- objective ---------------------------------------------------------------------------------


@query("j1_logcosh_grad_hess")
def _(spark, d):
    grad, hess = logcosh_quantile(F.col("dom").cast("double"), F.col("prediction"), 0.95)
    low_grad, low_hess = logcosh_quantile(F.col("dom").cast("double"), F.col("dom") - F.col("area") / 50.0, 0.05)
    return rounded(
        baseline_predictions(spark, d).select(
            "listing_id", grad.alias("grad"), hess.alias("hess"), low_grad.alias("low_grad"), low_hess.alias("low_hess")
        ),
        9,
    )
