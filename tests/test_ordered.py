import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from dwellspan.operators import ordered, stats
from dwellspan.operators.trim import apply_trim, fit_trim, trim_outliers


def test_tied_values_share_their_mean_rank(spark):
    df = spark.createDataFrame([(x,) for x in (1, 2, 2, 9, 4)], "x int")
    got = {r["x"]: r["rank"] for r in ordered.avg_rank(df, "x").collect()}
    assert got == {1: 1.0, 2: 2.5, 9: 5.0, 4: 4.0}
    down = {r["x"]: r["rank"] for r in ordered.avg_rank(df, "x", ascending=False).collect()}
    assert down == {1: 5.0, 2: 3.5, 9: 1.0, 4: 2.0}


def test_null_has_no_rank(spark):
    df = spark.createDataFrame([(1,), (None,)], "x int")
    assert {r["x"]: r["rank"] for r in ordered.avg_rank(df, "x").collect()} == {1: 1.0, None: None}


def test_interpolated_quantile(spark):
    df = spark.createDataFrame([(x,) for x in (1, 2, 2, 9, 4, None)], "x int")
    assert ordered.quantile(df, "x", 0.95) == pytest.approx(8.0)
    assert ordered.quantile(df.limit(0), "x", 0.95) is None


@pytest.mark.parametrize("window_rows", [10**6, 0])
def test_grouped_quantiles_equal_pandas_on_both_paths(spark, window_rows):
    rng = np.random.default_rng(1)
    # one group holds most rows, one value most rows of it
    pdf = pd.DataFrame({"k": rng.choice(list("aaaab"), 4000), "x": rng.integers(0, 900, 4000)})
    pdf.loc[pdf.index % 3 == 0, "x"] = 77
    qs = [0.0, 0.05, 0.5, 0.95, 1.0]
    got = ordered.quantiles(spark.createDataFrame(pdf), "x", qs, ["k"], window_rows=window_rows)
    want = pdf.groupby("k")["x"].quantile(qs)
    for row in got.collect():
        assert row["value"] == pytest.approx(want[(row["k"], row["q"])])


@pytest.mark.parametrize("by", [[], ["k"]])
def test_bracketing_changes_no_quantile(spark, by):
    rng = np.random.default_rng(2)
    n = 150_000
    pdf = pd.DataFrame({"k": rng.choice(list("aab"), n), "x": np.round(rng.lognormal(3, 2, n), 4)})
    df = spark.createDataFrame(pdf)
    qs = [0.05, 0.5, 0.501, 0.95]
    narrow = ordered._narrowed(df.select(*by, "x"), "x", qs, by, 0)
    assert narrow.select(*by, "x").distinct().count() < 0.05 * n
    got = ordered.quantiles(df, "x", qs, by, bracket_rows=0).collect()
    want = pdf.groupby("k")["x"].quantile(qs) if by else pdf["x"].quantile(qs)
    assert len(got) == len(qs) * (2 if by else 1)
    for row in got:
        assert row["value"] == pytest.approx(want[(row["k"], row["q"])] if by else want[row["q"]])


def _pandas_trim(pdf):
    for column, q, op in (("area", 0.95, "<"), ("area", 0.05, ">"), ("price", 0.95, "<"), ("price", 0.05, ">")):
        t = pdf[column].quantile(q)
        pdf = pdf[pdf[column] < t] if op == "<" else pdf[pdf[column] > t]
    return pdf


@pytest.mark.parametrize("window_rows", [10**6, 0])
@pytest.mark.parametrize("high", [5, 60, 100_000])
def test_trim_is_sequential(spark, window_rows, high):
    rng = np.random.default_rng(high)
    pdf = pd.DataFrame(
        {"listing_id": range(3000), "area": rng.integers(0, high, 3000), "price": rng.integers(0, high * 7, 3000)}
    )
    df = spark.createDataFrame(pdf)
    got = apply_trim(df, fit_trim(df, window_rows=window_rows))
    assert sorted(r["listing_id"] for r in got.collect()) == sorted(_pandas_trim(pdf)["listing_id"])


def test_trim_drops_nulls_and_survives_an_empty_table(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 6), (4, 7)], "area int, price int")
    assert trim_outliers(df).where(F.col("price").isNull()).count() == 0
    assert trim_outliers(df.limit(0)).count() == 0


def test_thresholds_reach_the_scan(spark, listings):
    from dwellspan.operators.features import build_features

    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    for df in (trim_outliers(listings), build_features(listings.drop("split"), "EUR_V2")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        pushed = plan[plan.index("PushedFilters") :]
        assert all(f"{way}({column}" in pushed for way in ("LessThan", "GreaterThan") for column in ("area", "price"))


def test_quartile_labels(spark):
    df = spark.createDataFrame([(x,) for x in (10, 20, 35, 47, 50, 61, 79)], "x int")
    rows = ordered.qcut(df, ["x"]).orderBy("x").collect()
    labels = pd.qcut(pd.Series([10, 20, 35, 47, 50, 61, 79]), 4).astype(str).tolist()
    assert [r["x_label"] for r in rows] == labels
    assert [r["x_bin"] for r in rows] == [0, 0, 1, 1, 2, 3, 3]


def test_equal_edges_are_an_error(spark):
    df = spark.createDataFrame([(x,) for x in (1, 1, 1, 1, 1, 5)], "x int")
    with pytest.raises(ValueError, match="unique"):
        ordered.qcut(df, ["x"])


def test_histogram_closes_the_last_bin_and_keeps_empty_bins(spark):
    df = spark.createDataFrame([(0,), (1,), (10,), (None,)], "x int")
    rows = ordered.histogram(df, "x", 5).orderBy("bin").collect()
    assert [r["n"] for r in rows] == [2, 0, 0, 0, 1]
    assert rows[-1]["hi"] == 10.0


def test_zscore_of_a_single_row_is_null_and_other_groups_are_dropped(spark):
    df = spark.createDataFrame([(2020, 3, 5), (2020, 4, 1), (2020, 4, 3), (1999, 1, 9)], "y int, q int, dom int")
    rows = stats.zscore_by(df, ["y", "q"], "dom", [(2020, 3), (2020, 4)]).orderBy("q", "dom").collect()
    assert [r["dom_z"] for r in rows] == [None, -1.0, 1.0]


def test_value_counts_leave_out_nulls(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "c string")
    assert [tuple(r) for r in stats.value_counts(df, "c").collect()] == [("a", 2), ("b", 1)]


@pytest.mark.parametrize(("size", "pivots"), [(1024, 256), (8, 16), (8, 256)])
def test_pivots_are_counted_and_widened(spark, monkeypatch, size, pivots):
    """A sketch of size 8 misses the ranks at first; results stay exact."""
    monkeypatch.setattr(ordered, "SKETCH_K", size)
    monkeypatch.setattr(ordered, "PIVOTS", pivots)
    df = spark.range(5000).selectExpr("id % 3 as k", "cast(pmod(id * 7919, 5000) as double) / 7 as v")
    qs = [0.0, 0.05, 0.5, 0.95, 1.0]
    got = {(r["k"], r["q"]): r["value"] for r in ordered.quantiles(df, "v", qs, ["k"], bracket_rows=0).collect()}
    frame = df.toPandas()
    for k, part in frame.groupby("k"):
        for q in qs:
            assert got[k, q] == pytest.approx(part.v.quantile(q))
    assert ordered.quantiles(df, "v", [0.3], bracket_rows=0).first()["value"] == pytest.approx(frame.v.quantile(0.3))


def test_work_tables_go_with_their_scope(spark):
    import os

    from dwellspan.session import materialise, work, work_folder

    with work(spark):
        before = set(os.listdir(work_folder(spark).removeprefix("file:")))
        assert materialise(spark.range(3), "scoped").count() == 3
        assert len(set(os.listdir(work_folder(spark).removeprefix("file:"))) - before) == 1
    assert set(os.listdir(work_folder(spark).removeprefix("file:"))) <= before


def test_columns_of_few_values_take_no_more_rounds_of_narrowing(spark, monkeypatch):
    """The median of z lies at the border of its two values, so no bracket parts them; each edge is one value of the histogram."""
    rounds = []
    written = ordered.materialise_observed

    def counted(df, label, *args, **metrics):
        rounds.append(label)
        return written(df, label, *args, **metrics)

    monkeypatch.setattr(ordered, "materialise_observed", counted)
    df = spark.range(20_000).selectExpr("inline(array(struct('z' AS k, cast(id % 2 AS double) AS v), struct('y' AS k, cast(id % 7 AS double) AS v)))")
    got = {(r["k"], r["q"]): r["value"] for r in ordered.quantiles(df, "v", [0.25, 0.5, 0.75], ["k"], bracket_rows=1000).collect()}
    assert got == {("z", 0.25): 0.0, ("z", 0.5): 0.5, ("z", 0.75): 1.0, ("y", 0.25): 1.0, ("y", 0.5): 3.0, ("y", 0.75): 5.0}
    assert rounds.count("brackets") == 1
