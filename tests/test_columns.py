import math

import pytest
from pyspark.sql import functions as F

from dwellspan.functions.casts import cast_listing, split_castable
from dwellspan.functions.columns import interval_cols, logcosh_quantile, onehot, recode, weekday, with_year_month


def test_strict_cast_truncates_and_fails_on_bad_values(spark):
    df = spark.createDataFrame([(3.9, -3.9)], "area double, price double")
    assert cast_listing(df).first() == (3, -3)
    for bad in ("abc", None, "3.9"):
        with pytest.raises(Exception, match="area: not castable"):
            cast_listing(spark.createDataFrame([(bad,)], "area string")).collect()


def test_lenient_cast_keeps_bad_rows_aside(spark):
    df = spark.createDataFrame([("1", "2"), ("x", "2"), ("1", None)], "area string, price string")
    good, rejects = split_castable(df)
    assert [tuple(r) for r in good.collect()] == [(1, 2)]
    assert rejects.count() == 2
    assert cast_listing(df, strict_mode=False).where(F.col("area").isNull()).count() == 1


def test_truthiness(spark):
    text = spark.createDataFrame([("False",), ("",), (None,)], "has_lift string")
    number = spark.createDataFrame([(None,), (0,), (2,)], "has_lift int")
    read = lambda df: [r[0] for r in cast_listing(df, pandas_truthiness=True).collect()]
    assert read(text) == [True, False, False]
    assert read(number) == [True, False, True]
    assert [r[0] for r in cast_listing(text.limit(1)).collect()] == [False]


def test_onehot_unknown_and_null_are_zero(spark):
    df = spark.createDataFrame([("IT",), ("XX",), (None,)], "c string")
    rows = onehot(df, "c", ["IT", "PT", "SP"]).select("IT", "PT", "SP").collect()
    assert [tuple(r) for r in rows] == [(1, 0, 0), (0, 0, 0), (0, 0, 0)]


def test_dates_and_recode(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 23:00:00' AS published_at, 'SP' AS country_name")
    row = recode(with_year_month(df), "country_name", {"SP": "ES"}).select("y_m", "country_name", weekday("published_at")).first()
    assert tuple(row) == ("2024-01", "ES", 0)


def test_logcosh_gradient_has_no_chain_factor_and_does_not_overflow(spark):
    df = spark.createDataFrame([(10.0, 8.0), (10.0, 12.0), (0.0, -1e6)], "y double, p double")
    g, h = logcosh_quantile(F.col("y"), F.col("p"), 0.95)
    rows = df.select(g.alias("g"), h.alias("h")).collect()
    assert rows[0]["g"] == pytest.approx(math.tanh(-1.9))
    assert rows[0]["h"] == pytest.approx(1 / math.cosh(1.9) ** 2)
    assert rows[1]["g"] == pytest.approx(math.tanh(0.1), rel=1e-6)
    assert rows[2]["g"] == -1.0 and rows[2]["h"] == 0.0


def test_crossed_bounds_test_the_lower_one_first(spark):
    df = spark.createDataFrame([(10.0, 7, 5.0), (1.0, 3, 5.0), (1.0, 9, 5.0)], "lower_bound double, true_dom int, upper_bound double")
    rows = interval_cols(df).collect()
    assert [r["diff"] for r in rows] == [3.0, 0.0, 4.0]
    assert [r["within_interval"] for r in rows] == [False, True, False]
    assert rows[0]["interval_length"] == -5.0


@pytest.mark.parametrize("column, bad", [("published_at", "soon"), ("has_lift", "maybe"), ("area", None), ("area", "x"), ("price", "")])
def test_strict_casts_stop_on_bad_values_even_if_the_column_is_not_used(spark, column, bad):
    good = {"listing_id": "1", "area": "3", "price": "5", "has_lift": "true", "published_at": "2024-01-02 03:04:05"}
    schema = ", ".join(f"{c} string" for c in good)
    assert cast_listing(spark.createDataFrame([tuple(good.values())], schema)).select("listing_id").first()[0] == 1
    df = spark.createDataFrame([tuple({**good, column: bad}.values())], schema)
    with pytest.raises(Exception, match="not castable"):
        cast_listing(df).select("listing_id").collect()
    assert cast_listing(df, strict_mode=False).select(column).first()[0] is None


def test_missing_dates_and_flags_are_no_bad_values(spark):
    df = spark.createDataFrame([("1", None, None)], "listing_id string, has_lift string, published_at string")
    assert tuple(cast_listing(df).first()) == (1, None, None)


def test_filters_that_skip_files_do_not_skip_the_check(spark, tmp_path):
    """A missing area among high prices: a filter on the price would skip that file before any row check."""
    path = str(tmp_path / "two")
    for area, price in ((3, 10), (None, 10**6)):
        spark.createDataFrame([(1, area, price)], "listing_id long, area int, price long").write.mode("append").parquet(path)
    table = spark.read.parquet(path)
    with pytest.raises(ValueError, match=r"area: not castable: null \(1 rows\)"):
        cast_listing(table).where("price < 100000").count()
    good = cast_listing(table.where("area is not null"))
    plan = good.where("price < 100000")._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(price,100000)" in plan
    assert cast_listing(table, strict_mode=False).where("price < 100000").count() == 1


def test_streams_are_checked_as_they_come(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([("x",)], "area string").write.parquet(path)
    stream = cast_listing(spark.readStream.schema("area string").parquet(path))
    query = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).format("parquet").start(out)
    with pytest.raises(Exception, match="not castable"):
        query.awaitTermination()
