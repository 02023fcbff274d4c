import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from dwellspan.operators.rfm import add_rfm, rfm
from dwellspan.operators.sampling import sample_n, split2, split3, with_fold

ROWS = [
    ("a", "2024-01-01 23:00:00", 10), ("a", "2024-01-01 23:00:00", 10), ("b", "2024-01-02 01:00:00", 7),
    ("c", None, 3), (None, "2024-01-05 00:00:00", 100),
]


def table(spark):
    df = spark.createDataFrame(ROWS, "city_name string, t string, price int")
    return df.select("city_name", F.col("t").cast("timestamp_ntz").alias("published_at"), "price")


def test_frequency_merges_copies_and_monetary_sums_them(spark):
    rows = {r["city_name"]: r for r in rfm(table(spark), "city_name").collect()}
    assert set(rows) == {"a", "b", "c"}
    assert (rows["a"]["freq"], rows["a"]["monetary"]) == (1, 20)
    assert rows["c"]["freq"] == 0


def test_recency_counts_elapsed_days(spark):
    rows = {r["city_name"]: r["recency"] for r in rfm(table(spark), "city_name").collect() if r["recency"] is not None}
    assert rows["a"] == 0 and rows["b"] == 0


def test_null_key_keeps_its_row_without_scores(spark):
    df = table(spark)
    joined = add_rfm(df, rfm(df, "city_name"), "city_name")
    assert joined.count() == len(ROWS)
    assert joined.where("city_name IS NULL").first()["freq"] is None


@pytest.mark.parametrize("window_rows", [10**6, 0])
def test_scores_equal_pandas(spark, window_rows):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame(
        {
            "city_name": rng.choice([f"c{i}" for i in range(40)], 2000, p=np.array([40] + [1] * 39) / 79),
            "published_at": pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.integers(0, 10**7, 2000), unit="s"),
            "price": rng.integers(1, 50, 2000),
        }
    )
    agg = pd.DataFrame(
        {
            "recency": (pdf["published_at"].max() - pdf.groupby("city_name")["published_at"].max()).dt.days,
            "freq": pdf.drop_duplicates().groupby("city_name")["published_at"].count(),
            "monetary": pdf.groupby("city_name")["price"].sum(),
        }
    )
    want = pd.DataFrame(
        {
            "R_rank_norm": agg["recency"].rank(ascending=False),
            "F_rank_norm": agg["freq"].rank(),
            "M_rank_norm": agg["monetary"].rank(),
        }
    )
    want = want / want.max() * 100
    df = spark.createDataFrame(pdf).withColumn("published_at", F.col("published_at").cast("timestamp_ntz"))
    got = rfm(df, "city_name", window_rows=window_rows).toPandas().set_index("city_name").sort_index()
    pd.testing.assert_frame_equal(got[want.columns], want.sort_index(), check_dtype=False)
    assert (got["recency"] == agg["recency"].sort_index()).all()


def test_monetary_from_frequency(spark):
    df = table(spark)
    a = {r["city_name"]: r for r in rfm(df, "city_name", monetary_from="frequency").collect()}
    assert a["a"]["M_rank_norm"] == pytest.approx(a["a"]["F_rank_norm"] * 2.5 / 3, rel=1e-9)


@pytest.mark.parametrize("n", [0, 1, 7, 500, 1000])
@pytest.mark.parametrize("sort_rows", [100_000, 3])
def test_sample_is_exact_and_does_not_depend_on_partitions(spark, n, sort_rows):
    df = spark.range(1000).withColumnRenamed("id", "listing_id")
    picks = [
        sorted(r[0] for r in sample_n(df.repartition(p), n, 22, sort_rows=sort_rows).collect()) for p in (1, 4, 17)
    ]
    assert len(picks[0]) == n == len(set(picks[0]))
    assert picks[0] == picks[1] == picks[2]


def test_sample_with_a_hot_key(spark):
    """A third of all rows share one key; some of them are exact copies."""
    df = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("listing_id"),
        (F.col("id") % 50).alias("x"),
    )
    for n in (1, 100, 450, 700, 899):
        for sort_rows in (100_000, 2):
            assert sample_n(df, n, 5, sort_rows=sort_rows).count() == n


def test_too_large_a_sample_is_an_error(spark):
    with pytest.raises(ValueError, match="cannot take 11 rows out of 10"):
        sample_n(spark.range(10).withColumnRenamed("id", "listing_id"), 11, 0)


def test_splits_are_complete_stable_and_near_their_shares(spark):
    df = spark.range(20_000).withColumnRenamed("id", "listing_id")
    counts = {r["split"]: r["count"] for r in split3(df, (0.7, 0.15, 0.15), 1).groupBy("split").count().collect()}
    assert sum(counts.values()) == 20_000
    assert counts["train"] == pytest.approx(14_000, rel=0.03)
    one = {r["listing_id"]: r["split"] for r in split3(df.repartition(7)).collect()}
    assert one == {r["listing_id"]: r["split"] for r in split3(df).collect()}
    two = {r["split"]: r["count"] for r in split2(df).groupBy("split").count().collect()}
    assert two["test"] == pytest.approx(6_000, rel=0.05)
    folds = {r["fold"]: r["count"] for r in with_fold(df, 5).groupBy("fold").count().collect()}
    assert set(folds) == set(range(5)) and min(folds.values()) > 3_700


def test_sample_tells_microseconds_apart_and_takes_null_keys(spark):
    from pyspark.sql import functions as F

    rows = spark.range(6).select(
        F.lit(1).alias("listing_id"), F.expr("timestamp_micros(1700000000000000 + id)").alias("at"), F.lit(None).cast("string").alias("x")
    )
    got = sample_n(rows, 4, 22).collect()
    assert len(got) == 4 and len({r["at"] for r in got}) == 4
    keyless = spark.createDataFrame([(None, i) for i in range(5)] + [(7, 9)], "listing_id bigint, v int")
    got = sample_n(keyless, 5, 22).collect()
    assert len({(r["listing_id"], r["v"]) for r in got}) == 5
    copies = spark.createDataFrame([(3, "a")] * 5 + [(3, "")] + [(3, None)], "listing_id int, v string")
    assert sample_n(copies, 6, 1).count() == 6 and sample_n(copies, 7, 1).exceptAll(copies).count() == 0


def test_whole_numbers_stay_whole(spark):
    from dwellspan.operators.ordered import avg_rank

    big = 9007199254740992
    df = spark.createDataFrame([(1, big), (2, big + 1), (3, big + 2)], "listing_id int, v bigint")
    assert [r["rank"] for r in avg_rank(df, "v").orderBy("listing_id").collect()] == [1.0, 2.0, 3.0]
    import datetime as dt

    rows = spark.createDataFrame(
        [(i, f"c{i}", big + i, dt.datetime(2020, 1, 1)) for i in range(3)], "listing_id int, city_name string, price bigint, published_at timestamp"
    )
    got = {r["city_name"]: (r["monetary"], r["M_rank_norm"]) for r in rfm(rows, "city_name").collect()}
    assert got == {f"c{i}": (big + i, pytest.approx((i + 1) / 3 * 100)) for i in range(3)}
