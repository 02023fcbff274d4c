"""Readers for listing tables, and the listings view over the order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellspan.schema import LISTING, SCORE_COLUMNS, TRAIN_COLUMNS
from dwellspan.session import materialise


# Declared schemas of the order tables (the columns used), so that no job is spent on reading footers.
ORDER_TABLES = {
    "lineitem": "l_orderkey bigint, l_linenumber int, l_quantity double, l_discount double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz",
    "customer": "c_custkey bigint, c_nationkey int",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def read_listings(spark: SparkSession, source: str, with_target: bool = True) -> DataFrame:
    """Listing columns of a table name or parquet path; scoring reads all but the target."""
    df = spark.read.parquet(source) if "/" in source else spark.read.table(source)
    return df.select(*(TRAIN_COLUMNS if with_target else SCORE_COLUMNS))


def read_listings_csv(spark: SparkSession, path: str, schema=LISTING) -> DataFrame:
    """CSV with a header and a declared schema, so no pass over the data is spent on inference."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def listings_view(spark: SparkSession, sf_dir: str, with_target: bool = True) -> DataFrame:
    """One listing per order with line items. The line items are pre-aggregated before the join, and
    no join is hinted: Catalyst broadcasts a side only if its measured size is under the threshold."""
    table = lambda name: spark.read.schema(ORDER_TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")
    items = table("lineitem").groupBy("l_orderkey").agg(
        F.sum("l_quantity").cast("int").alias("area"),
        F.bool_or(F.col("l_returnflag") == "R").alias("has_lift"),
        F.bool_or(F.col("l_linestatus") == "O").alias("has_parking_space"),
        F.bool_or(F.col("l_discount") > 0.09).alias("has_swimming_pool"),
        F.max("l_linenumber").cast("int").alias("type_group_id"),
        (F.count(F.lit(1)) - 1).cast("int").alias("price_change_count"),
        F.max("l_shipdate").alias("last_ship"),
    )
    places = (
        table("customer")
        .join(table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            "c_custkey",
            F.col("c_nationkey").cast("int").alias("city_id"),
            F.col("n_name").alias("city_name"),
            F.when(F.col("r_name").isin("AFRICA", "AMERICA"), "IT")
            .when(F.col("r_name") == "ASIA", "PT")
            .otherwise("SP")
            .alias("country_name"),
        )
    )
    published = F.expr("timestampadd(SECOND, cast(o_orderkey % 86400 as int), o_orderdate)")
    listings = (
        table("orders")
        .join(items, F.col("o_orderkey") == F.col("l_orderkey"))
        .join(places, F.col("o_custkey") == F.col("c_custkey"))
        .withColumns(
            {
                "listing_id": F.col("o_orderkey").cast("bigint"),
                "contact_type_id": F.when(F.col("o_orderstatus") == "F", 1)
                .when(F.col("o_orderstatus") == "O", 2)
                .otherwise(3),
                "price": F.floor("o_totalprice").cast("bigint"),
                "price_currency": F.lit("EUR"),
                "dom": F.abs(F.datediff("last_ship", "o_orderdate")),
                "published_at": published.cast("timestamp_ntz"),
            }
        )
        .withColumns(
            {
                "year_published": F.year("published_at"),
                "quarter_published": F.quarter("published_at"),
                "month_published": F.month("published_at"),
            }
        )
    )
    return listings.select(*(TRAIN_COLUMNS if with_target else SCORE_COLUMNS))


def staged_listings(spark: SparkSession, sf_dir: str, with_target: bool = True) -> DataFrame:
    """The listings view written once, for jobs that pass over it several times: the line items are
    shuffled once instead of once per pass, and later passes read only the columns they need."""
    return materialise(listings_view(spark, sf_dir, with_target), "listings")
