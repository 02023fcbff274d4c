"""Listing schemas, request schemas and named feature sets."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names, categories and feature order that models are fed in.
KEY = "listing_id"
TARGET = "dom"
INT_COLUMNS = (
    "area",
    "price_change_count",
    "city_id",
    "type_group_id",
    "contact_type_id",
    "year_published",
    "quarter_published",
    "month_published",
)
LONG_COLUMNS = ("price",)
BOOL_COLUMNS = ("has_lift", "has_parking_space", "has_swimming_pool")
COUNTRIES = ("IT", "PT", "SP")
MONTHS = (
    "2021-01", "2021-02", "2021-03", "2021-04", "2021-05", "2021-06", "2021-07",
    "2021-08", "2021-09", "2021-10", "2021-11", "2021-12", "2022-01", "2022-02",
)

LISTING = T.StructType(
    [
        T.StructField("listing_id", T.LongType()),
        T.StructField("area", T.IntegerType()),
        T.StructField("has_lift", T.BooleanType()),
        T.StructField("has_parking_space", T.BooleanType()),
        T.StructField("has_swimming_pool", T.BooleanType()),
        T.StructField("contact_type_id", T.IntegerType()),
        T.StructField("type_group_id", T.IntegerType()),
        T.StructField("price", T.LongType()),
        T.StructField("price_currency", T.StringType()),
        T.StructField("price_change_count", T.IntegerType()),
        T.StructField("dom", T.IntegerType()),
        T.StructField("published_at", T.TimestampNTZType()),
        T.StructField("year_published", T.IntegerType()),
        T.StructField("quarter_published", T.IntegerType()),
        T.StructField("month_published", T.IntegerType()),
        T.StructField("city_id", T.IntegerType()),
        T.StructField("city_name", T.StringType()),
        T.StructField("country_name", T.StringType()),
    ]
)
TRAIN_COLUMNS = tuple(LISTING.fieldNames())
SCORE_COLUMNS = tuple(c for c in TRAIN_COLUMNS if c != TARGET)

RFM_COLUMNS = ("R_rank_norm", "F_rank_norm", "M_rank_norm")
TR_V2 = (
    "price", "price_change_count", "area", "month_published", "year_published",
    "type_group_id", "city_id", "has_lift", "has_parking_space",
)
EUR_V2 = TR_V2 + COUNTRIES
_V1_HEAD = ("price", "price_change_count", "area", "type_group_id")
_V1_TAIL = BOOL_COLUMNS + RFM_COLUMNS


def feature_set(name: str, months: tuple[str, ...] = MONTHS) -> tuple[str, ...]:
    """Ordered columns of a named feature set; the V1 sets end in one column per month."""
    sets = {
        "EUR_V2": EUR_V2,
        "TR_V2": TR_V2,
        "V1": _V1_HEAD + _V1_TAIL + tuple(months),
        "V1_EUR_SEARCH": _V1_HEAD + ("contact_type_id",) + _V1_TAIL + tuple(months),
    }
    return sets[name]


def request_schema(market: str) -> T.StructType:
    """Fields of one scoring request, `EUR` (12) or `TR` (9); all are required."""
    names = {"EUR": EUR_V2, "TR": TR_V2}[market]
    return T.StructType(
        [
            T.StructField(c, T.BooleanType() if c in BOOL_COLUMNS else T.LongType() if c in LONG_COLUMNS else T.IntegerType())
            for c in names
        ]
    )
