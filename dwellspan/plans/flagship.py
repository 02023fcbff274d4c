"""The flagship job: trim the listings, score the cities, join the scores back, report per city."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellspan.functions.casts import cast_listing
from dwellspan.operators.rfm import add_rfm, rfm
from dwellspan.operators.trim import trim_outliers
from dwellspan.sources.listings import staged_listings


def top_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = trim_outliers(cast_listing(staged_listings(spark, sf_dir)))
    scored = add_rfm(kept, rfm(kept, "city_name"), "city_name")
    score = (F.col("R_rank_norm") + F.col("F_rank_norm") + F.col("M_rank_norm")) / 3
    return (
        scored.groupBy("city_name")
        .agg(
            F.round(F.max(score), 6).alias("score"),
            F.count(F.lit(1)).alias("listings"),
            F.round(F.avg("dom"), 6).alias("mean_dom"),
        )
        .orderBy(F.desc("score"), "city_name")
        .limit(10)
    )
