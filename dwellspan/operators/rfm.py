"""Recency, frequency and monetary scores per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellspan.operators.ordered import WINDOW_ROWS, average_ranks, common_number
from dwellspan.session import materialise, materialise_observed


def rfm_parts(df: DataFrame, key: str, row_id: str = "listing_id") -> DataFrame:
    """(key, frequency, monetary, last_seen). Frequency counts distinct rows with a publication time,
    monetary sums all rows.

    Copies of a row share its id, so only ids that occur twice are looked at for copies: the table itself
    is combined before its shuffle, and the check moves nothing but ids. What is left of the
    deduplication is a correction by the copies found, usually none."""
    kept = df.where(F.col(key).isNotNull())
    totals = kept.groupBy(key).agg(
        F.count("published_at").alias("frequency"),
        F.sum("price").alias("monetary"),
        F.max("published_at").alias("last_seen"),
    )
    suspects = kept
    if row_id in df.columns:
        ids = kept.groupBy(row_id).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(row_id)
        repeated, seen = materialise_observed(ids, "repeated", n=F.count(F.lit(1)))
        if not seen["n"]:
            return totals
        repeated = repeated.withColumnRenamed(row_id, "_id")
        suspects = kept.join(repeated, F.col(row_id).eqNullSafe(F.col("_id")), "left_semi")
    copies = suspects.groupBy(*df.columns).agg((F.count(F.lit(1)) - 1).alias("extra")).where("extra > 0")
    extra = copies.groupBy(key).agg(F.sum(F.when(F.col("published_at").isNotNull(), F.col("extra"))).alias("extra"))
    return totals.join(extra, key, "left").select(
        key, (F.col("frequency") - F.coalesce("extra", F.lit(0))).alias("frequency"), "monetary", "last_seen"
    )


def with_recency(parts: DataFrame) -> DataFrame:
    """Whole elapsed days between a key's last listing and the last listing of all keys."""
    latest = parts.agg(F.max("last_seen")).scalar()
    days = F.timestamp_diff("DAY", F.col("last_seen"), latest).cast("int")
    return parts.withColumn("recency", days)


def rfm(
    df: DataFrame,
    key: str,
    suffix: str = "",
    prefix: str = "",
    monetary_from: str = "monetary",
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """Per key: recency, frequency, monetary and the three ranks as a percentage of the largest rank.

    `monetary_from="frequency"` divides the frequency rank by the largest monetary rank instead."""
    parts = with_recency(materialise(rfm_parts(df, key), "rfm"))
    order = {"recency": False, "frequency": True, "monetary": True}
    ranks = average_ranks(parts, order, window_rows)
    kind = common_number(parts, list(order))
    long = parts.select(
        key, F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast(kind).alias("value")) for c in order]))
    )
    pick = lambda column, what: F.max(F.when(F.col("column") == column, F.col(what)))
    wide = long.join(ranks, ["column", "value"], "left").groupBy(key).agg(
        *[pick(c, "rank").alias(f"{c}_rank") for c in order],
        *[pick(c, "top").alias(f"{c}_top") for c in order],
    )
    return parts.join(wide, key).select(
        key,
        F.col("recency").cast("int").alias(f"{prefix}recency"),
        F.col("frequency").cast("bigint").alias(f"{prefix}freq"),
        F.col("monetary").cast("bigint").alias(f"{prefix}monetary"),
        (F.col("recency_rank") / F.col("recency_top") * 100).alias(f"R_rank_norm{suffix}"),
        (F.col("frequency_rank") / F.col("frequency_top") * 100).alias(f"F_rank_norm{suffix}"),
        (F.col(f"{monetary_from}_rank") / F.col("monetary_top") * 100).alias(f"M_rank_norm{suffix}"),
    )


def add_rfm(df: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Left join of the scores. Nothing is hinted: Catalyst broadcasts the scores only if their size is
    under its threshold, and otherwise AQE splits a hot key of the sort-merge join."""
    return df.join(table, key, "left")
