"""Writers for predictions, run metadata, CSV exports and request metrics."""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns of the run log.
RUN_LOG = (
    "model_name string, model_type string, model_version string, r2_score double, "
    "adjusted_r2_score double, mean_absolute_error double, median_absolute_error double, "
    "mean_squared_error double, train_time double, created_at string"
)


def write_csv(df: DataFrame, path: str) -> None:
    """UTF-8 CSV with a header, as a folder of parts."""
    df.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def prediction_rows(df: DataFrame, batch_id: str, prediction: str = "prediction") -> DataFrame:
    return df.select(
        "listing_id",
        F.col(prediction).cast("double").alias("dom_predictions"),
        F.current_timestamp().alias("created_at"),
        F.lit(str(batch_id)).alias("batch_id"),
    )


def write_predictions(df: DataFrame, path: str, batch_id: str, prediction: str = "prediction") -> None:
    """Append one batch. A batch owns its folder and replaces it, so a repeated batch adds nothing."""
    rows = prediction_rows(df, batch_id, prediction).drop("batch_id")
    rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("batch_id", F.col("batch_id").cast("string"))


def write_predictions_jdbc(
    df: DataFrame, url: str, table: str, batch_id: str, properties: Mapping[str, str] | None = None,
    prediction: str = "prediction", batchsize: int = 10_000,
) -> None:
    """Append one batch to a relational table, many rows per statement. Rows of the batch that a failed
    attempt already stored are left out, so the append can be repeated."""
    spark = df.sparkSession
    options = {**(properties or {}), "url": url}
    stored = (
        spark.read.format("jdbc").options(**options, dbtable=table).load()
        .where(F.col("batch_id") == str(batch_id)).select("listing_id")
    )
    rows = prediction_rows(df, batch_id, prediction).join(stored, "listing_id", "left_anti")
    rows.write.format("jdbc").mode("append").options(**options, dbtable=table, batchsize=batchsize).save()


def run_row(spark: SparkSession, meta: Mapping[str, object]) -> DataFrame:
    """One row of run metadata: version is the SHA-256 of the name; `mean_squared_error` keeps its
    historical content, the root of the mean squared error."""
    numbers = {
        "r2_score": "r2", "adjusted_r2_score": "adjusted_r2", "mean_absolute_error": "mae",
        "median_absolute_error": "median_ae", "mean_squared_error": "rmse", "train_time": "train_time",
    }
    one = spark.range(1)
    return one.select(
        F.lit(meta["model_name"]).alias("model_name"),
        F.lit(meta["model_type"]).alias("model_type"),
        F.sha2(F.lit(meta["model_name"]), 256).alias("model_version"),
        *[F.lit(meta.get(source)).cast("double").alias(name) for name, source in numbers.items()],
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("created_at"),
    )


def log_run(spark: SparkSession, meta: Mapping[str, object], path: str) -> None:
    run_row(spark, meta).write.mode("append").parquet(path)


METRICS = "start_time double, process_time double, answered bigint, rejected bigint"


def metrics_writer(path: str):
    """A function that stores start time, duration, answers and rejects of one micro-batch as headerless CSV."""

    def write(spark: SparkSession, batch_id: int, started: float, answered: int, rejected: int) -> None:
        row = [(started, time.time() - started, answered, rejected)]
        spark.createDataFrame(row, METRICS).coalesce(1).write.mode("overwrite").csv(f"{path}/batch_id={batch_id}")

    return write


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{METRICS}, batch_id bigint").csv(path)
