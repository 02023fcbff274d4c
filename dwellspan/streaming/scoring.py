"""Scoring of arriving requests with Structured Streaming (stateless)."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dwellspan.learning.boosting import IntervalModel
from dwellspan.learning.trees import TreeModel
from dwellspan.sources.sinks import metrics_writer
from dwellspan.streaming.requests import validate


def request_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """One request body per line of the text files that arrive in a folder."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)


def with_request_id(bodies: DataFrame, body: str = "value") -> DataFrame:
    """`request_id`: what the caller put into the body under that name, else the SHA-256 of the body; so a caller
    finds its answer either way."""
    named = F.get_json_object(body, "$.request_id")
    return bodies.withColumn("request_id", F.coalesce(named, F.sha2(body, 256)))


def score_requests(requests: DataFrame, model: TreeModel | IntervalModel) -> DataFrame:
    """Typed requests with `prediction`, or with `lower_bound` and `upper_bound`."""
    return model.transform(requests)


def score_stream(
    stream: DataFrame,
    model: TreeModel | IntervalModel,
    market: str,
    folder: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Validate and score the stream into `folder`: predictions, rejects and per-batch timings.

    The model is loaded once by the caller and shipped with the plan. Every batch owns its sub-folders
    and replaces them, so a batch repeated after a failure leaves no duplicates."""
    record = metrics_writer(f"{folder}/metrics")

    def write(batch: DataFrame, batch_id: int) -> None:
        started = time.time()
        batch.persist()
        try:
            good, rejects = validate(with_request_id(batch), market)
            answered, rejected = Observation(), Observation()
            good = good.observe(answered, F.count(F.lit(1)).alias("n"))
            score_requests(good, model).write.mode("overwrite").parquet(f"{folder}/predictions/batch_id={batch_id}")
            bodies = rejects.select("value").observe(rejected, F.count(F.lit(1)).alias("n"))
            bodies.write.mode("overwrite").text(f"{folder}/rejects/batch_id={batch_id}")
        finally:
            batch.unpersist()
        record(batch.sparkSession, batch_id, started, answered.get["n"], rejected.get["n"])

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{folder}/checkpoint")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 second")
    return writer.start()
