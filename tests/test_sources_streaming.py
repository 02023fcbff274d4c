import hashlib
import json

import pytest
from pyspark.sql import functions as F

from dwellspan import session as session_module
from dwellspan.learning.boosting import BoostParams, IntervalModel, bin_table, fit_boosted
from dwellspan.schema import EUR_V2, LISTING, SCORE_COLUMNS, TR_V2, TRAIN_COLUMNS, request_schema
from dwellspan.session import discard, materialise, new_path, work_folder
from dwellspan.sources import sinks
from dwellspan.sources.listings import listings_view, read_listings, read_listings_csv
from dwellspan.streaming.requests import validate
from dwellspan.streaming.scoring import request_stream, score_requests, score_stream

from conftest import SMALL


def test_view_has_the_listing_schema_and_a_unique_key(spark):
    df = listings_view(spark, SMALL)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in LISTING]
    assert df.count() == 1473 == df.select("listing_id").distinct().count()
    assert listings_view(spark, SMALL, with_target=False).columns == list(SCORE_COLUMNS)


def test_scan_reads_only_the_columns_used(spark, listings):
    plan = listings.select("price").where("area > 3")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<area:int,price:bigint>" in plan and "GreaterThan(area,3)" in plan


def test_csv_round_trip(spark, listings):
    path = new_path(spark, "csv")
    rows = listings.select(*TRAIN_COLUMNS)
    sinks.write_csv(rows, path)
    again = read_listings_csv(spark, path)
    assert again.exceptAll(rows).count() == 0 == rows.exceptAll(again).count()


def test_read_table_by_name(spark, listings):
    listings.createOrReplaceTempView("some_listings")
    assert read_listings(spark, "some_listings", with_target=False).columns == list(SCORE_COLUMNS)


def test_repeated_batch_adds_nothing(spark, listings):
    path, rows = new_path(spark, "predictions"), listings.withColumn("prediction", F.lit(1.5))
    for batch in ("1", "2", "2"):
        sinks.write_predictions(rows, path, batch)
    stored = sinks.read_predictions(spark, path)
    assert stored.count() == 2 * rows.count()
    assert set(stored.columns) == {"listing_id", "dom_predictions", "created_at", "batch_id"}


def test_run_log(spark):
    path = new_path(spark, "log")
    for name in ("model_a", "model_b"):
        sinks.log_run(spark, {"model_name": name, "model_type": "T", "r2": 0.5, "rmse": 2.0, "train_time": 1.0}, path)
    rows = {r["model_name"]: r for r in spark.read.parquet(path).collect()}
    assert rows["model_a"]["model_version"] == hashlib.sha256(b"model_a").hexdigest()
    assert rows["model_b"]["mean_squared_error"] == 2.0
    assert len(rows["model_a"]["created_at"]) == 19


def test_work_folder_follows_the_session_setting(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert work_folder(spark) == f"{named}/dwellspan"
    path = new_path(spark, "x")
    assert materialise(spark.range(3), "x", path).count() == 3
    discard(spark, path)
    with pytest.raises(Exception):
        spark.read.parquet(path).count()


def test_a_cluster_without_a_shared_folder_is_an_error(monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session_module.work_folder(Session())


GOOD = {c: (True if c.startswith("has_") else 1) for c in EUR_V2}


def test_bad_requests_are_rejected(spark):
    bodies = [
        json.dumps(GOOD),
        json.dumps({**GOOD, "area": "many"}),
        json.dumps({**GOOD, "area": 1.5}),
        json.dumps({**GOOD, "has_lift": 1}),
        json.dumps({k: v for k, v in GOOD.items() if k != "SP"}),
        json.dumps({**GOOD, "price": None}),
        '{"price": 1, ',
        "",
    ]
    good, rejects = validate(spark.createDataFrame([(b,) for b in bodies], "value string"), "EUR")
    assert good.schema.fieldNames() == list(EUR_V2) and good.count() == 1
    assert rejects.count() == len(bodies) - 1
    assert [f.name for f in request_schema("TR")] == list(TR_V2)


@pytest.mark.parametrize("interval", [False, True])
def test_stream_gives_the_batch_result_and_repeats_nothing(spark, listings, interval):
    table = bin_table(listings, TR_V2, max_bins=8)
    model = fit_boosted(table, BoostParams(n_estimators=1, max_depth=2))
    if interval:
        model = IntervalModel(model, model)
    inbox, folder = new_path(spark, "inbox"), new_path(spark, "stream")
    requests = listings.select(*TR_V2)
    requests.select(F.to_json(F.struct(*TR_V2)).alias("value")).repartition(3).write.text(inbox)
    spark.createDataFrame([("not json",)], "value string").coalesce(1).write.mode("append").text(inbox)
    for _ in range(2):  # the second run finds nothing new
        score_stream(request_stream(spark, inbox, files_per_batch=2), model, "TR", folder).awaitTermination()
    answers = spark.read.parquet(f"{folder}/predictions").drop("batch_id")
    assert answers.where("length(request_id) <> 64").count() == 0  # no id given: the digest of the body
    got = answers.drop("request_id")
    typed = requests.withColumn("price", F.col("price").cast("bigint"))
    want = score_requests(typed, model).select(*got.columns)
    assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()
    assert [r[0] for r in spark.read.text(f"{folder}/rejects").select("value").collect()] == ["not json"]
    timed = sinks.read_metrics(spark, f"{folder}/metrics")
    assert timed.agg({"answered": "sum", "rejected": "sum"}).first()[:] in ((requests.count(), 1), (1, requests.count()))
    assert timed.count() == 2 and timed.where("process_time > 0").count() == 2
