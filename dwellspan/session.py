"""Session set-up and the shared work folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"
_local_folder: str | None = None
_scopes: list[list[str]] = []


def session(app: str = "dwellspan", master: str = "local[*]", **conf: str) -> SparkSession:
    """A session with the settings the library expects; on a cluster use the session it gives."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables: the one the cluster names, or a temporary one in local mode."""
    global _local_folder
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if named:
        return f"{named.rstrip('/')}/dwellspan"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    if _local_folder is None or not os.path.isdir(_local_folder):
        _local_folder = tempfile.mkdtemp(prefix="dwellspan-")
    return _local_folder


def new_path(spark: SparkSession, label: str) -> str:
    path = f"{work_folder(spark)}/{label}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def work(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables that are made inside are deleted at the end: write or collect results before that.

        with work(spark):
            near_duplicates(docs).write.parquet(target)
    """
    made: list[str] = []
    _scopes.append(made)
    try:
        yield
    finally:
        _scopes.remove(made)
        for path in made:
            discard(spark, path)


def materialise(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write `df` to the work folder and read it back: no lineage left, survives lost executors,
    and Catalyst knows the size on disk when it chooses a join strategy."""
    spark = df.sparkSession
    path = path or new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialise_observed(
    df: DataFrame, label: str, path: str | None = None, **metrics: Column
) -> tuple[DataFrame, dict]:
    """`materialise`, and aggregates of `df` that are observed while it is written."""
    seen = Observation()
    written = materialise(df.observe(seen, *[m.alias(name) for name, m in metrics.items()]), label, path)
    return written, seen.get


def materialise_bucketed(
    df: DataFrame, label: str, key: str, buckets: int
) -> tuple[DataFrame, Callable[[], None]]:
    """`materialise` into a table bucketed by `key`: joins by it with tables of as many buckets move no rows. Also gives the
    function that drops the table. Rows that are not dealt by `key` yet are, so that a bucket is a file."""
    spark, path = df.sparkSession, new_path(df.sparkSession, label)
    name = f"{label}_{uuid.uuid4().hex}".replace("-", "_")
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)

    def drop() -> None:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        discard(spark, path)

    return spark.table(name), drop


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few driver-side rows as literals of the plan."""
    kinds = [c.split() for c in schema.split(", ")]
    structs = [
        F.struct(*[F.lit(v).cast(kind).alias(name) for v, (name, kind) in zip(row, kinds)]) for row in rows
    ]
    if not structs:
        return spark.createDataFrame([], schema)
    return spark.range(1).select(F.inline(F.array(*structs)))


def discard(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table of ours that a newer one replaces."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
