"""Two-pass external shuffle into shards, with DataFrame functions only. Its law is `rows`: shard counts differ by one at most.

Pass one scatters records uniformly into buckets that fit in memory: the seeded hash of the id and of the place in the
scan picks the bucket, so even repeated rows spread. Pass two puts each bucket in Fisher-Yates order (`shuffle` of
the bucket's array), numbers it from where the smaller buckets end, and deals the numbers round robin: record g of
the whole order is slot g div n of shard g mod n. Buckets are counted before they are moved, so records are shuffled
once and written once, as the shards' files; results are read from these files.

The input must give the same rows to the same partitions whenever it is scanned, as files do: the count and the scatter
scan it separately. If what was written doesn't fit the counts, the input is written to the work folder and the passes
are repeated on that copy. Nulls: a null text has size 1, a null id is hashed like a value. Empty tables give no
rows. Other columns are written along; a column named shard, slot or size is replaced."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dwellspan.llm.text import free_name, plain_names
from dwellspan.session import materialise, new_path

SHARDS, BUCKET_BYTES, BUCKETS_PER_TASK = 16, 4 << 20, 8


def record_size(text: Column) -> Column:
    """UTF-8 bytes of the text plus one."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint")


def shuffle_into_shards(
    docs: DataFrame, shards: int = SHARDS, seed: int = 0, doc_id: str = "doc_id", text: str = "text",
    bucket_bytes: int = BUCKET_BYTES, path: str | None = None,
) -> DataFrame:
    """The shards' files, read back: the columns of `docs`, size, shard and slot (gapless from 0 in each shard)."""
    spark = docs.sparkSession
    docs, named = plain_names(docs)
    docs = docs.select(*[c for c in docs.columns if c.lower() not in ("shard", "slot", "size")])
    total = docs.agg(F.sum(record_size(F.col(text)))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    seen, out = Observation(), path or new_path(spark, "shards")
    expected = _two_passes(docs, shards, seed, doc_id, text, buckets, seen, out)
    if (seen.get["rows"], seen.get["odd"]) != (expected, 0):
        return named(shuffle_into_shards(materialise(docs, "records"), shards, seed, doc_id, text, bucket_bytes, path))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return named(spark.read.schema(f"{fields}, size bigint, slot bigint, shard int").parquet(out))


def _two_passes(docs, shards, seed, doc_id, text, buckets, seen, out) -> int:
    bucket, rows, start, counted_rows = (free_name(docs, n) for n in ("bucket", "rows", "start", "counted"))
    scattered = docs.withColumn(
        bucket, F.pmod(F.xxhash64(F.lit(seed), F.col(doc_id), F.monotonically_increasing_id()), F.lit(buckets))
    )
    counted = materialise(scattered.groupBy(bucket).agg(F.count("*").alias(counted_rows)), "buckets")
    before = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)  # a row per bucket
    offsets = counted.withColumn(start, F.coalesce(F.sum(counted_rows).over(before), F.lit(0)))
    gathered = (
        scattered.withColumn("size", record_size(F.col(text)))
        .repartition(-(-buckets // BUCKETS_PER_TASK), F.col(bucket))
        .groupBy(bucket)
        .agg(F.collect_list(F.struct(*docs.columns, "size")).alias(rows))
    )
    order = gathered.join(offsets, bucket).select(
        start, (F.size(rows) != F.col(counted_rows)).alias(bucket),
        F.posexplode(F.shuffle(F.col(rows), seed)).alias("slot", rows),
    )
    place = F.col("slot") + F.col(start)
    dealt = order.select(
        F.col(f"{rows}.*"), F.floor(place / shards).cast("bigint").alias("slot"),
        (place % shards).cast("int").alias("shard"), F.col(bucket),
    )
    watched = dealt.observe(seen, F.count("*").alias("rows"), F.count_if(F.col(bucket)).alias("odd")).drop(bucket)
    watched.write.mode("overwrite").partitionBy("shard").parquet(out)
    return counted.agg(F.coalesce(F.sum(counted_rows), F.lit(0))).first()[0]
